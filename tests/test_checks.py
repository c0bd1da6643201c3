"""Check statistics and diagnosis on small hand-made logs."""

from datetime import datetime, timedelta

from vacanta.operators import checks
from vacanta.schemas import CHECK_EVENT

START = datetime(2024, 1, 1)


def frame(spark, histories):
    """``{source: [error or None for a success, ...]}``"""
    rows = [
        (seq, START + timedelta(minutes=seq), source, error is None, 6.0 if seq % 2 else 5.0, error)
        for source, errors in histories.items() for seq, error in enumerate(errors)
    ]
    return spark.createDataFrame(rows, CHECK_EVENT).repartition(3)


def lines(spark, errors):
    rows = sorted(checks.diagnosis(frame(spark, {1: errors})).collect())
    return ([r["line"] for r in rows if r["kind"] == "diagnosis"],
            [r["line"] for r in rows if r["kind"] == "suggestion"])


def test_healthy_log_has_nothing_to_say(spark):
    assert lines(spark, [None] * 5) == ([], [])


def test_findings_in_order(spark):
    errors = [None] * 10 + ["OperationalError", "Lost Connection", "connection TIMEOUT", "locked"]
    assert lines(spark, errors) == (
        ["当前连续失败 4 次", "成功率较低: 71.4%", "错误类型分析:", "  operational: 1 次",
         "  connection: 1 次", "  timeout: 1 次"],
        ["建议检查MySQL服务器状态", "检查网络连接", "检查数据库配置"],
    )


def test_patterns_look_at_ten_failures_and_advice_at_fifty(spark):
    errors = ["timeout"] + ["locked"] * 49 + [None] * 1000
    assert lines(spark, errors) == ([], ["考虑增加连接超时时间", "检查数据库服务器负载"])
    errors = ["timeout"] + ["locked"] * 50 + [None] * 1000
    assert lines(spark, errors) == ([], [])
    errors = ["connection"] + ["locked"] * 10 + [None]
    assert lines(spark, errors) == (["成功率较低: 8.3%"], [])


def test_totals_runs_and_alerts(spark):
    log = frame(spark, {1: ["x"] * 4 + [None] + ["x"] * 2, 2: [None, None], 3: ["x"] * 3})
    totals = {r["source"]: r for r in checks.check_totals(log).collect()}
    assert (totals[1]["total_checks"], totals[1]["successful_checks"], totals[1]["failed_checks"]) == (7, 1, 6)
    assert totals[1]["success_rate"] == 1 / 7 * 100
    assert totals[1]["last_success_time"] == START + timedelta(minutes=4)
    assert totals[1]["last_failure_time"] == totals[1]["last_check_time"] == START + timedelta(minutes=6)
    assert totals[2]["last_failure_time"] is None and totals[3]["last_success_time"] is None
    assert {tuple(r) for r in checks.check_runs(log, 2).collect()} == {(1, 2, 4), (2, 0, 0), (3, 3, 3)}
    assert {tuple(r) for r in checks.streak_alerts(log, chunk_rows=2).collect()} == {
        (1, 2, 3), (1, 3, 4), (3, 2, 3)
    }


def test_kept_errors(spark):
    log = frame(spark, {1: [f"e{i}" for i in range(60)], 2: [None, "only"]})
    kept = checks.last_errors(log).collect()
    assert {r["error"] for r in kept if r["source"] == 1} == {f"e{i}" for i in range(10, 60)}
    assert [r["error"] for r in checks.last_errors(log, 1).orderBy("source").collect()] == ["e59", "only"]
    assert [tuple(r)[:3] for r in checks.error_patterns(log).collect()] == []


def test_slow_checks(spark):
    log = frame(spark, {1: [None, None, "x", "x", None]})
    assert [r["seq"] for r in checks.slow_checks(log).collect()] == [1]
