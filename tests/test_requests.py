"""Request statistics against plain Python on random logs."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vacanta import fixed_values as fixed
from vacanta.operators import requests
from vacanta.schemas import REQUEST_EVENT, TASK_EVENT

NOW = datetime(2024, 1, 3)
ERRORS = ["anti_spider_suspected", "IP_Blocked", "timeout", "", None]


def moment():
    return F.lit(NOW.isoformat(" ")).cast("timestamp_ntz")


def random_log(seed, n=600):
    rng = random.Random(seed)
    rows, ts = [], NOW - timedelta(days=2)
    for seq in range(n):
        ts += timedelta(seconds=rng.randrange(1, 500))
        source = rng.choice([0, 0, 0, 1, 2, 3, 4])
        good = rng.random() < [0.9, 0.5, 0.1, 0.0, 0.95][source]
        if source == 4 and seq > n // 2:
            good = False
        rows.append((
            seq, ts, source, good, rng.choice([None, 0.0, 0.5, 1.25, 30.0 if source == 0 else 2.0]),
            None if good else rng.choice(ERRORS[:2] if source == 1 else ERRORS),
            rng.randrange(0, 4) if good else 0,
        ))
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def logs(request, spark):
    rows = random_log(request.param)
    per_source = {}
    for row in rows:
        per_source.setdefault(row[2], []).append(row)
    return spark.createDataFrame(rows, REQUEST_EVENT).repartition(4).cache(), per_source


def trailing_failures(rows):
    n = 0
    for row in reversed(rows):
        if row[3]:
            break
        n += 1
    return n


def mean_time(rows):
    times = [r[4] for r in rows if r[4]][-100:]
    return sum(times) / len(times) if times else 0.0


def facts(rows):
    good = [r for r in rows if r[3]]
    anti = [r for r in rows if not r[3] and r[5]
            and ("anti_spider" in r[5].lower() or "blocked" in r[5].lower())]
    return {
        "total": len(rows), "good": len(good), "empty": sum(r[6] == 0 for r in good),
        "jobs": sum(r[6] for r in good), "anti": len(anti), "streak": trailing_failures(rows),
        "last": max((r[1] for r in good), default=None), "mean": mean_time(rows),
        "rate": len(good) / len(rows) * 100,
    }


def test_totals_add_up(logs):
    log, per_source = logs
    got = {r["source"]: r for r in requests.request_totals(log).collect()}
    assert set(got) == set(per_source)
    for source, rows in per_source.items():
        want, row = facts(rows), got[source]
        assert row["total_requests"] == row["successful_requests"] + row["failed_requests"]
        assert [row[c] for c in ("total_requests", "successful_requests", "empty_responses",
                                 "total_jobs", "anti_spider_hits")] == [
            want[k] for k in ("total", "good", "empty", "jobs", "anti")]


def test_hours_sum_to_totals(logs):
    log, per_source = logs
    hours = requests.hourly_stats(log).groupBy("source").agg(
        F.sum("requests"), F.sum("success"), F.sum("jobs")
    ).collect()
    for source, *sums in hours:
        want = facts(per_source[source])
        assert sums == [want["total"], want["good"], want["jobs"]]


def test_recent_hours_are_the_last_with_traffic(logs):
    log, per_source = logs
    got = {}
    for r in requests.recent_hours(log, 5).collect():
        got.setdefault(r["source"], set()).add(r["hour"])
    for source, rows in per_source.items():
        hours = sorted({r[1].strftime("%Y-%m-%d %H:00") for r in rows})
        assert got[source] == set(hours[-5:])


def test_streaks_means_errors(logs):
    log, per_source = logs
    streaks = dict(map(tuple, requests.consecutive_failures(log).collect()))
    means = dict(map(tuple, requests.avg_response_time(log).collect()))
    lasts = dict(map(tuple, requests.last_success(log).collect()))
    errors = {(r["source"], r["error_type"]): r["failures"]
              for r in requests.error_breakdown(log).collect()}
    want_errors = Counter((s, r[5]) for s, rows in per_source.items() for r in rows if not r[3] and r[5])
    assert errors == want_errors
    for source, rows in per_source.items():
        want = facts(rows)
        assert streaks[source] == want["streak"] and lasts[source] == want["last"]
        assert means[source] == pytest.approx(want["mean"])


def message(want):
    rules = [
        (want["streak"] > 10, fixed.HEALTH_STREAK),
        (want["total"] > 20 and want["rate"] < 30, fixed.HEALTH_RATE),
        (want["total"] > 10 and want["anti"] / want["total"] > 0.5, fixed.HEALTH_ANTI),
        (want["last"] is not None and NOW - want["last"] > timedelta(hours=1), fixed.HEALTH_SILENT),
    ]
    return next((text for rule, text in rules if rule), fixed.HEALTH_GOOD)


def advice(want):
    rules = [
        (want["rate"] < 50, fixed.ADVICE_RATE),
        (want["anti"] / want["total"] * 100 > 30, fixed.ADVICE_ANTI),
        (want["good"] > 0 and want["empty"] / want["good"] * 100 > 50, fixed.ADVICE_EMPTY),
        (want["mean"] > 10, fixed.ADVICE_SLOW),
    ]
    return [text for rule, text in rules if rule]


def test_verdicts_and_advice(logs):
    log, per_source = logs
    got = {r["source"]: r["health_message"] for r in requests.health_verdict(log, moment()).collect()}
    assert got == {s: message(facts(rows)) for s, rows in per_source.items()}
    lines = {s: [] for s in per_source}
    for r in sorted(requests.recommendations(log).collect()):
        lines[r["source"]].append(r["recommendation"])
    assert lines == {s: advice(facts(rows)) for s, rows in per_source.items()}


@pytest.mark.parametrize("rows,want", [
    # (successes, anti-spider failures, other failures, then successes), verdict
    ((0, 0, 10, 0), fixed.HEALTH_GOOD),
    ((1, 0, 11, 0), fixed.HEALTH_STREAK),
    ((0, 0, 17, 7), fixed.HEALTH_RATE),
    ((0, 0, 14, 6), fixed.HEALTH_GOOD),
    ((0, 6, 0, 5), fixed.HEALTH_ANTI),
    ((0, 5, 0, 5), fixed.HEALTH_GOOD),
])
def test_verdict_limits(spark, rows, want):
    first, anti, other, last = rows
    kinds = [(True, None)] * first + [(False, "blocked")] * anti + [(False, "x")] * other
    kinds += [(True, None)] * last
    log = spark.createDataFrame(
        [(i, NOW, 1, ok, None, error, 1) for i, (ok, error) in enumerate(kinds)], REQUEST_EVENT
    )
    assert requests.health_verdict(log, moment()).first()["health_message"] == want


def test_silence_rule_needs_a_success_and_more_than_an_hour(spark):
    def verdict(ok, ago):
        log = spark.createDataFrame([(1, NOW - ago, 1, ok, None, None, 1)], REQUEST_EVENT)
        return requests.health_verdict(log, moment()).first()["health_message"]

    assert verdict(True, timedelta(hours=1)) == fixed.HEALTH_GOOD
    assert verdict(True, timedelta(hours=1, microseconds=1)) == fixed.HEALTH_SILENT
    assert verdict(False, timedelta(hours=9)) == fixed.HEALTH_GOOD


def test_report_documents(logs, spark, tmp_path):
    log, per_source = logs
    task_log = spark.createDataFrame(
        [(i, NOW, 0, "k", "c", i % 3 > 0) for i in range(9)], TASK_EVENT
    )
    requests.save_report(requests.report(log, task_log, moment()), f"{tmp_path}/report")
    documents = [json.loads(line) for part in (tmp_path / "report").glob("part-*")
                 for line in part.read_text("utf-8").splitlines()]
    assert {d["source"] for d in documents} == set(per_source)
    for d in documents:
        rows = per_source[d["source"]]
        want, stats = facts(rows), d["statistics"]
        assert d["health_message"] == message(want)
        assert d["health_status"] == ("NORMAL" if message(want) == fixed.HEALTH_GOOD else "CRITICAL")
        assert d["timestamp"] == NOW.isoformat()
        assert d["runtime_hours"] == pytest.approx((NOW - rows[0][1]).total_seconds() / 3600)
        assert stats["success_rate"] == round(want["rate"], 2)
        assert stats["avg_response_time"] == round(want["mean"], 2)
        assert stats["last_success_time"] == (want["last"].isoformat() if want["last"] else None)
        assert (stats["cities_completed"], stats["cities_failed"]) == ((6, 3) if d["source"] == 0 else (0, 0))
        assert d["recommendations"] == advice(want)
        assert d["error_breakdown"] == Counter(r[5] for r in rows if not r[3] and r[5])
        hours = Counter(r[1].strftime("%Y-%m-%d %H:00") for r in rows)
        assert {h: s["requests"] for h, s in d["recent_hourly_stats"].items()} == {
            h: hours[h] for h in sorted(hours)[-24:]}


def test_report_checkpoints(spark):
    rows = [(i, NOW, s, "k", "c", i % 4 != 0) for i in range(40) for s in (0, 1) if s == 0 or i < 7]
    got = requests.report_checkpoints(spark.createDataFrame(rows, TASK_EVENT), chunk_rows=3).collect()
    want = set()
    for s, n in ((0, 40), (1, 7)):
        for i in range(4, n, 5):
            done = sum(j % 4 != 0 for j in range(i + 1))
            want.add((s, i, done, i + 1 - done))
    assert {tuple(r) for r in got} == want
