"""The plans behind the queries stay the ones meant for large data."""

import pytest

from vacanta.plans.queries import QUERIES
from vacanta.schemas import TASK_KEYS

STREAMS_AND_WRITES = [n for n in QUERIES if n.startswith(("stream_", "save_"))]


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS_AND_WRITES)))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text
    assert "Exchange SinglePartition" not in text or name in (
        "not_null_rejects", "page_quality", "recent_inserts", "table_profile", "check_details"
    ), "only whole-table counts may meet in one task"


@pytest.mark.parametrize(
    "name", ["listings", "explode_items", "cast_salary", "valid_pages", "pages_until_bad", "listing_view"]
)
def test_each_body_is_parsed_once(spark, sf_dir, name):
    assert plan(spark, sf_dir, name).count("from_json(") == 1


@pytest.mark.parametrize(
    "name", ["avg_last100", "recent_hours", "last_errors", "error_patterns", "dedupe_latest"]
)
def test_top_rows_are_limited_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["streak_alerts", "report_checkpoints"])
def test_the_log_is_shuffled_once(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", ["request_totals", "hourly_stats", "error_breakdown", "check_totals"])
def test_counts_are_combined_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert text.count("Exchange hashpartitioning") == 1 and "partial_" in text


def test_scans_read_only_what_is_used(spark, sf_dir):
    read = plan(spark, sf_dir, "success_rate").split("ReadSchema:")[1].split("\n")[0]
    assert "event_type" in read and "value" not in read and "props" not in read
    text = plan(spark, sf_dir, "cast_salary")
    assert "EqualTo(status_code,200)" in text
    assert "StructField(jobName" not in text


def test_keys_name_a_task():
    assert TASK_KEYS == ["run", "kw", "city"]


@pytest.mark.parametrize(
    "name,scans", [("failure_runs", 1), ("consecutive_failures", 1), ("check_report", 2), ("diagnosis", 2), ("health_verdict", 2)]
)
def test_totals_and_runs_share_a_scan(spark, sf_dir, name, scans):
    assert plan(spark, sf_dir, name).count("FileScan") == scans


@pytest.mark.parametrize("name", ["union_pages", "page_report"])
def test_bodies_of_several_page_groups_are_parsed_once(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert text.count("from_json(") <= 1 and text.count("Union") == 0
    if name == "union_pages":
        assert text.count("FileScan") == 1
