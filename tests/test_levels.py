"""Tables in levels: first arrivals and hourly parts over many batches."""

import random

import pytest
from pyspark.sql import functions as F

from vacanta.operators import requests
from vacanta.plans import queries
from vacanta.schemas import REQUEST_EVENT
from vacanta.sources.responses import stream_log
from vacanta.streaming import hourly, ingest
from vacanta.streaming.levels import LevelledTable


def batches_of_items(seed, n_batches, n_keys, rows=30):
    rng = random.Random(seed)
    return [
        [(None if rng.random() < 0.02 else f"k{rng.randrange(n_keys)}", b * 1000 + rng.randrange(900)) for _ in range(rows)]
        for b in range(n_batches)
    ]


def first_of(batches):
    first = {}
    for rows in batches:
        here = {}
        for key, page in rows:
            if key is not None:
                here[key] = min(page, here.get(key, page))
        first = here | first
    return sorted(first.items())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "jobId string, page_id long")


def test_fifty_batches_keep_few_files_and_open_only_their_folders(spark, items, tmp_path):
    batches = batches_of_items(1, 50, 2000)
    index = ingest.first_seen_index(spark, items([]), "jobId", f"{tmp_path}/index", fan=4, bucket_rows=64)
    most = 0
    for n, rows in enumerate(batches):
        ingest.add_first_seen(index, items(rows), n, ("page_id",))
        runs = index.runs()
        most = max(most, len(runs))
        assert sum(r.rows for r in runs) == len(first_of(batches[: n + 1]))
    # At most three runs a level, and as many levels as four to that power are batches.
    assert most <= 12 and max(r.level for r in runs) <= 3
    assert sorted(map(tuple, index.read().collect())) == first_of(batches)
    # One file a folder in each merged run.
    for run in (r for r in runs if r.bits):
        folders = list((tmp_path / "index" / "runs" / f"{run.level}-{run.batch}").glob("bucket=*"))
        assert len(folders) <= 1 << run.bits
        assert all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    # One key opens one folder of each run.
    touched = index.touched(items([("k7", 0)]), runs)
    assert len(touched) == 1
    plan = plan_of(index.read(runs, touched))
    assert plan.count("PartitionFilters: [isnotnull(bucket") == sum(r.bits > 0 for r in runs) > 0
    every = index.read(runs).select(F.input_file_name().alias("f")).distinct().count()
    some = index.read(runs, touched).select(F.input_file_name().alias("f")).distinct().count()
    assert some <= len(runs) < every
    # Nothing else lies around.
    left = {p.name for p in (tmp_path / "index" / "runs").iterdir()}
    assert left >= {f"{r.level}-{r.batch}" for r in runs} and len(left) <= 2 * len(runs) + 8


def test_any_batch_may_run_again(spark, items, tmp_path):
    batches = batches_of_items(2, 9, 120)
    index = ingest.first_seen_index(spark, items([]), "jobId", f"{tmp_path}/index", fan=3, bucket_rows=40)
    for n, rows in enumerate(batches):
        for attempt in range(2 + n % 2):
            ingest.add_first_seen(index, items(rows), n, ("page_id",))
            assert sorted(map(tuple, index.read().collect())) == first_of(batches[: n + 1])


def test_a_large_batch_is_cut_into_folders_at_once(spark, items, tmp_path):
    index = ingest.first_seen_index(spark, items([]), "jobId", f"{tmp_path}/index", bucket_rows=100)
    ingest.add_first_seen(index, items([(f"k{i}", i) for i in range(1000)]), 0, ("page_id",))
    (run,) = index.runs()
    assert (run.level, run.bits, run.rows) == (1, 4, 1000)
    ingest.add_first_seen(index, items([]), 1, ("page_id",))
    assert index.runs() == [run]
    ingest.add_first_seen(index, items([("k5", -1), ("new", 1)]), 2, ("page_id",))
    assert dict(map(tuple, index.read().collect())) == {**{f"k{i}": i for i in range(1000)}, "new": 1}


def test_merged_rows_may_be_added_up(spark, tmp_path):
    def added(rows):
        return rows.groupBy("k").agg(F.sum("v").alias("v"))

    schema = spark.createDataFrame([], "k long, v long").schema
    table = LevelledTable(spark, f"{tmp_path}/sums", schema, ["k"], added, fan=3, bucket_rows=4)
    want = {}
    for n in range(20):
        rows = [(n % 7, n), (None, 1), (100 + n, 5)]
        table.add(spark.createDataFrame(rows, schema), n)
        for k, v in rows:
            want[k] = want.get(k, 0) + v
    assert {r["k"]: r["v"] for r in added(table.read()).collect()} == want
    parts = table.read().groupBy("k").count().agg(F.max("count")).first()[0]
    assert parts <= len(table.runs()) <= 6


# --- hours ----------------------------------------------------------------------


def land_in_order(log, path, order):
    last = log.agg(F.max("seq")).first()[0] + 1
    n = len(order)
    for i in order:
        part = log.where(F.col("seq").between(last * i // n, last * (i + 1) // n - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


COLUMNS = ["source", "hour", "requests", "success", "jobs"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (2, 0, 3, 1), (3, 2, 1, 0)])
def test_closed_hours_and_corrections_are_the_exact_hours(spark, sf_dir, tmp_path, order):
    log = queries._request_log(spark, sf_dir)
    path = land_in_order(log, f"{tmp_path}/log", order)
    stream = stream_log(spark, path, REQUEST_EVENT, files_per_batch=1)
    so_far = hourly.hourly_so_far(stream, f"{tmp_path}/parts", f"{tmp_path}/o1")
    exact = requests.hourly_stats(log)
    assert rows_of(so_far) == rows_of(exact)
    closed = hourly.closed_hours(stream, f"{tmp_path}/closed", f"{tmp_path}/o2", "10 minutes")
    assert closed.count() == closed.select("source", "hour").distinct().count() > 0
    fixes = hourly.corrections(so_far, closed)
    assert (fixes.count() == 0) == (order == (0, 1, 2, 3))
    both = hourly.exact_hours(closed, fixes)
    newest = closed.agg(F.max("hour")).first()[0]
    assert rows_of(both) == rows_of(exact.where(F.col("hour") <= newest))
    # The clock has passed the end of every closed hour.
    clock = log.agg((F.max("ts") - F.expr("interval 10 minutes")).cast("string")).first()[0]
    assert newest < clock[:13] + ":00"


def test_parts_of_an_hour_stay_few(spark, tmp_path):
    rows = [(i, None, 1, i % 2 == 0, 1.0, "", 2) for i in range(30)]
    log = spark.createDataFrame(rows, REQUEST_EVENT).withColumn("ts", F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))
    parts = hourly.hour_parts(log, f"{tmp_path}/parts", fan=3)
    for n in range(20):
        parts.add(requests.hourly_stats(log), n)
    assert parts.read().count() <= 6
    assert rows_of(hourly._added(parts.read())) == [(1, "2024-03-10 02:00", 600, 300, 600)]
