"""Streams that take several micro-batches, against the batch operators."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from vacanta.operators import checks, requests
from vacanta.operators.envelope import explode_items
from vacanta.plans import queries
from vacanta.schemas import CHECK_EVENT, REQUEST_EVENT
from vacanta.sources import samples
from vacanta.sources.areas import area_dimension
from vacanta.sources.responses import stream_files, stream_log, stream_responses
from vacanta.streaming import hourly, ingest, streaks
from vacanta.streaming.batches import batch_path, write_batches

FILES = 4


def land(rows, path):
    """Files by rising ``seq``, written one after the other."""
    last = rows.agg(F.max("seq")).first()[0] + 1
    for i in range(FILES):
        low, high = last * i // FILES, last * (i + 1) // FILES
        rows.where(F.col("seq").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def request_files(spark, sf_dir, tmp_path_factory):
    return land(queries._request_log(spark, sf_dir), str(tmp_path_factory.mktemp("log") / "requests"))


@pytest.fixture(scope="module")
def check_files(spark, sf_dir, tmp_path_factory):
    return land(queries._check_log(spark, sf_dir), str(tmp_path_factory.mktemp("log") / "checks"))


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_hours_in_batches_equal_hours_at_once(spark, sf_dir, request_files, tmp_path):
    stream = stream_log(spark, request_files, REQUEST_EVENT, files_per_batch=1)
    got = hourly.hourly_so_far(stream, f"{tmp_path}/out", f"{tmp_path}/offsets")
    columns = ["source", "hour", "requests", "success", "jobs"]
    assert rows_of(got, *columns) == rows_of(
        requests.hourly_stats(queries._request_log(spark, sf_dir)), *columns
    )


def test_hours_of_files_that_come_newest_first(spark, tmp_path):
    log = spark.range(100).select(
        F.col("id").alias("seq"), F.expr("timestamp_ntz '2024-01-01 00:30:00' + make_dt_interval(0, cast(id as int))").alias("ts"),
        F.lit(None).cast("long").alias("source"), (F.col("id") % 3 > 0).alias("success"), F.lit(1.0).alias("response_time"),
        F.lit("").alias("error_type"), F.col("id").alias("jobs_count"),
    )
    for low in (66, 33, 0):
        log.where(F.col("seq").between(low, low + (33 if low == 66 else 32))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    stream = stream_log(spark, f"{tmp_path}/log", REQUEST_EVENT, files_per_batch=1)
    got = hourly.hourly_so_far(stream, f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert got.agg(F.sum("requests")).first()[0] == 100 and got.count() == 100


def test_streams_over_empty_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    log = stream_log(spark, f"{tmp_path}/in", REQUEST_EVENT)
    assert hourly.hourly_so_far(log, f"{tmp_path}/h", f"{tmp_path}/ho").count() == 0
    log = stream_log(spark, f"{tmp_path}/in", CHECK_EVENT)
    state, alerts = streaks.follow_streaks(log, f"{tmp_path}/s", f"{tmp_path}/so")
    assert state.count() == alerts.count() == 0
    pages = stream_responses(spark, f"{tmp_path}/in")
    assert ingest.ingest(pages, area_dimension(spark), f"{tmp_path}/i", f"{tmp_path}/io").count() == 0
    items = explode_items(pages, ["jobId"]).select("jobId", "page_id")
    assert ingest.write_first_seen(items, "jobId", f"{tmp_path}/f", f"{tmp_path}/fo").count() == 0


def test_rows_that_later_ones_overtook_are_counted(spark, tmp_path):
    for low, high in ((50, 59), (0, 49)):
        spark.range(low, high + 1).select(
            F.col("id").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("source"),
            (F.col("id") < 50).alias("ok"), F.lit(1.0).alias("response_time"), F.lit("").alias("error"),
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    stream = stream_log(spark, f"{tmp_path}/log", CHECK_EVENT, files_per_batch=1)
    state, _ = streaks.follow_streaks(stream, f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert [tuple(r) for r in state.collect()] == [(1, 0, 10, 59, 50)]


def test_streaks_in_batches_equal_streaks_at_once(spark, sf_dir, check_files, tmp_path):
    stream = stream_log(spark, check_files, CHECK_EVENT, files_per_batch=1)
    state, alerts = streaks.follow_streaks(stream, f"{tmp_path}/out", f"{tmp_path}/offsets", chunk_rows=50)
    # Older states are removed.
    left = sorted(p.name for p in (tmp_path / "out" / "state").glob("batch_id=*"))
    assert left == [f"batch_id={FILES - 2}", f"batch_id={FILES - 1}"]
    log = queries._check_log(spark, sf_dir)
    columns = ["source", "current_streak", "max_streak"]
    assert rows_of(state, *columns) == rows_of(checks.check_runs(log), *columns)
    columns = ["source", "seq", "streak"]
    assert rows_of(alerts, *columns) == rows_of(checks.streak_alerts(log), *columns)


def test_new_files_continue_where_the_stream_stopped(spark, sf_dir, tmp_path):
    log = queries._check_log(spark, sf_dir)
    half = log.agg(F.max("seq")).first()[0] // 2
    for part in (log.where(F.col("seq") <= half), log.where(F.col("seq") > half)):
        part.write.mode("append").parquet(f"{tmp_path}/checks")
        stream = stream_log(spark, f"{tmp_path}/checks", CHECK_EVENT)
        state, alerts = streaks.follow_streaks(stream, f"{tmp_path}/out", f"{tmp_path}/offsets")
    columns = ["source", "current_streak", "max_streak"]
    assert rows_of(state, *columns) == rows_of(checks.check_runs(log), *columns)
    assert alerts.count() == checks.streak_alerts(log).count()


def test_ingest_in_batches(spark, sf_dir, tmp_path):
    rows = samples.landed_responses(spark, sf_dir)
    for low, high in ((0, 300), (301, 900), (901, 10**9)):
        rows.where(F.col("page_id").between(low, high)).write.mode("append").parquet(f"{tmp_path}/landed")
    stream = stream_responses(spark, f"{tmp_path}/landed", files_per_batch=1)
    got = ingest.ingest(stream, area_dimension(spark), f"{tmp_path}/out", f"{tmp_path}/offsets")
    want = queries._listings(spark, sf_dir)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_a_batch_run_again_is_stored_once(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    # What a batch left behind when it failed before the stream noted it.
    spark.range(3).write.parquet(batch_path(out, 0))
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    write_batches(stream, out, f"{tmp_path}/offsets")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_first_seen_keeps_the_first_row_per_key_over_batches(spark, sf_dir, tmp_path):
    rows = samples.landed_responses(spark, sf_dir)
    for part in (1, 2, 0):
        rows.where(f"page_id % 3 = {part}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
    stream = stream_responses(spark, f"{tmp_path}/landed", files_per_batch=1)
    items = explode_items(stream, ["jobId"]).select("jobId", "page_id")
    got = ingest.write_first_seen(items, "jobId", f"{tmp_path}/out", f"{tmp_path}/offsets")
    first = {}
    for r in explode_items(rows, ["jobId"]).where("jobId is not null").select("jobId", "page_id").collect():
        place = ((r["page_id"] - 1) % 3, r["page_id"])
        first[r["jobId"]] = min(first.get(r["jobId"], place), place)
    assert sorted(map(tuple, got.collect())) == sorted((k, p) for k, (_, p) in first.items())


def test_an_old_file_brings_new_keys_and_no_copies(spark, tmp_path):
    for name, rows, age in (("a", [("x", 1), ("y", 2)], 0), ("b", [("x", 0), ("z", 3)], 9 * 86_400)):
        spark.createDataFrame(rows, "jobId string, page_id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for file in (tmp_path / "in").glob("*.parquet"):
            if name == "b" and file.name not in seen:
                os.utime(file, (file.stat().st_mtime - age,) * 2)
        seen = {f.name for f in (tmp_path / "in").glob("*.parquet")}
        stream = stream_files(spark, f"{tmp_path}/in", "jobId string, page_id long", files_per_batch=1)
        got = ingest.write_first_seen(stream, "jobId", f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 2), ("z", 3)]


def log_rows(spark, rows):
    """``(source, minute, success)`` as request log rows."""
    ts = F.expr("timestamp_ntz '2024-03-10 00:00:00' + make_dt_interval(0, 0, cast(minute as int))")
    frame = spark.createDataFrame(rows, "source long, minute long, success boolean")
    return frame.select(
        F.col("minute").alias("seq"), ts.alias("ts"), "source", "success", F.lit(1.0).alias("response_time"),
        F.lit("").alias("error_type"), F.lit(0).cast("long").alias("jobs_count"),
    )


def test_a_silent_source_is_told_without_a_row_of_its_own(spark, tmp_path):
    beat = [(1, m, True) for m in range(0, 601, 5)]
    rows = [
        *beat, (2, 3, True), (2, 20, True), (2, 150, False), (3, 7, False), (3, 300, False),
        (None, 10, True), (4, 10, True), (4, 400, True), (5, 590, True), (6, 530, None),
    ]
    for low in range(0, 601, 100):
        part = log_rows(spark, [r for r in rows if low <= r[1] < low + 100])
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    stream = stream_log(spark, f"{tmp_path}/log", REQUEST_EVENT, files_per_batch=1)
    told = streaks.watch_silence(stream, f"{tmp_path}/out", f"{tmp_path}/o", ok="success").collect()

    def minute(moment):
        return round((moment - datetime.datetime(2024, 3, 10)).total_seconds() / 60)

    got = sorted(((r["source"], minute(r["last_success"]), minute(r["silent_at"])) for r in told), key=str)
    # Source 4 falls silent twice; 3 and 6 never succeeded; 1 and 5 were heard of lately.
    assert got == sorted([(2, 20, 80), (None, 10, 70), (4, 10, 70), (4, 400, 460)], key=str)


def test_silence_goes_on_where_the_stream_stopped(spark, tmp_path):
    told = None
    for low, high in ((0, 30), (35, 140)):
        rows = [(1, m, True) for m in range(low, high, 5)] + ([(2, 0, True)] if low == 0 else [])
        log_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        stream = stream_log(spark, f"{tmp_path}/log", REQUEST_EVENT)
        told = streaks.watch_silence(stream, f"{tmp_path}/out", f"{tmp_path}/o", ok="success")
        assert told.count() == (0 if low == 0 else 1)
    assert told.first()["source"] == 2
