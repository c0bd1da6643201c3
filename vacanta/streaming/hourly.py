"""Hourly request statistics as events arrive.

Counts and sums add up, so each batch stores its own part of every hour it saw
and reading adds the parts. That is exact for any order of arrival, however
late. Parts are merged level by level, so an hour has a few of them whatever
the number of batches.

An hour is closed once the stream's clock, the newest event less ``delay``, has
passed its end; Spark's watermark decides that and gives each hour out once.
What comes later is left out there, and ``corrections`` has it: the difference
to the exact numbers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.functions.times import hour_label
from vacanta.operators.ordered import join_by_source
from vacanta.operators.requests import hourly_stats
from vacanta.streaming.batches import read_batches, run_batches, write_batches
from vacanta.streaming.levels import LevelledTable

COUNTS = ["requests", "success", "jobs"]
DELAY = "10 minutes"


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("source", "hour").agg(*[F.sum(n).alias(n) for n in COUNTS])


def hour_parts(log: DataFrame, path: str, **sizes: int) -> LevelledTable:
    """The table of parts; ``sizes`` are those of ``LevelledTable``."""
    return LevelledTable(log.sparkSession, path, hourly_stats(log).schema, ["source", "hour"], _added, **sizes)


def hourly_so_far(log: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> DataFrame:
    """Statistics over everything that has landed, by source and hour."""
    parts = hour_parts(log, path)
    run_batches(log, checkpoint, lambda batch, n: parts.add(hourly_stats(batch), n), trigger)
    return _added(parts.read())


def closed_hours(
    log: DataFrame, path: str, checkpoint: str, delay: str = DELAY, trigger: dict | None = None
) -> DataFrame:
    """Statistics of the hours that the watermark has closed, each given out once.

    The state holds the open hours only. A watermark needs moments with a zone:
    ``ts`` is taken as UTC and the hours are written without, so no session zone
    moves them.
    """
    jobs = F.when(F.col("success"), F.col("jobs_count"))
    epoch, zero = F.timestamp_seconds(F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz")
    moment = epoch + (F.col("ts") - zero)
    closed = (
        log.select("source", "success", "jobs_count", moment.alias("moment"))
        .withWatermark("moment", delay)
        .groupBy("source", F.window("moment", "1 hour"))
        .agg(
            F.count("*").alias("requests"),
            F.count_if("success").alias("success"),
            F.coalesce(F.sum(jobs), F.lit(0)).alias("jobs"),
        )
        .select("source", hour_label(zero + (F.col("window.start") - epoch)).alias("hour"), *COUNTS)
    )
    write_batches(closed, path, checkpoint, trigger=trigger)
    return read_batches(log.sparkSession, path, closed.schema).drop("batch_id")


def exact_hours(closed: DataFrame, fixes: DataFrame) -> DataFrame:
    """Closed hours with their corrections."""
    return _added(closed.unionByName(fixes))


def corrections(so_far: DataFrame, closed: DataFrame) -> DataFrame:
    """What has to be added to closed hours, and the hours that came when they were
    closed already, so that both together are exact up to the newest closed hour."""
    newest = closed.agg(F.max("hour").alias("newest"))
    gone = closed.select("source", "hour", *[(-F.col(n)).alias(n) for n in COUNTS])
    until = so_far.join(F.broadcast(newest), F.col("hour") <= F.col("newest")).drop("newest")
    rest = _added(until.unionByName(gone))
    return rest.where(" or ".join(f"{n} <> 0" for n in COUNTS))
