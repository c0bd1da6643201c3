"""Failure streaks and alerts as checks arrive, and alerts for silent sources.

The state is one row per source: the run of failures it ends with and the
longest run so far. A micro-batch is read once, into chunks of outcome codes
that split a busy source over tasks (``ordered.chunk_codes``); new states and
alerts both come from that small table. The state of batch n is a table of its
own, built from that of batch n-1, so a rerun batch starts from the same state.

Rows count in the order they arrive: by batch, and by ``seq`` inside a batch.
A row that comes after a later one of its source was folded still counts at
its arrival; ``overtaken`` says how many there were.
"""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from vacanta.fixed_values import ALERT_STREAK, HEALTH_SILENT_HOURS
from vacanta.operators.ordered import (
    CODE_ROWS,
    SEGMENT,
    chunk_codes,
    earlier_runs,
    streaks_of_chunks,
    with_carry,
    with_segment,
)
from vacanta.streaming.batches import batch_path, drop_batch, read_batches, write_batches

STATE = "source bigint, current_streak bigint, max_streak bigint, last_seq bigint, overtaken bigint"
ALERTS = "source bigint, seq bigint, streak bigint"
SILENCE = "source bigint, last_success timestamp_ntz, silent_at timestamp_ntz"


def _state_before(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame:
    if batch_id == 0:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(batch_path(state_path, batch_id - 1))


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """State after the newest batch; only the last two are there."""
    states = read_batches(spark, f"{path}/state", StructType.fromDDL(STATE))
    newest = states.agg(F.max("batch_id")).first()[0]
    return states.where(F.col("batch_id") == F.lit(newest)).drop("batch_id")


def _with_state(chunks: DataFrame, state: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of a batch and a row per known source ahead of them, all with ``carry``,
    ``last_seq`` and ``overtaken``.

    A chunk that begins before its source's last number holds rows that came too
    late for their place.
    """
    seq = F.col("chunk") * chunk_rows + F.shiftright(F.element_at("codes", -1), 1)
    source = F.struct(F.col("source").alias("source")).alias("_source")
    known = chunks.join(
        state.select(source, F.col("last_seq").alias("reached")), F.col("source") == F.col("_source"), "left"
    )
    place = F.col("reached") - F.col("chunk") * chunk_rows
    late = F.size(F.filter("codes", lambda c: F.shiftright(c, 1) < place)).cast("bigint")
    came = known.select(
        "source", "chunk", "codes", *SEGMENT, seq.alias("last_seq"),
        F.when(F.col("reached").isNull(), 0).otherwise(late).alias("overtaken"),
    )
    nodes = came.unionByName(earlier_runs(state, "last_seq", "overtaken"), allowMissingColumns=True)
    # A batch is no whole log: one level of groups is enough.
    return with_carry(nodes, levels=1)


def _state_after(carried: DataFrame) -> DataFrame:
    trail = F.when(F.col("broken"), F.col("trail")).otherwise(F.col("carry") + F.col("n"))
    return carried.groupBy("source").agg(
        F.max_by(trail, "chunk").alias("current_streak"),
        F.max(F.greatest("best", F.col("carry") + F.col("lead"))).alias("max_streak"),
        F.max("last_seq").alias("last_seq"),
        F.sum("overtaken").alias("overtaken"),
    ).withColumn("source", F.col("source.source"))


def follow_streaks(
    checks: DataFrame,
    path: str,
    checkpoint: str,
    alert_streak: int = ALERT_STREAK,
    chunk_rows: int = CODE_ROWS,
    trigger: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fold all landed checks; returns the final state and the alerts raised."""
    state_path, alert_path = f"{path}/state", f"{path}/alerts"
    spark = checks.sparkSession
    kept: list[DataFrame] = []

    def fold(batch: DataFrame, batch_id: int) -> DataFrame:
        state = _state_before(spark, state_path, batch_id)
        chunks = with_segment(chunk_codes(batch.where("seq is not null"), "ok", chunk_rows))
        # What a lost executor kept of it is read from the batch's files again.
        carried = _with_state(chunks, state, chunk_rows).persist(StorageLevel.MEMORY_AND_DISK)
        while kept:
            kept.pop().unpersist()
        kept.append(carried)
        _state_after(carried).write.mode("overwrite").parquet(batch_path(state_path, batch_id))
        # The state before the last is needed by no rerun.
        drop_batch(spark, state_path, batch_id - 2)
        return streaks_of_chunks(carried, alert_streak, chunk_rows)

    write_batches(checks.select("source", "seq", "ok"), alert_path, checkpoint, fold, trigger)
    while kept:
        kept.pop().unpersist()
    alerts = read_batches(spark, alert_path, StructType.fromDDL(ALERTS)).drop("batch_id")
    return latest_state(spark, path), alerts


# --- silence ------------------------------------------------------------------


def _last_successes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch and source the last success: a busy source is a few rows."""
    for batch in batches:
        good = pa.Table.from_batches([batch]).filter(batch.column("good"))
        last = good.group_by("source").aggregate([("micros", "max")])
        yield from last.select(["source", "micros_max"]).rename_columns(["source", "micros"]).to_batches()


def _silence_watch(silent_ms: int) -> StatefulProcessor:
    def timer(micros: int) -> int:
        return -(-micros // 1000) + silent_ms  # not before the whole span has passed

    class Watch(StatefulProcessor):
        """Keeps a source's last success and a timer at the end of its patience."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "micros long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            newest = max(int(r["micros"].max()) for r in rows)
            known = self.last.get()[0] if self.last.exists() else None
            if known is None or newest > known:
                if known is not None:
                    self.handle.deleteTimer(timer(known))
                self.last.update((newest,))
                self.handle.registerTimer(timer(newest))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            told = {"source": [key[0]], "micros": [self.last.get()[0]], "millis": [expiredTimerInfo.getExpiryTimeInMs()]}
            yield pd.DataFrame(told).astype({"source": "Int64"})

        def close(self) -> None:
            pass

    return Watch()


def watch_silence(
    log: DataFrame, path: str, checkpoint: str, ok: str = "ok", hours: int = HEALTH_SILENT_HOURS,
    delay: str = "10 minutes", trigger: dict | None = None,
) -> DataFrame:
    """Alerts for sources whose last success lies ``hours`` back on the stream's clock:
    ``source, last_success, silent_at``.

    The clock is the newest event of any source less ``delay``; no row of the
    silent source has to come. Each silence is told once, when its timer fires,
    and a source that never succeeded cannot fall silent. State and timers are
    Spark's own, one row per source in RocksDB.
    """
    spark = log.sparkSession
    epoch, zero = F.timestamp_seconds(F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz")
    moment = epoch + (F.col("ts") - zero)  # ``ts`` as UTC, whatever the session's zone
    # Every row moves the clock. Only successes reach the state; the filter stands
    # in the function, as Spark would move one before the watermark.
    marked = log.select("source", moment.alias("moment"), F.coalesce(F.col(ok), F.lit(False)).alias("good"))
    reduced = (
        marked.withWatermark("moment", delay)
        .select("source", "good", F.unix_micros("moment").alias("micros"))
        .mapInArrow(_last_successes, "source bigint, micros bigint")
    )
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        alerts = reduced.groupBy("source").transformWithStateInPandas(
            _silence_watch(hours * 3_600_000), "source bigint, micros bigint, millis bigint", "Append", "EventTime"
        )
        told = alerts.select(
            "source",
            (zero + (F.timestamp_micros("micros") - epoch)).alias("last_success"),
            (zero + (F.timestamp_millis("millis") - epoch)).alias("silent_at"),
        )
        write_batches(told, path, checkpoint, trigger=trigger)
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return read_batches(spark, path, StructType.fromDDL(SILENCE)).drop("batch_id")
