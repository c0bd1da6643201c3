"""Continuous ingest of landed responses, and dedupe on the stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.operators.envelope import explode_items
from vacanta.operators.listings import clean_items
from vacanta.streaming.batches import batch_path, drop_batch, read_batches, run_batches, write_batches
from vacanta.streaming.levels import LevelledTable


def stream_listings(responses: DataFrame, areas: DataFrame) -> DataFrame:
    """Clean listing rows of a response stream; stateless, row by row."""
    return clean_items(explode_items(responses), areas)


def ingest(
    responses: DataFrame, areas: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> DataFrame:
    """Append the cleaned listings of every landed response to ``path``."""
    rows = stream_listings(responses, areas)
    write_batches(rows, path, checkpoint, trigger=trigger)
    return read_batches(responses.sparkSession, path, rows.schema).drop("batch_id")


def first_seen_index(
    spark: SparkSession, items: DataFrame, key: str, path: str, order: tuple[str, ...] = ("page_id",), **sizes: int
) -> LevelledTable:
    """The stored first arrivals, by key; ``sizes`` are those of ``LevelledTable``."""
    others = [c for c in items.columns if c != key and c not in order]
    return LevelledTable(spark, path, items.select(key, *order, *others).schema, [key], **sizes)


def add_first_seen(index: LevelledTable, batch: DataFrame, batch_id: int, order: tuple[str, ...]) -> None:
    """Store the rows of a batch whose key no earlier batch stored.

    Where stored runs have folders, the batch's own keys are written first and
    say which of these to open.
    """
    (key,) = index.key
    values = [f.name for f in index.schema if f.name != key]
    others = [c for c in values if c not in order]
    keyed = batch.where(F.col(key).isNotNull()).groupBy(key)
    if len(values) == 1:  # a plain minimum is hashed, one of structs is sorted; NULL is least in both
        value = F.col(values[0])
        first = keyed.agg(F.when(~F.bool_or(value.isNull()), F.min(value)).alias(values[0]))
    else:
        first = keyed.agg(F.min(F.struct(*order, *others)).alias("first")).select(key, "first.*")
    known = index.runs(before=batch_id)
    touched = None
    if any(run.bits for run in known):
        staged = batch_path(f"{index.path}/arrived", batch_id)
        first.write.mode("overwrite").parquet(staged)
        first = index.spark.read.schema(first.schema).parquet(staged)
        touched = index.touched(first, known)
    seen = index.read(known, touched).select(key)
    index.add(first.join(seen, key, "left_anti") if known else first, batch_id)
    drop_batch(index.spark, f"{index.path}/arrived", batch_id)


def write_first_seen(
    items: DataFrame, key: str, path: str, checkpoint: str, order: tuple[str, ...] = ("page_id",),
    trigger: dict | None = None,
) -> DataFrame:
    """First arrival of each key: of the earliest batch, and there the least by ``order``.

    A batch keeps one row per key, merged on the map side, and stores those
    whose key no earlier batch stored. Nothing is forgotten, so a copy may come
    at any time; what was stored lies in a few runs, whatever the number of
    batches. Rows without key are left out.
    """
    index = first_seen_index(items.sparkSession, items, key, path, order)
    run_batches(items, checkpoint, lambda batch, n: add_first_seen(index, batch, n, order), trigger)
    return index.read()
