"""Saving to and reading from the store: files, catalog tables or a database."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.fixed_values import INSERT_BATCH
from vacanta.operators.listings import dedupe_latest, newest_first, storable
from vacanta.schemas import STORED_DAYS
from vacanta.streaming.batches import hadoop_folder

# How an existing table is treated, and the Spark save mode for it.
SAVE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def save_frame(
    df: DataFrame,
    table: str,
    if_exists: str = "append",
    path: str | None = None,
    partition_by: list[str] | None = None,
) -> bool:
    """Save to a catalog table; False when it exists and ``if_exists='fail'``.

    The write is committed as one job: a lost executor reruns its tasks and
    readers never see half a frame.
    """
    mode = SAVE_MODES[if_exists]
    if if_exists == "fail" and df.sparkSession.catalog.tableExists(table):
        return False
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return True


def save_frame_jdbc(
    df: DataFrame, url: str, table: str, if_exists: str = "append", **properties: str
) -> None:
    """Save to a database table in batches of 1000 rows per round trip.

    The driver jar must be on the class path. Each partition is one transaction.
    """
    df.write.mode(SAVE_MODES[if_exists]).format("jdbc").options(
        url=url, dbtable=table, batchsize=str(INSERT_BATCH), **properties
    ).save()


def read_frame_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    splits: int | None = None,
    **properties: str,
) -> DataFrame:
    """Scan a database table, in ``splits`` parallel ranges of ``split_column``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split_column:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=lower, upperBound=upper, numPartitions=splits
        )
    return reader.load()


CURVE_BITS = 8  # of each column's steps on the curve
# Names a row group's Bloom filter is sized for: 60 kB. More let it pass too much, never too little.
BLOOM_NAMES = 50_000


def _steps(df: DataFrame, columns: dict[str, Column]) -> list[Column]:
    """Each column in ``2^CURVE_BITS`` equal steps from its least to its greatest value; NULL is 0."""
    named = df.select(*[c.cast("double").alias(n) for n, c in columns.items()])
    ends = named.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in columns for f in (F.min, F.max)]).first()
    steps = []
    for name, column in columns.items():
        low, high = ends[f"min_{name}"], ends[f"max_{name}"]
        if low is None or low == high:
            steps.append(F.lit(0))
        else:  # width_bucket counts from 1, and the greatest value is past the last step
            step = F.width_bucket(column.cast("double"), F.lit(low), F.lit(high), F.lit(1 << CURVE_BITS))
            steps.append(F.coalesce(F.least(step, F.lit(1 << CURVE_BITS)) - 1, F.lit(0)))
    return steps


def curve_place(steps: list[Column]) -> Column:
    """Place on the Z-order curve: the bits of all steps by turns, the highest first."""
    place = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS):
        for i, step in enumerate(steps):
            at = bit * len(steps) + len(steps) - 1 - i
            one = F.shiftright(step.cast("bigint"), bit).bitwiseAND(1)
            place = place.bitwiseOR(F.shiftleft(one, at))
    return place


def save_listings(listings: DataFrame, path: str, **options: str) -> None:
    """Write the listing store: a folder per province, along a curve inside.

    Each lookup column has its access path. The folder is the province's. Inside,
    rows follow a Z-order curve of location, salary and day (of the update, else
    of publication), so a row group spans a small part of each and its least and
    greatest values let Spark skip it for ranges of any of the three. Company
    names, looked up one at a time, have a Bloom filter (or a dictionary, where
    they are few). Range partitioning splits a province with most of the rows
    over many tasks. ``options`` are those of the Parquet writer.

    The ends of the columns, the sample for the ranges and the write each read
    the rows, so these are staged beside ``path`` first: pages are parsed once.
    """
    spark, staged = listings.sparkSession, f"{path.rstrip('/')}-staged"
    listings.write.mode("overwrite").parquet(staged)
    try:
        _write_store(spark.read.schema(listings.schema).parquet(staged), path, options)
    finally:
        store, folder = hadoop_folder(spark, staged)
        store.delete(folder, True)


def _write_store(listings: DataFrame, path: str, options: dict[str, str]) -> None:
    days = {"publish_day": F.col("publish_date").cast("date"), "update_day": F.col("update_date").cast("date")}
    rows = listings.withColumns(days)
    day = F.unix_date(F.coalesce("update_day", "publish_day"))
    steps = _steps(
        rows,
        {"place": F.col("location_code").try_cast("bigint"), "salary": F.col("salary_min"), "day": day},
    )
    bloom = {"enabled": "true", "expected.ndv": str(BLOOM_NAMES)}
    filters = {f"parquet.bloom.filter.{k}#company_name": v for k, v in bloom.items()}
    (
        rows.withColumn("_curve", curve_place(steps))
        .repartitionByRange("province_code", "_curve", "job_id")
        .sortWithinPartitions("province_code", "_curve")
        .drop("_curve")
        .write.mode("errorifexists")
        .options(**{**filters, **options})
        .partitionBy("province_code")
        .parquet(path)
    )


def upsert_listings(current: DataFrame, arrived: DataFrame, path: str) -> None:
    """Store ``current`` and ``arrived`` with one row per job id, the newest.

    Files have no MERGE: the result goes to a new ``path`` and readers switch to
    it, so a reader or a rerun never meets a half-replaced store.
    """
    both = current.unionByName(arrived, allowMissingColumns=True)
    save_listings(dedupe_latest(storable(both), "job_id", newest_first()), path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Files whose columns differ, as one frame with the union of the columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_listings(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """The listing store, or some of its files; the declared schema keeps province codes as text."""
    if files is not None and not files:
        return spark.createDataFrame([], STORED_DAYS)
    return spark.read.schema(STORED_DAYS).option("basePath", path).parquet(*(files or [path]))
