"""An upsert store: listings in buckets by the hash of their job id.

A load rewrites the buckets that its ids fall into and no others. New versions
of buckets are written beside the old ones, then a manifest names the version
of every bucket that is live; it is written as one small table, so a reader
meets the store before a load or after it, and a load that failed leaves
nothing that is read. Of the manifests the last two are kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.operators.listings import dedupe_latest, newest_first, storable
from vacanta.schemas import STORED_LISTING
from vacanta.streaming.batches import batch_path, drop_batch, read_batches

BUCKETS = 64
MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("load", T.LongType())])


def live_buckets(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """Number of the newest manifest (-1 before the first) and its load per bucket."""
    named = read_batches(spark, f"{path}/manifest", MANIFEST).collect()  # two rows a bucket at most
    newest = max((r["batch_id"] for r in named), default=-1)
    return newest, {r["bucket"]: r["load"] for r in named if r["batch_id"] == newest}


def _read(spark: SparkSession, path: str, buckets: dict[int, int]) -> DataFrame:
    if not buckets:
        return spark.createDataFrame([], STORED_LISTING)
    data = f"{path}/data"
    folders = [f"{data}/load={load}/bucket={bucket}" for bucket, load in sorted(buckets.items())]
    return spark.read.schema(STORED_LISTING).parquet(*folders)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The live rows: one per job id."""
    return _read(spark, path, live_buckets(spark, path)[1])


def upsert(path: str, arrived: DataFrame) -> list[int]:
    """Store the newest copy of each id that arrived or was there; returns the buckets written.

    Rows that lack a required field are left out, as in the plain store. A rerun
    of a load that failed starts from the same manifest and gives the same store.
    """
    spark = arrived.sparkSession
    number, live = live_buckets(spark, path)
    load = number + 1
    bucket = F.pmod(F.xxhash64("job_id"), F.lit(BUCKETS)).cast("int")
    columns = [f.name for f in T.StructType.fromDDL(STORED_LISTING)]
    newest = dedupe_latest(storable(arrived), "job_id", newest_first()).select(*columns)
    newest.write.mode("overwrite").parquet(f"{path}/arrived/load={load}")
    came = spark.read.schema(STORED_LISTING).parquet(f"{path}/arrived/load={load}")
    touched = sorted(r[0] for r in came.select(bucket).distinct().collect())  # at most BUCKETS
    if not touched:
        return []
    known = _read(spark, path, {b: live[b] for b in touched if b in live})
    merged = dedupe_latest(known.unionByName(came), "job_id", newest_first())
    (  # a bucket is written by one task: one file, and not one from every task
        merged.withColumn("bucket", bucket)
        .repartition("bucket")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(f"{path}/data/load={load}")
    )
    rows = sorted({**live, **dict.fromkeys(touched, load)}.items())
    manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    manifest.write.mode("overwrite").parquet(batch_path(f"{path}/manifest", load))
    drop_batch(spark, f"{path}/manifest", load - 2)
    return touched
