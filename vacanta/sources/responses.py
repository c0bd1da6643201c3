"""Landed responses as batch or stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.schemas import RESPONSE


FILES_PER_BATCH = 1000
FILE_AGE = "36500d"  # by default a stream passes over files a week older than the newest


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan landed responses (``parquet``, ``json``, ``orc``, ...) without inference."""
    return spark.read.format(fmt).schema(RESPONSE).load(path)


def stream_files(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """An unbounded scan: every new file is read once, oldest first, however old it is.

    A batch takes at most ``files_per_batch`` files, so a backlog is many
    batches and not one.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_responses(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """Landed responses as a stream.

    Adds ``landed_at``, the time of the file, which is never NULL.
    """
    rows = stream_files(spark, path, RESPONSE, fmt, files_per_batch)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def read_log(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Scan a recorded event log (request, check or task events)."""
    return spark.read.format(fmt).schema(schema).load(path)


def stream_log(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    return stream_files(spark, path, schema, fmt, files_per_batch)
