"""Running a stream in micro-batches, and the folders these write.

Each micro-batch overwrites the folder named after its id, so a batch that is
run again after a failure leaves one result and not two.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# By default a stream takes what has landed and ends; {"processingTime": "1 minute"}
# and the like go on until the query is stopped.
LANDED = {"availableNow": True}


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def hadoop_folder(spark: SparkSession, path: str):
    """File system and path object of a folder, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove the folder of a batch that nothing reads any more."""
    store, folder = hadoop_folder(spark, batch_path(path, batch_id))
    store.delete(folder, True)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything the batches wrote, with ``batch_id``; no rows before the first batch."""
    whole = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    store, folder = hadoop_folder(spark, path)
    if not store.exists(folder):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(path)


def run_batches(
    stream: DataFrame, checkpoint: str, fold: Callable[[DataFrame, int], None], trigger: dict | None = None,
    mode: str = "append",
) -> None:
    """Hand every micro-batch to ``fold``; returns when the query ends or is stopped."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**(trigger or LANDED))
        .foreachBatch(fold)
        .start()
    )
    query.awaitTermination()


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    trigger: dict | None = None,
    mode: str = "append",
) -> None:
    """Store every micro-batch, or what ``transform`` makes of it, in its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(batch_path(path, batch_id))

    run_batches(stream, checkpoint, write, trigger, mode)
