"""A trigram index over the titles of the listing store.

For every three characters in a row that a title holds, in lower case, the index
lists the store's files with such titles, in folders by the hash of the trigram.
A keyword of three characters or more can stand only in files that all its
trigrams list. Those files are read and their titles compared, so a search
finds what a scan finds; a rare keyword opens few files. A shorter keyword has
no trigram and every file is read.

The index belongs to one written store; a store that is written anew gets its own.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.sources.store import read_listings

GRAM = 3
BUCKETS = 64
POSTING = "gram string, file string, bucket int"


def grams(text: Column) -> Column:
    """Distinct trigrams of a text in lower case; in linear time, however long it is."""

    def windows(chars: Column) -> Column:
        last = F.size(chars) - GRAM
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(*[F.get(chars, i + k) for k in range(GRAM)])),
        )

    # As the one element of an array the characters are taken apart once, not per window.
    return F.array_distinct(F.transform(F.array(F.split(F.lower(text), "")), windows)[0])


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_title_index(spark: SparkSession, store_path: str, path: str) -> None:
    """Write the index of a store: each trigram and file once, combined before the shuffle."""
    titles = read_listings(spark, store_path).select(
        F.explode(grams(F.col("job_title"))).alias("gram"), F.col("_metadata.file_path").alias("file")
    )
    (
        titles.distinct()
        .withColumn("bucket", _bucket(F.col("gram")))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "gram")
        .write.mode("errorifexists")
        .partitionBy("bucket")
        .parquet(path)
    )


def postings(spark: SparkSession, path: str, wanted: list[str], buckets: list[int]) -> DataFrame:
    """Index rows of some trigrams; opens only their folders."""
    index = spark.read.schema(POSTING).parquet(path)
    return index.where(F.col("bucket").isin(buckets) & F.col("gram").isin(wanted))


def files_with(spark: SparkSession, path: str, keyword: str) -> list[str] | None:
    """Files that every trigram of a keyword lists; None where it has no trigram."""
    found = spark.range(1).select(grams(F.lit(keyword)).alias("grams"))
    rows = found.select(F.explode("grams").alias("gram")).select("gram", _bucket(F.col("gram")).alias("bucket")).collect()
    if not rows:
        return None
    listed = postings(spark, path, [r["gram"] for r in rows], sorted({r["bucket"] for r in rows}))
    # As many names as the store has files, which the driver lists anyway.
    whole = listed.groupBy("file").agg(F.count("*").alias("grams")).where(F.col("grams") == len(rows))
    return sorted(r["file"] for r in whole.select("file").collect())


def listings_with(spark: SparkSession, store_path: str, index_path: str, keyword: str) -> DataFrame:
    """The part of the store that may hold a keyword in a title, for ``search_postings``."""
    return read_listings(spark, store_path, files_with(spark, index_path, keyword))
