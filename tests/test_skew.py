"""One key with a third of all rows, or copies without end: whole results."""

import pytest
from pyspark.sql import functions as F

from vacanta.operators import listings, ordered, tasks
from vacanta.sources import store
from vacanta.sources.areas import city_codes

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Rows whose key is 0 in a third of the cases, else one of many."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    return spark.range(N, numPartitions=6).select(key.alias("key"), F.col("id").alias("seq")).cache()


def newest(n):
    """key -> its highest ``n`` numbers, by plain Python"""
    seen = {}
    for i in range(N):
        seen.setdefault(0 if i % 3 == 0 else i % 997, []).append(i)
    return {k: sorted(v)[-n:] for k, v in seen.items()}


def test_dedupe_and_what_it_shuffles(spark, hot):
    rows = hot.withColumn("text", F.lit("x" * 100))
    df = listings.dedupe_latest(rows, "key", [F.col("seq").desc()])
    assert {r["key"]: r["seq"] for r in df.collect()} == {k: v[0] for k, v in newest(1).items()}
    # Per task at most one row a key may cross the shuffle.
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_last_rows_of_a_hot_source(hot):
    got = {}
    for r in ordered.last_rows(hot.withColumnRenamed("key", "source"), 5).collect():
        got.setdefault(r["source"], []).append(r["seq"])
    assert {k: sorted(v) for k, v in got.items()} == newest(5)


def test_first_pair_of_a_hot_name(spark):
    lines = spark.range(N).select(
        F.col("id").alias("line"),
        F.concat(F.lit('"'), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit('":"'),
                 F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")),
                 F.lit('"')).alias("text"),
    )
    got = {r["name"]: r["code"] for r in city_codes(lines).collect()}
    assert got["hot"] == "000000" and got["1"] == "000001"
    assert len(got) == 1 + sum(i % 3 != 0 for i in range(N))


def test_page_copies_without_end(spark):
    copies = spark.range(N).select(
        F.col("id").alias("page_id"), F.lit("kw").alias("kw"), F.lit("c").alias("city"),
        (F.col("id") % 4 + 1).alias("page"), (F.col("id") % 4 != 2).alias("good"),
    )
    taken = tasks.pages_until_bad(copies, ["kw", "city"]).collect()
    assert sorted((r["page"], r["page_id"]) for r in taken) == [(1, 0), (2, 1)]


def test_store_splits_a_hot_province(spark, tmp_path):
    view = spark.range(N).select(
        *[F.lit(None).cast("string").alias(c) for c in (
            "company_type", "company_size", "salary_range", "city_name", "district", "job_describe",
            "work_experience", "degree_requirement", "job_url", "company_url")],
        F.lit(None).cast("timestamp_ntz").alias("publish_date"),
        F.lit(None).cast("timestamp_ntz").alias("update_date"),
        F.current_timestamp().alias("created_at"), F.col("id").alias("page_id"),
        F.lit(0).alias("pos"), F.col("id").cast("string").alias("job_id"), F.lit("t").alias("job_title"),
        F.lit("c").alias("company_name"), F.lit(1).alias("salary_min"), F.lit(2).alias("salary_max"),
        F.lit("010100").alias("location_code"), F.lit("010000").alias("province_code"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.save_listings(view, f"{tmp_path}/store")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = store.read_listings(spark, f"{tmp_path}/store")
    files = rows.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == N and len(files) == 8
    assert max(r["count"] for r in files) < N / 4
    assert rows.select("province_code").distinct().first()[0] == "010000"


def test_upsert_keeps_the_newest_copy(spark, tmp_path):
    from vacanta.schemas import STORED_LISTING

    def load(page_id, ids, title):
        return spark.createDataFrame(
            [(page_id, 0, i, title, "c") for i in ids],
            "page_id long, pos int, job_id string, job_title string, company_name string",
        ).withColumn("location_code", F.lit("010100")).withColumn("province_code", F.lit("010000")) \
            .withColumn("salary_min", F.lit(1)).withColumn("update_date", F.lit(None).cast("timestamp_ntz"))

    empty = spark.createDataFrame([], STORED_LISTING)
    store.upsert_listings(empty, load(1, ["a", "b", "b", None], "old"), f"{tmp_path}/1")
    first = store.read_listings(spark, f"{tmp_path}/1")
    store.upsert_listings(first, load(2, ["b", "c"], "new"), f"{tmp_path}/2")
    got = store.read_listings(spark, f"{tmp_path}/2").select("job_id", "job_title").collect()
    assert sorted(map(tuple, got)) == [("a", "old"), ("b", "new"), ("c", "new")]
