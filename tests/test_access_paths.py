"""Lookups by any column skip row groups; keyword searches open only some files."""

import pytest
from pyspark.sql import functions as F

from vacanta.operators import search
from vacanta.schemas import STORED_LISTING
from vacanta.sources import store, title_index

N = 40_000


@pytest.fixture(scope="module")
def listings(spark):
    """Listings of two provinces with many companies; dates, salaries and places are spread."""
    i = F.col("id")
    mixed = F.pmod(F.xxhash64("id"), F.lit(1_000_003))
    title = F.concat(
        F.when(i % 3 == 0, "Python Ingenieur ").when(i % 3 == 1, "Data 数据 Analyst ").otherwise("Sales "), (i % 50).cast("string"),
        F.when(i == 777, " Quetzal 😀 hüter").otherwise(""),
    )
    values = {
        "page_id": i, "pos": F.lit(0), "job_id": F.concat(F.lit("J"), i.cast("string")), "job_title": F.when(i % 97 != 5, title),
        "company_name": F.concat(F.lit("Company "), (mixed % 20_000).cast("string")),
        "salary_min": (mixed % 977).cast("int"), "salary_max": (mixed % 977 + 50).cast("int"),
        "location_code": F.concat(F.when(i % 4 == 0, "05").otherwise("03"), F.lpad((mixed % 89).cast("string"), 2, "0"), F.lit("00")),
        "publish_date": F.expr("timestamp_ntz '2023-01-01 00:00:00' + make_dt_interval(cast(pmod(xxhash64(id, 7), 700) as int))"),
        "province_code": F.when(i % 4 == 0, "050000").otherwise("030000"),
    }
    values["update_date"] = F.when(i % 11 != 0, F.col("publish_date") + F.expr("interval 5 hours"))
    rows = spark.range(N).withColumns({k: v for k, v in values.items() if k != "update_date"})
    rows = rows.withColumn("update_date", values["update_date"]).drop("id")
    names = [c.split()[0] for c in STORED_LISTING.split(", ")]
    types = dict(c.split() for c in STORED_LISTING.split(", "))
    return rows.select(*[F.col(n) if n in rows.columns else F.lit(None).cast(types[n]).alias(n) for n in names])


@pytest.fixture(scope="module")
def stored(spark, listings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "listings")
    store.save_listings(listings, path, **{"parquet.block.size": "65536", "parquet.page.size.row.check.min": "200"})
    return path


def rows_scanned(df):
    """Rows that the file scans gave to the filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()

    def walk(node):
        if node.nodeName().startswith("Scan"):
            return node.metrics().apply("numOutputRows").value()
        inner = [node.plan()] if node.nodeName().endswith("QueryStage") else []
        children = node.children()
        return sum(map(walk, inner + [children.apply(k) for k in range(children.size())]))

    return walk(plan)


LOOKUPS = {
    "company": (lambda v: search.by_company(v, "Company 4711"), 0.2),
    "publish_date": (lambda v: search.by_publish_date(v, "2024-03-01", "2024-03-08"), 0.5),
    "salary": (lambda v: search.by_salary_range(v, 930, 1100), 0.5),
    "location": (lambda v: search.by_location(v, "050700"), 0.2),
}


@pytest.mark.parametrize("name", LOOKUPS)
def test_lookups_skip_row_groups_and_find_all(spark, stored, listings, name):
    lookup, share = LOOKUPS[name]
    found = lookup(store.read_listings(spark, stored))
    want = sorted(r["job_id"] for r in lookup(listings).select("job_id").collect())
    assert sorted(r["job_id"] for r in found.select("job_id").collect()) == want and want
    assert rows_scanned(found.select("job_id", "company_name", "salary_max")) < share * N


def test_recent_inserts_reads_few_rows(spark, stored, listings):
    now = F.lit("2024-11-30 00:00:00").cast("timestamp_ntz")
    counted = search.recent_inserts(store.read_listings(spark, stored), now, hours=200)
    assert counted.first()[0] == search.recent_inserts(listings, now, hours=200).first()[0] > 0
    assert rows_scanned(counted) < 0.5 * N


def test_the_curve_takes_the_bits_by_turns(spark):
    row = spark.range(1).select(store.curve_place([F.lit(0b10000001), F.lit(0b10000000)]).alias("z")).first()
    assert row["z"] == (0b11 << 14) | 0b10


def test_columns_without_values_have_no_step(spark, tmp_path):
    empty = spark.createDataFrame([], STORED_LISTING)
    one = spark.createDataFrame([(1, "j", "t", "c", "03", "030000")], "page_id long, job_id string, job_title string, company_name string, location_code string, province_code string")
    for n, rows in enumerate((empty, empty.unionByName(one, allowMissingColumns=True))):
        store.save_listings(rows, f"{tmp_path}/{n}")
        if n:
            assert store.read_listings(spark, f"{tmp_path}/{n}").count() == 1


# --- keywords -------------------------------------------------------------------


@pytest.fixture(scope="module")
def indexed(spark, stored, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "titles")
    title_index.build_title_index(spark, stored, path)
    return path


KEYWORDS = [
    "python", "PYTHON INGENIEUR 3", "数据 analyst", "quetzal", "QUETZAL 😀 HÜ", "😀 hüt", "😀", "les 4", "3", "es", "", "nowhere at all", "eur 49",
]


@pytest.mark.parametrize("keyword", KEYWORDS)
def test_keywords_find_what_a_scan_finds(spark, stored, indexed, listings, keyword):
    view = title_index.listings_with(spark, stored, indexed, keyword)
    found = search.search_postings(view, keyword=keyword, page_size=10 * N).select("job_id").collect()
    scan = search.search_postings(listings, keyword=keyword, page_size=10 * N).select("job_id").collect()
    assert [r["job_id"] for r in found] == [r["job_id"] for r in scan]


def test_a_rare_keyword_opens_one_file_and_its_folders(spark, stored, indexed):
    paths = store.read_listings(spark, stored).select("_metadata.file_path").distinct().collect()
    every = {r["file_path"] for r in paths}
    files = title_index.files_with(spark, indexed, "Quetzal")
    assert len(files) == 1 < len(every) and set(files) < every
    assert title_index.files_with(spark, indexed, "zzz") == []
    assert title_index.files_with(spark, indexed, "zz") is None
    rows = title_index.postings(spark, indexed, ["que"], [3])
    assert "PartitionFilters: [isnotnull(bucket" in rows._jdf.queryExecution().executedPlan().toString()


def test_grams(spark):
    def of(text):
        row = spark.createDataFrame([(text,)], "t string").select(title_index.grams(F.col("t")).alias("g")).first()
        return row["g"]

    assert of("AbcABC") == ["abc", "bca", "cab"] and of("ab") is None and of(None) is None and of("") is None
    assert of("日本語で") == ["日本語", "本語で"]
    assert len(of("x y" * 50_000)) == 3
