from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vacanta.operators import listings, search, sql
from vacanta.plans import queries
from vacanta.sources import store
from vacanta.sources.workspace import new_folder, work_folder


@pytest.fixture
def name(request):
    return "t_" + request.node.name.replace("[", "_").replace("]", "")


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_save_modes(spark, tmp_path, name):
    path = f"{tmp_path}/table"
    a, b = spark.range(3), spark.range(10, 12)
    assert store.save_frame(a, name, "fail", path=path)
    assert store.save_frame(b, name, "append", path=path)
    assert numbers(spark.table(name)) == [0, 1, 2, 10, 11]
    assert not store.save_frame(b, name, "fail", path=path)
    assert numbers(spark.table(name)) == [0, 1, 2, 10, 11]
    assert store.save_frame(b, name, "replace", path=path)
    assert numbers(spark.table(name)) == [10, 11]
    with pytest.raises(KeyError):
        store.save_frame(a, name, "upsert", path=path)


def test_append_twice_then_dedupe_is_append_once(spark, tmp_path, name):
    rows = spark.range(100).select(
        (F.col("id") % 30).cast("string").alias("job_id"), F.col("id").alias("page_id"),
        F.lit(0).alias("pos"), F.lit(None).cast("timestamp_ntz").alias("update_date"),
    )
    once = sorted(listings.dedupe_latest(rows, "job_id", listings.newest_first()).collect())
    path = f"{tmp_path}/table"
    store.save_frame(rows, name, path=path)
    store.save_frame(rows, name, path=path)
    twice = spark.table(name)
    assert twice.count() == 200
    assert sorted(listings.dedupe_latest(twice, "job_id", listings.newest_first()).collect()) == once
    assert {r["page_id"] for r in once} == set(range(70, 100))


def test_statements(spark, tmp_path, name):
    sql.execute_sql(spark, f"create table {name} (a int, b string) using parquet location '{tmp_path}/t'")
    sql.execute_sql(spark, f"insert into {name} values (%s, %s)", [1, "x %s"])
    sql.execute_sql(spark, f"insert into {name} values (:a, :b)", {"a": 2, "b": "y"})
    sql.execute_sql(spark, f"insert into {name} select :param_0, 'z'", 3)
    got = sql.execute_query(spark, f"select a, b from {name} where a >= :low", {"low": 1})
    assert sorted(map(tuple, got.collect())) == [(1, "x %s"), (2, "y"), (3, "z")]
    frame = spark.range(4)
    assert sql.execute_query(spark, "select count(*) from {f} where id > :n", {"n": 1}, f=frame).first()[0] == 2
    profile = {r["table_name"]: tuple(r)[1:] for r in sql.table_profile(spark, [name, "nowhere"]).collect()}
    assert profile == {name: (True, 3), "nowhere": (False, 0)}


def test_lookups_reach_the_scan(spark, sf_dir):
    rows = queries._store(spark, sf_dir)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    by_location = plan(search.by_location(rows, "050200"))
    assert "PartitionFilters: [isnotnull(province_code" in by_location
    assert "EqualTo(location_code,050200)" in by_location
    assert "GreaterThanOrEqual(salary_min,1000)" in plan(search.by_salary_range(rows, 1000, 2000))
    assert "EqualTo(company_name,x)" in plan(search.by_company(rows, "x"))
    assert "GreaterThanOrEqual(publish_date" in plan(search.by_publish_date(rows, "1998-01-01", "1999-01-01"))
    assert "TakeOrderedAndProject" in plan(search.search_postings(rows, keyword="a"))


def test_result_pages_do_not_overlap(spark, sf_dir):
    rows = queries._store(spark, sf_dir)
    pages = [[r["job_id"] for r in search.search_postings(rows, "sales", page=p).collect()] for p in (1, 2, 3)]
    every = search.search_postings(rows, "sales", page_size=60).collect()
    assert sum(pages, []) == [r["job_id"] for r in every]
    with pytest.raises(ValueError):
        search.search_postings(rows, metro="line 2")


class Session:
    """As much of a session as the folder choice looks at."""

    def __init__(self, master, shared=None):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")
        self.conf = SimpleNamespace(get=lambda key, default: shared or default)


def test_work_folder_follows_the_session():
    shared = Session("yarn", "hdfs://shared/folder/")
    assert work_folder(shared) == "hdfs://shared/folder/vacanta/app-yarn"
    assert new_folder(shared, "a") != new_folder(shared, "a")
    with pytest.raises(ValueError):
        work_folder(Session("yarn"))
    local = Session("local[2]")
    assert work_folder(local) == work_folder(local)
