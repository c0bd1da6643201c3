"""The upsert store: exact, and as much work as the arrivals ask for."""

from pyspark.sql import functions as F

from vacanta.sources import upsert


def load(spark, ids, page, title):
    rows = [(page, i, f"{title} {i}", "Company", "050200", f"2024-01-{page:02d} 00:00:00") for i in ids]
    df = spark.createDataFrame(rows, "page_id bigint, job_id string, job_title string, company_name string, location_code string, at string")
    df = df.withColumn("update_date", F.col("at").cast("timestamp_ntz")).withColumn("pos", F.lit(0)).drop("at")
    fields = {n: t for part in upsert.STORED_LISTING.split(",") for n, t in [part.split()]}
    return df.withColumns({n: F.lit(None).cast(t) for n, t in fields.items() if n not in df.columns})


def stored(spark, path):
    return {r["job_id"]: r["job_title"] for r in upsert.read_upserted(spark, path).collect()}


def test_loads_add_up_and_only_touched_buckets_are_written(spark, tmp_path):
    path = f"{tmp_path}/store"
    assert stored(spark, path) == {}
    ids = [f"J{i}" for i in range(300)]
    first = upsert.upsert(path, load(spark, ids, 2, "old"))
    assert len(first) > 50
    second = upsert.upsert(path, load(spark, ["J7", "J7", "new"], 3, "new"))
    assert 1 <= len(second) <= 2
    folders = sorted(p.name for p in (tmp_path / "store/data/load=1").glob("bucket=*"))
    assert folders == sorted(f"bucket={b}" for b in second)
    assert stored(spark, path) == {**{i: f"old {i}" for i in ids}, "J7": "new J7", "new": "new new"}
    # An older copy that comes late does not replace the newer one.
    upsert.upsert(path, load(spark, ["J7", "J8"], 1, "late"))
    got = stored(spark, path)
    assert got["J7"] == "new J7" and got["J8"] == "old J8" and len(got) == 301
    assert sorted(p.name for p in (tmp_path / "store/manifest").glob("*=*")) == ["batch_id=1", "batch_id=2"]


def test_a_load_of_nothing_and_one_that_failed_midway(spark, tmp_path):
    path = f"{tmp_path}/store"
    upsert.upsert(path, load(spark, ["a", "b"], 1, "x"))
    assert upsert.upsert(path, load(spark, [], 1, "x")) == []
    # What a load wrote before it failed: data without a manifest.
    load(spark, ["zzz"], 9, "lost").write.parquet(f"{path}/data/load=1/bucket=0")
    assert stored(spark, path) == {"a": "x a", "b": "x b"}
    upsert.upsert(path, load(spark, ["c"], 2, "y"))
    assert stored(spark, path) == {"a": "x a", "b": "x b", "c": "y c"}
