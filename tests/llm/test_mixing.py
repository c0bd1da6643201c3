import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.frames import awkward, none
from vacanta.llm import mixing
from vacanta.llm.queries import op6_mixing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=12))
def test_targets(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert abs(sum(got) - 1.5 * sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes, strict=True))
    share = [t / w for t, s, w in zip(got, sizes, weights, strict=True) if t < 2 * s - 1e-6]
    assert not share or max(share) - min(share) < 1e-6 * max(share)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=8), st.integers(1, 9), st.integers(0, 99))
def test_the_splitting_tree_deals_exact_quotas(quotas, shards, seed):
    got = mixing.split_quotas(quotas, shards, np.random.default_rng(seed))
    assert got.shape == (shards, len(quotas)) and (got >= 0).all()
    assert got.sum(0).tolist() == quotas
    assert got.sum(1).max() - got.sum(1).min() <= shards.bit_length()


def check(mixture):
    rows = mixture.rows.collect()
    for s in mixture.sources:
        own = [r for r in rows if r["source_no"] == s.number]
        taken = [r["size"] * (len(r["shards"]) * r["times"] + r["extra"]) + r["part"] for r in own]
        assert sum(taken) == round(s.target)
        assert all(t <= 2 * r["size"] * r["times"] for t, r in zip(taken, own, strict=True))
    return rows


def test_awkward_rows(spark):
    docs = awkward(spark)
    mixture = mixing.mix(docs)
    assert [s.name for s in mixture.sources] == ["s0", "s1", "s2", None]
    rows = check(mixture)
    assert sum(r["times"] for r in rows) == docs.count()
    again = mixing.mix(docs.repartition(2)).rows.collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    empty = mixing.mix(none(spark))
    assert empty.rows.count() == 0 and empty.sources == []


def test_large_and_hot_sources_meet_their_targets(spark):
    docs = spark.range(12_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"),
    )
    mixture = mixing.mix(docs)
    rows = check(mixture)
    for s in mixture.sources:
        assert sum(r["part"] > 0 for r in rows if r["source_no"] == s.number) <= 1
    to = [shard for r in rows for shard in r["shards"]]
    assert len(set(to)) == 16


def test_equal_rows_are_drawn_one_by_one(spark):
    docs = spark.createDataFrame([(1, "a", "x y z")] * 50 + [(2, "a", "x"), (3, "b", "v w " * 200)], "doc_id long, source string, text string")
    check(mixing.mix(docs))


def test_mixed_rows_are_whole_documents(spark):
    docs = awkward(spark).dropDuplicates(["doc_id", "text"])
    mixture = mixing.mix(docs, whole=True)
    got = mixing.mixed_rows(docs, mixture)
    assert got.columns == [*docs.columns, "mix_shard", "mix_order"]
    want = sum(len(r["shards"]) * r["times"] + r["extra"] for r in mixture.rows.collect())
    assert got.count() == want
    texts = {r["text"] for r in docs.collect()}
    assert {r["text"] for r in got.collect()} <= texts


def test_query(spark, sf_dir):
    rows = op6_mixing(spark, sf_dir).collect()
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(taken) - target) <= 0.5 for (_, target), taken in by.items())


def test_columns_of_clashing_names(spark):
    names = ["copy", "mix_text", "Mix_Shard", "to", "row", "mix_id", "times", "a.b"]
    shape = "doc_id long, source string, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(i, f"s{i % 2}", f"x y z{i}", *names) for i in range(60)], shape)
    mixture = mixing.mix(docs, whole=True)
    rows = mixing.mixed_rows(docs, mixture)
    assert rows.columns == ["doc_id", "source", "text", "copy", "mix_text", "to", "row", "mix_id", "times", "a.b", "mix_shard", "mix_order"]
    got = rows.collect()
    assert len(got) > 60 and all(r["copy"] == "copy" and r["a.b"] == "a.b" and 0 <= r["mix_shard"] < 16 for r in got)


def test_of_rows_alike_the_same_one_stays(spark):
    rows = [(1, "a", "x y z", f"n{k}") for k in range(9)] + [(i, "a", "u v", "n") for i in range(2, 40)]
    shape = "doc_id long, source string, text string, note string"
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, shape).repartition(4)
        got = mixing.mixed_rows(docs, mixing.mix(docs, whole=True)).where("doc_id = 1").collect()
        assert got and {r["note"] for r in got} == {"n0"}
