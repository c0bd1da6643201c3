import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import components as brute_components
from tests.llm.brute import shingle_set
from tests.llm.frames import awkward, none
from vacanta.llm import minhash
from vacanta.llm.queries import op7_minhash

LIKE = minhash.Likeness(3, 85)


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def check(spark, texts, like=LIKE, docs=None):
    rows = minhash.near_duplicates(docs or frame(spark, texts), like).collect()
    want = brute_components(texts, like.words, like.percent)
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(got) == len(texts)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    assert all(r["n_shingles"] == len(shingle_set(texts[i], like.words)) for i, r in got.items())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB é\n\t x", max_size=60), st.integers(1, 6))
def test_shingles_of_a_text(text, words):
    got = minhash.shingles(np.frombuffer(text.encode(), np.uint8), words)
    assert len(got) == len(shingle_set(text, words))


def test_a_text_in_pieces_has_the_hashes_of_the_whole(monkeypatch):
    rng = random.Random(5)
    data = np.frombuffer(" ".join("w" * rng.randint(1, 90) + str(i) for i in range(500)).encode(), np.uint8)
    whole = minhash.word_hashes(data)
    monkeypatch.setattr(minhash, "PIECE", 64)
    assert np.array_equal(minhash.word_hashes(data), whole)


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = base[:3400], base[600:]  # 2800 of 4000 in common
    same = (minhash.min_max(a) == minhash.min_max(b)).mean()
    assert abs(same - 0.7) < 0.15


@pytest.mark.parametrize("like", [LIKE, minhash.Likeness()])
def test_bands_miss_hardly_ever(like):
    share = like.percent / 100
    assert (1 - share**like.rows) ** (2 * minhash.HASHES // like.rows) <= minhash.MISS


def near_group(rng, n, words=60, edits=4):
    base = [f"b{rng.randint(0, 10**6)}" for _ in range(words)]
    group = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
        group.append(" ".join(copy))
    return group


def test_groups_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 16)
    rng = random.Random(7)
    group = near_group(rng, 120, 120, 6) + near_group(rng, 30) + near_group(rng, 12, 9, 1)
    exact = [group[0]] * 40 + [group[0].upper()] * 5 + ["one two"] * 4 + ["One  two", "one", "two", "", None, " "]
    chain = [" ".join(f"c{i + k}" for i in range(80)) for k in range(0, 40, 2)]  # neighbours are alike, ends are not
    texts = dict(enumerate(rng.sample(group + exact + chain, len(group + exact + chain))))
    check(spark, texts)
    check(spark, texts, minhash.Likeness())


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = minhash.near_duplicates(docs).collect()
    ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert sorted(ids) == list(range(1, 11))
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["component_id"] == 1 and not by[2]["kept"]
    assert all(by[i]["n_shingles"] == 0 and by[i]["component_id"] == i for i in (4, 5, 6))
    nameless = [r for r in rows if r["doc_id"] is None]
    assert len(nameless) == 2 and all(r["kept"] and r["component_id"] is None for r in nameless)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        *((False, i) for i in range(1, 11) if by[i]["kept"]), (True, 0), (True, 0)
    ]
    assert minhash.near_duplicates(none(spark)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in (200, 201, 202)}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute_components(texts, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in op7_minhash(spark, sf_dir).collect()} == want


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    near = b.replace("b50 ", "q ")
    cases = [
        ([(2, a), (2, c)], [[(2, a), (2, c)]]),
        ([(1, b), (2, c), (2, b)], [[(1, b), (2, c)], [(2, b), (2, c)]]),
        ([(5, a), (5, a), (5, b), (6, near), (5, None), (5, "")], [[(5, ""), (5, None), (5, a), (5, b)], [(5, ""), (5, None), (5, a), (6, near)]]),
        ([(-3, a), (-3, b), (0, a)], [[(-3, a), (-3, b)], [(-3, b), (0, a)]]),
    ]
    for rows, allowed in cases:
        docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, own string, tie long")
        kept = sorted(((r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect()), key=str)
        assert kept in [sorted(want, key=str) for want in allowed]
