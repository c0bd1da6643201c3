import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import duck, duck_table, spark_table
from tests.llm.frames import PROSE, awkward, none
from vacanta.llm import lexical_search as search
from vacanta.llm import queries

ITEMS = "item_id long, text string, doc_id long, score string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=10):
    """Scores of all documents for all items, straight from the definition."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, these in wanted.items():
        scores = []
        for doc_id, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in these & c.keys()
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, n + 1, None if none_ else d, -s) for n, (s, none_, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 5, "mine", 3) for i, t in items], ITEMS)


AWKWARD_ITEMS = [
    (1, "The old harbour"), (2, "the crew, THE CREW sang"), (3, ""), (4, None), (5, "straße 日本 テスト w7 w8 W9"),
    (5, "one more row: word"), (None, "song"), (None, "nobody"), (6, "!!! ?"), (7, "absent words only"), (8, PROSE), (9, PROSE),
]


def test_awkward_rows(spark):
    docs = awkward(spark, [(i, "word song") for i in range(40, 60)] + [(61, "x" * 100_000 + " harbour"), (62, "harbour " * 30_000)])
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(search.search(docs, items_frame(spark, AWKWARD_ITEMS))) == brute(pairs, AWKWARD_ITEMS)
    assert got(search.search(none(spark), items_frame(spark, AWKWARD_ITEMS))) == []
    assert got(search.search(docs, items_frame(spark, []))) == []


def test_several_blocks_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 64)
    monkeypatch.setattr(search, "PIECE", 7)
    rng = random.Random(3)
    words = [f"t{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(200)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert len(list(search.blocks(items_frame(spark, items), 50))) > 5
    whole = list(search.blocks(items_frame(spark, items)))
    assert len(whole) == 1
    monkeypatch.setattr(search.blocks, "__defaults__", (50,))
    assert got(search.search(frame, items_frame(spark, items))) == brute(docs, items)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="aAb cé.0", max_size=30), max_size=25), st.lists(st.text(alphabet="aAb cé.0", max_size=20), max_size=8))
def test_random_texts(spark, texts, asked):
    docs, items = list(enumerate(texts)), list(enumerate(asked))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert got(search.search(frame, items_frame(spark, items))) == brute(docs, items)


def below(sharing, node):
    if node < sharing.n_terms:
        return [node]
    return [t for c in sharing.pairs[node - sharing.n_terms] for t in below(sharing, c)]


@pytest.mark.parametrize("seed", range(8))
def test_the_graph_holds_each_items_terms_once(seed):
    rng = random.Random(seed)
    common = rng.sample(range(300), 25)
    sets = [set(rng.sample(common, rng.randint(0, 25))) | set(rng.sample(range(300), rng.randint(0, 6))) for _ in range(60)]
    sets += [set(sets[0]), set(), {5}]
    sharing = search.share(sets, 300)
    assert [sorted(t for n in row for t in below(sharing, n)) for row in sharing.items] == [sorted(s) for s in sets]
    assert sharing.additions < sum(max(len(s) - 1, 0) for s in sets)
    values = np.arange(300) ** 2
    asked = Counter()

    def leaf(t):
        asked[t] += 1
        return None if t % 7 == 0 else np.array([values[t], t])

    for s, total in zip(sets, search.evaluate(sharing, leaf)):
        some = [t for t in s if t % 7]
        assert (total is None and not some) or total.tolist() == [sum(values[t] for t in some), sum(some)]
    assert max(asked.values()) == 1  # a term's array is made once


def test_items_with_the_same_terms_cost_one_sum():
    sharing = search.share([set(range(50))] * 40, 50)
    assert sharing.additions == 49 and all(len(row) == 1 for row in sharing.items)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    want = duck_table(duck(sf_dir), queries.ORACLES["op13_lexical_search"])
    assert spark_table(queries.QUERIES["op13_lexical_search"](spark, sf_dir)) == want
    assert len(want[1]) > 0
