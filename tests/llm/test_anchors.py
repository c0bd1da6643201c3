import itertools
import random
import re
import time

from tests.llm.frames import PROSE
from vacanta.llm import decontaminate

SPAN = decontaminate.RUN - decontaminate.WINDOW + 1


def test_no_run_and_no_half_is_without_an_anchor():
    rng = random.Random(3)
    for _ in range(200):
        places = sorted(rng.sample(range(60), rng.randint(1, 60)))
        costs = [rng.choice([0, 1, 50, 400]) for _ in places]
        rows = [(1, 0, p, 100 + p, len(places), c) for p, c in zip(places, costs, strict=True)]
        taken = {h - 100 for _, _, h in decontaminate._anchors(rows, 0.5)}
        assert len(places) - len(taken) < -(-len(places) // 2)
        for start in range(60):
            run = set(range(start, start + SPAN))
            assert not run <= set(places) or run & taken


def test_the_cheapest_spread():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(SPAN, 12)
        costs = [rng.randint(0, 9) for _ in range(n)]
        got = set(decontaminate._spread(list(range(n)), costs))
        every = [
            s for k in range(n + 1) for s in map(set, itertools.combinations(range(n), k))
            if all(s & set(range(a, a + SPAN)) for a in range(n - SPAN + 1))
        ]
        price = lambda s: sum(costs[k] + 1 for k in s)
        assert got in every and price(got) == min(map(price, every))


def test_a_phrase_that_all_share(spark):
    """400 items and 400 clean documents with one opening: no candidates but the true ones."""
    opening = "Read the following question with great care and then"
    word = lambda rng: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    rng = random.Random(5)
    item_rows = [(i, f"{opening} {' '.join(word(rng) for _ in range(25))}?") for i in range(400)]
    texts = [f"{opening} {' '.join(word(rng) for _ in range(60))}." for _ in range(400)]
    texts[7] += " " + item_rows[11][1]
    benchmark = spark.createDataFrame(item_rows, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begin = time.monotonic()
    got = decontaminate.find_leaks(docs, benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in got] == [(7, 11, 1.0)]
    assert time.monotonic() - begin < 40


def _plain_cover(doc, item):
    """Share of an item's windows in a document, and its longest run of tokens there, by looking everywhere."""
    w = decontaminate.WINDOW
    places = {tuple(doc[k : k + w]) for k in range(len(doc) - w + 1)}
    hit = [tuple(item[k : k + w]) in places for k in range(len(item) - w + 1)]
    joined = f" {' '.join(doc)} "
    run = max((b - a for a in range(len(item)) for b in range(a + w, len(item) + 1)
               if f" {' '.join(item[a:b])} " in joined), default=0)
    return sum(hit) / len(hit), run


def test_parts_and_runs_against_brute_force(spark):
    """Pieces of items in documents, all of lower-case words, found as by comparing each with each."""
    rng = random.Random(6)
    vocabulary = sorted({w for w in re.findall(r"[a-z]+", PROSE.lower())})
    bench = [[rng.choice(vocabulary) + "x" * rng.randint(0, 2) for _ in range(rng.randint(6, 60))] for _ in range(25)]
    docs = []
    for _ in range(200):
        item = rng.choice(bench)
        a = rng.randrange(len(item))
        b = rng.randint(a, min(len(item), a + 30))
        filler = [f"q{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)]
        docs.append(filler + item[a:b] + filler)
    want = set()
    for d, i in itertools.product(range(len(docs)), range(len(bench))):
        share, run = _plain_cover(docs[d], bench[i])
        if share >= decontaminate.COVERAGE or run >= decontaminate.RUN:
            want.add((d, i))
    frames = [
        spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], f"{name} long, text string")
        for rows, name in ((docs, "doc_id"), (bench, "item_id"))
    ]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(*frames).collect()}
    assert got == want and len(want) > 30
