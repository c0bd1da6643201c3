import re

import pytest

from tests.llm.frames import PROSE, awkward, none
from vacanta.llm import decontaminate
from vacanta.llm.common import bloom_bits
from vacanta.llm.queries import op9_decontaminate

QUESTION = "Tomorrow morning Alice will buy 12 apples for 3 dollars each and then Alice walks 5 miles home. How much did she pay for the apples?"
OTHER = "Yesterday a red train left the northern station and nobody on the long platform noticed that the last carriage was missing."


def items(spark, extra=()):
    rows = [(1, QUESTION), (2, OTHER), (3, None), (4, ""), (5, "too short here"), *extra]
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, doc_id int")


def leaked(spark, texts, benchmark=None):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = decontaminate.mark_leaks(docs, benchmark or items(spark)).collect()
    return {r["doc_id"]: r for r in rows}


def test_what_leaks_and_what_does_not(spark):
    filler = (PROSE + ". ") * 3
    again = QUESTION.replace("Alice", "Bob").replace("12", "forty").replace("3 dollars", "7 euros").replace("5 miles", "9 km")
    # Alice becomes two persons and the apples cost two prices: another story.
    mixed = QUESTION.replace("Alice will", "Carol will").replace("12 apples", "5 apples")
    texts = [
        filler + QUESTION + filler, filler + again + filler, filler + OTHER.upper() + filler, filler,
        "\n".join(OTHER.split()), OTHER.replace(" red ", " blue "), " ".join(OTHER.split()[:8]), QUESTION + OTHER,
        " ".join(reversed(OTHER.split())), mixed,
    ]
    got = leaked(spark, texts)
    assert [i for i, r in got.items() if r["leaked"]] == [0, 1, 2, 4, 5, 7, 9]
    assert got[0]["best_item"] == 1 and got[2]["best_item"] == 2 and got[7]["n_items"] == 2
    assert got[0]["coverage"] > got[9]["coverage"]
    assert got[3]["coverage"] == 0 and got[3]["best_item"] is None


def test_copies_in_other_case(spark):
    names = "In which year did Einstein meet Bohr at Solvay and discuss with Heisenberg the work of Dirac on Maxwell?"
    german = "Welche Straße führt vom Bahnhof durch den Wald zum Schloss, wenn der Fluss im Frühling die Brücke sperrt?"
    benchmark = items(spark, [(6, names), (7, german)])
    filler = " " + (PROSE + ". ") * 2
    got = leaked(spark, [filler + f + filler for t in (names, german) for f in (t, t.lower(), t.upper())], benchmark)
    assert [r["best_item"] for r in got.values()] == [6, 6, 6, 7, 7, 7]
    assert [r["coverage"] for r in got.values()] == [1.0] * 6


def test_items_without_a_window(spark):
    texts = ["Compute 12 + 35 * 7 - 4 = ?", "Wer war Sokrates?", "中国的首都是哪里", "小明有12个苹果，小红有7个，一共有多少", "Zebra"]
    benchmark = items(spark, list(enumerate(texts, 10)))
    filler = (PROSE + ". ") * 2
    found = [
        filler + texts[0] + filler, filler + texts[1].upper() + filler, "例如中国的首都是哪里呢？", "请问小明有12个苹果，小红有7个，一共有多少个？",
        "Which animal? zebra! " + filler, "it is too short here " + filler,
    ]
    missed = ["the zebra runs", "too short there", "中国的首都", "哪里是中国的首都", "Wer war damals Sokrates?", "12 + 35 * 7", "日本", "???"]
    got = leaked(spark, found + missed, benchmark)
    assert [got[i]["best_item"] for i in range(6)] == [10, 11, 12, 13, 14, 5]
    assert not any(got[i]["leaked"] for i in range(6, 6 + len(missed)))


def test_slots_must_agree(spark):
    rows = decontaminate.pd.DataFrame(
        [(1, 1, 1, k, k, 10, [a], [b]) for k, (a, b) in enumerate([("tom", "ann")] * 6 + [("tom", "sue")] * 3)],
        columns=["doc_id", "tie", "item_id", "at", "item_at", "item_windows", "item_slots", "slots"],
    )
    assert decontaminate._consistent(rows)["coverage"].tolist() == [0.6]


def test_copies_that_follow_each_other():
    # Three copies of twelve windows with two slots each. The vote of all for
    # each slot is a tie; its largest value stands in the first or the last copy.
    word = lambda copy, n: ("z" if copy == n % 2 * 2 else "y" if copy == 1 else "a") + str(n)
    hits = [
        (1, 1, 1, copy * 16 + k, k, 12, [f"n{n}" for n in (k, (k + 1) % 12)], [word(copy, n) for n in (k, (k + 1) % 12)])
        for copy in range(3) for k in range(12)
    ]
    columns = ["doc_id", "tie", "item_id", "at", "item_at", "item_windows", "item_slots", "slots"]
    got = decontaminate._consistent(decontaminate.pd.DataFrame(hits, columns=columns))
    assert got[["coverage", "first_token", "last_token"]].values.tolist() == [[1.0, 0, 15]]
    # A word more in the middle of each copy.
    longer = [(*h[:3], h[3] + h[3] // 16 + (h[4] > 5), *h[4:]) for h in hits]
    assert decontaminate._consistent(decontaminate.pd.DataFrame(longer, columns=columns))["coverage"].tolist() == [1.0]


def test_a_long_run_of_a_longer_item(spark):
    words = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu") for b in "bcdfghjklmnpqrstvwxz"]
    benchmark = items(spark, [(8, " ".join(words))])
    filler = " " + (PROSE + ". ") * 2
    got = leaked(spark, [filler + " ".join(words[50 : 50 + n]) + filler for n in (90, 13, 12)], benchmark)
    assert [(r["leaked"], r["best_item"]) for r in got.values()] == [(True, 8), (True, 8), (False, None)]
    assert got[0]["coverage"] == 86 / 196


def test_slots_of_a_run_must_agree():
    hits = [(k, k, ["tom"], ["ann" if k < 7 else "sue"]) for k in range(20)]
    assert decontaminate._longest_run(hits) == 13
    assert decontaminate._longest_run([h for h in hits if h[0] != 10]) == 9


def test_hits_far_apart_do_not_add_up(spark):
    words = OTHER.split()
    filler = " " + " ".join(f"f{i} g h" for i in range(200)) + " "
    scattered = filler.join(" ".join(words[i : i + 6]) for i in range(0, len(words), 5))
    assert not leaked(spark, [scattered])[0]["leaked"]


def test_the_filter_knows_every_window(spark):
    parked = decontaminate.template_windows(items(spark), ["item_id"])
    bits = bloom_bits(parked, "hash")
    assert decontaminate.template_windows(items(spark), ["item_id"], bits).count() == parked.count() > 0


def test_awkward_rows(spark):
    docs = awkward(spark, [(50, OTHER), (50, OTHER), (None, QUESTION)])
    rows = decontaminate.mark_leaks(docs, items(spark)).collect()
    assert len(rows) == docs.count()
    assert sum(r["leaked"] for r in rows) == 3
    clean = decontaminate.without_leaks(docs, items(spark))
    assert clean.columns == docs.columns and clean.count() == docs.count() - 3
    assert decontaminate.mark_leaks(none(spark), items(spark)).count() == 0
    assert not any(r["leaked"] for r in decontaminate.mark_leaks(docs, items(spark).limit(0)).collect())


@pytest.mark.parametrize("name", ["sf0.01"])
def test_query_against_brute_force(spark, name):
    sf = f"/root/testdata/{name}"
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    items_ = {r["item_id"]: split(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = f" {' '.join(split(r['text']))} "
        want |= {r["doc_id"] for w in items_.values() if f" {' '.join(w)} " in text}
    got = {r["doc_id"] for r in op9_decontaminate(spark, sf).where("leaked").collect()}
    assert got == want
