import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import awkward, none
from vacanta.llm import toxicity
from vacanta.llm.common import held_out
from vacanta.llm.queries import op3_toxicity


def kinds(text, lexicon=None):
    reader = toxicity.Reader(lexicon or {"idiot$": 3.0, "lowei": 2.0})
    return {k for k, v in zip(toxicity.KINDS, reader.collect(text), strict=True) if v}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("what an idiot came here", {"insult"}), ("you idiot", {"insult_targeted"}),
        ("you are an idiot", {"insult_targeted"}), ("this is not an idiot", {"insult_denied"}),
        ("not today. an idiot", {"insult"}), ("he said what an idiot", {"insult_quoted"}),
        ('the word "idiot" is old', {"insult_quoted"}), ("I will kill you", {"threat"}),
        ("them I will kill", {"threat_targeted"}), ("they never kill", {"threat_denied"}),
        ("die loweischaft kam", {"insult"}), ("idiotic and sloweis", set()), ("", set()), ("IDIOT!!!", {"insult"}),
    ],
)
def test_clauses(text, want):
    assert kinds(text) == want


def test_composition_equals_running_the_machines_in_turn():
    symbols = list("abc")
    first = toxicity.scope("a", {"b": "c"}, symbols, 2)
    second = toxicity.scope("c", {"b": "a"}, symbols, None)
    both = toxicity.compose(first, second)
    rng = random.Random(1)
    for _ in range(300):
        word = rng.choices(symbols, k=12)
        s = t = u = 0
        for symbol in word:
            s, between = first.arcs[(s, symbol)]
            t, out = second.arcs[(t, between)]
            u, composed = both.arcs[(u, symbol)]
            assert composed == out


def test_a_long_text_is_read_to_its_end():
    assert kinds("word " * 200_000 + "idiot") == {"insult"}
    assert kinds("x" * 500_000 + " idiot") == {"insult"}


def test_stems_and_words_are_learned():
    rng = random.Random(3)
    prose = lambda: [rng.choice(["haus", "baum", "wasser", "licht", "stein"]) + rng.choice(["", "en", "er"]) for _ in range(60)]
    toxic = [" ".join([*prose(), "vequ" + rng.choice(["et", "ag", "om", "ix", "un"]), "dolt"]) for _ in range(60)]
    clean = [" ".join(prose()) for _ in range(120)]
    lexicon = toxicity.learn_lexicon(toxic, clean)
    assert set(lexicon) == {"vequ", "dolt$"}
    model = toxicity.fit(toxicity.Reader(lexicon), toxic, clean, 0.1)
    assert model.weights["insult"] > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = toxicity.score(docs, toxicity.default_model())
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] < 0.5 for r in rows)
    assert toxicity.score(none(spark), toxicity.default_model()).count() == 0


def test_labels_that_teach_nothing(spark):
    labels = spark.createDataFrame([(None, None, 1), (1, 1, None), (2, 1, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.train(awkward(spark), labels) == toxicity.default_model()


def test_held_out_rows(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = op3_toxicity(spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    toxic = got[got.toxic == 1].predicted.mean()
    clean = got[got.toxic == 0].predicted.mean()
    assert toxic > 0.85 and clean < 0.02


@pytest.mark.parametrize("gap", [10, 500, 1000, 100_000])
def test_a_clause_is_read_whole(gap):
    reader = toxicity.Reader(toxicity.default_model().lexicon)
    filler = " ".join(["word"] * (gap // 5))
    near, far = (reader.collect(f"he said {x} you idiot") for x in ("that", filler))
    assert near == far


def test_long_texts_do_not_use_up_the_sample(spark):
    docs = [(i, ("long " * 50 if i % 10 else "short ") + str(i)) for i in range(600)]
    docs += [(i, "another short one") for i in range(0, 600, 20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 20 // 10) for i in range(600)], "doc_id long, toxic int")
    toxic, clean, share = toxicity.labelled_sample(frame, labels, "toxic", 20, 100)
    assert len(toxic) == 20 and len(clean) == 20
    assert all(len(t) <= 100 for t in toxic + clean) and 0 < share < 1
