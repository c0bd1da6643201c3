import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import PROSE, awkward, none
from vacanta.llm import quality_rules as rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside), "n_stop_words": sum(w.lower() in rules.STOP_WORDS and w[1:] == w[1:].lower() for w in words),
        "n_lines": len(lines), "n_capitals": len(re.findall(r"[A-Z]", text)),
        "base_failed": len(words) < 50 or 100 * len(inside) > 50 * len(words),
    }


def check(rows):
    for r in rows:
        want = brute(r["text"])
        assert {k: r[k] for k in want} == want
        assert r["kept"] == (not r["base_failed"] and not r["broken_rules"])


def test_awkward_rows(spark):
    docs = awkward(spark, [(20, "a b c\na b c\n\na b c x a b\r\n"), (21, (PROSE + ".\n") * 9), (22, "## $$ " * 60)])
    got = rules.apply_rules(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    check(rows)
    assert rules.apply_rules(none(spark)).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#\t\x0b", max_size=80), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    check(rules.apply_rules(spark.createDataFrame([(t,) for t in texts], "text string")).collect())


def test_one_projection_without_python(spark):
    plan = rules.apply_rules(none(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_clean_prose_is_kept_and_each_rule_bites(spark):
    prose = " ".join(f"{w}{i % 7}" if len(w) > 3 else w for i, w in enumerate((PROSE + " ").split() * 6))
    bad = {
        "symbols": prose + " #" * 40, "capitals": prose.upper(), "word_length": " ".join("x" * 20 + str(i) for i in range(90)),
        "dup_lines": "\n".join([*(f"the {i} of" for i in range(30)), *["and so on"] * 40]),
    }
    rows = spark.createDataFrame([("clean", prose), *bad.items()], "name string, text string")
    got = {r["name"]: r for r in rules.apply_rules(rows).collect()}
    assert got["clean"]["kept"]
    for name in bad:
        assert name in got[name]["broken_rules"] and not got[name]["kept"]


def test_columns_of_clashing_names(spark):
    docs = spark.createDataFrame(
        [("a b", 1, 2, 3, 4, None)], "text string, _counts int, N_words int, counts int, `a.b` int, kept string"
    )
    got = rules.apply_rules(docs)
    assert got.columns[:4] == ["text", "_counts", "counts", "a.b"] and len({c.lower() for c in got.columns}) == len(got.columns)
    row = got.collect()[0]
    assert (row["_counts"], row["counts"], row["a.b"], row["n_words"], row["kept"]) == (1, 3, 4, 2, False)
