"""Quality rules: a threshold table compiled into one projection of built-in functions.

Counts are taken once per document, inside the row: no shuffle, no function of
the user's. Each rule compares a share of two counts, in whole per cent, with
its bounds, so every engine decides alike.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import column, others

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
POSITION_BITS = 30  # of a window's sort key; the rest is hash

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are with as be at by this from a or an he not "
    "der die und das nicht von ist mit sich den auf für im dem ein eine zu des "
    "de la le et les en un du une que est pour qui dans par pas sur avec au "
    "el y los del se las por con no su lo es al para"
).split()


class Rule(NamedTuple):
    """Fails a document whose 100 * part is below low * whole or above high * whole."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None


RULES = [
    Rule("word_length", "word_chars", "n_words", 200, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 8, None),
    Rule("capitals", "n_capitals", "word_chars", None, 30),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 50),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _window(hashes: Column, at: Column) -> Column:
    return F.xxhash64(F.get(hashes, at), F.get(hashes, at + 1), F.get(hashes, at + 2))


def repeated_words(words: Column) -> Column:
    """Words lying in a window of three words that the text has twice or more.

    Sorting one long per window (hash above, place below) brings equal windows
    side by side; those found are sorted again by their full hash. That is
    n log n for a text of n words.
    """
    place = (1 << POSITION_BITS) - 1

    def of_hashes(hashes):
        starts = F.when(F.size(hashes) >= 3, F.sequence(F.lit(0), F.size(hashes) - 3)).otherwise(
            F.array().cast("array<int>")
        )
        keys = F.transform(
            starts, lambda at: _window(hashes, at).bitwiseAND(F.lit(~place)).bitwiseOR(at.cast("long"))
        )
        return _let(F.sort_array(keys), lambda ordered: of_keys(hashes, ordered))

    def of_keys(hashes, ordered):
        def near(key, at):
            # The XOR of two keys of one hash has place bits only.
            same = lambda other: F.coalesce(key.bitwiseXOR(other).between(0, place), F.lit(False))
            return same(F.get(ordered, at + 1)) | same(F.get(ordered, at - 1))

        found = F.transform(
            F.filter(ordered, near),
            lambda key: F.struct(
                _window(hashes, key.bitwiseAND(F.lit(place)).cast("int")).alias("hash"),
                key.bitwiseAND(F.lit(place)).cast("int").alias("at"),
            ),
        )
        return _let(F.sort_array(found), of_found)

    def of_found(found):
        twice = F.filter(
            found,
            lambda x, i: F.coalesce(F.get(found, i + 1)["hash"] == x["hash"], F.lit(False))
            | F.coalesce(F.get(found, i - 1)["hash"] == x["hash"], F.lit(False)),
        )
        return _let(F.sort_array(F.transform(twice, lambda x: x["at"])), covered)

    def covered(starts):
        new = F.transform(
            starts, lambda at, i: F.coalesce(F.least(F.get(starts, i + 1) - at, F.lit(3)), F.lit(3))
        )
        return F.aggregate(new, F.lit(0).cast("long"), lambda total, n: total + n)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def counts(text: Column) -> Column:
    """Struct of all counts that rules may name; a null text has none of anything."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, SPACE), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    stop = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]

    def of_words(words):
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            F.size(F.filter(words, lambda w: w.isin(*stop))).cast("long").alias("n_stop_words"),
            repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines):
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        _let(words, of_words).alias("words"),
        _let(lines, of_lines).alias("lines"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(whole, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_capitals")


def broken(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 100, F.col(rule.whole)
    tests = [part < whole * rule.low] if rule.low is not None else []
    tests += [part > whole * rule.high] if rule.high is not None else []
    either = tests[0]
    for test in tests[1:]:
        either = either | test
    return either


def apply_rules(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with all counts, base_failed, broken_rules and kept.

    Null and empty texts have no words and fail the base rule. Repeated rows
    are judged alike, no rows give no rows, and columns of ``docs`` named like
    the results, in whatever case, are replaced.
    """
    mine = [column(c) for c in others(docs, [*COUNTS, "base_failed", "broken_rules", "kept"])]
    name = "counts_" + "_".join(docs.columns)  # no column of docs has it
    counted = docs.select(*mine, counts(F.col("text")).alias(name))
    found = column(name)
    flat = counted.select(
        *mine,
        *(found["words"][c].alias(c) for c in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")),
        *(found["lines"][c].alias(c) for c in ("n_lines", "n_dup_lines")),
        *(found[c].alias(c) for c in ("n_symbols", "n_capitals")),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    names = F.array_compact(F.array(*(F.when(broken(r), F.lit(r.name)) for r in rules)))
    judged = flat.withColumns({"base_failed": failed, "broken_rules": names})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def oracle() -> str:
    """The same in SQL, from the definitions of the counts."""
    stop = ", ".join(f"'{w}'" for w in [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])
    passes = " and ".join(
        f"not (100 * {r.part} {sign} {bound} * {r.whole})"
        for r in RULES
        for sign, bound in (("<", r.low), (">", r.high))
        if bound is not None
    )
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
with texts as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text from documents
), words as (
  select row, unnest(ws) as w, generate_subscripts(ws, 1) as i
  from (select row, regexp_extract_all(text, '{word}') as ws from texts) t
), windows as (
  select row, i, w, lead(w, 1) over p as w2, lead(w, 2) over p as w3
  from words window p as (partition by row order by i)
), twice as (
  select row, i, count(*) over (partition by row, w, w2, w3) as n from windows where w3 is not null
), inside as (
  select distinct row, i + k as i from twice, (values (0), (1), (2)) s(k) where n > 1
), per_word as (
  select row, count(*) as n_words, cast(sum(length(w)) as bigint) as word_chars,
    count(*) filter (w in ({stop})) as n_stop_words from words group by 1
), per_inside as (select row, count(*) as n_repeat_words from inside group by 1),
lines as (
  select row, unnest(string_split(text, chr(10))) as line from texts
), per_line as (
  select row, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from lines where regexp_matches(line, '{word}') group by 1
), counts as (
  select t.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
    cast(len(regexp_extract_all(text, '{SYMBOLS}')) as bigint) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(n_stop_words, 0) as n_stop_words, coalesce(n_lines, 0) as n_lines,
    cast(len(regexp_extract_all(text, '[A-Z]')) as bigint) as n_capitals
  from texts t left join per_word using (row) left join per_inside using (row) left join per_line using (row)
), judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {passes} as kept, n_stop_words, n_lines, n_capitals
from judged
"""
