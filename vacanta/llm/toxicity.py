"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insult, threat, target, negation, reporting verb,
quotation mark, anything else. Four small transducers rewrite the symbols of a
clause one after the other: negation marks what it denies, reported speech
marks what is quoted, insults and threats that address somebody are marked as
targeted, and a last one weighs what is left. They are composed into one
machine before any text is read. A document's score is a logistic function of
the weights its matched clauses collect; a clause without insult or threat
collects nothing, so only clauses around such words are run.

Insults are learned, words and word stems, from a bounded sample of labelled
rows (``SAMPLE`` a class, texts up to ``SAMPLE_CHARS``); the other word
classes are fixed. The machine and the lexicon are small and fixed in size and
go to the tasks with the function; documents are scored where they lie.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import held_out, park

SAMPLE = 1500
SAMPLE_CHARS = 20_000
LEXICON = 400  # learned entries at most

# Fixed values, by symbol.
THREATS = (
    "kill hurt destroy shoot stab burn beat hang murder töten umbringen erschießen schlagen "
    "tuer tuerai frapper détruire matar mataré golpear destruir"
).split()
TARGETS = (
    "you your yours u ur him her them they people du dich dir dein deine ihr euch sie "
    "tu toi te vous votre vos ton ta ti usted ustedes vosotros"
).split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't nicht kein keine nie niemals pas jamais aucun nunca jamás ni tampoco".split()
REPORTS = (
    "said says wrote called calls quoted claimed reported sagte schrieb nannte behauptete "
    "dit écrit appelé déclaré dijo escribió llamó declaró"
).split()
SEED_INSULTS = "idiot moron stupid scum worthless pathetic loser".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "ITYNRQo"
INPUTS = (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER)

WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]")
CLAUSE_END = re.compile(r"[.!?;:\n]")

# Weights of the last transducer before learning, by what a match came out as.
PRIOR = {
    "insult": 1.0, "insult_targeted": 1.4, "insult_denied": 0.3, "insult_quoted": 0.5,
    "threat": 0.1, "threat_targeted": 0.6, "threat_denied": 0.0, "threat_quoted": 0.1,
}
KINDS = list(PRIOR)


# --- transducers --------------------------------------------------------------------

class Transducer(NamedTuple):
    """Deterministic: (state, symbol) -> (state, symbol out). State 0 starts."""

    arcs: dict[tuple[int, str], tuple[int, str]]

    def states(self) -> set[int]:
        return {state for state, _ in self.arcs}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``."""
    numbers, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    inputs = sorted({symbol for _, symbol in first.arcs})
    while todo:
        pair = todo.pop()
        for symbol in inputs:
            a, between = first.arcs[(pair[0], symbol)]
            b, out = second.arcs[(pair[1], between)]
            if (a, b) not in numbers:
                numbers[(a, b)] = len(numbers)
                todo.append((a, b))
            arcs[(numbers[pair], symbol)] = (numbers[(a, b)], out)
    return Transducer(arcs)


def scope(trigger: str, marks: dict[str, str], symbols: list[str], reach: int | None) -> Transducer:
    """Rewrites by ``marks`` what comes within ``reach`` symbols after ``trigger`` (None: any number).

    A state is the number of symbols still in reach.
    """
    full = reach or 1
    arcs = {}
    for state in range(full + 1):
        for symbol in symbols:
            out = marks.get(symbol, symbol) if state else symbol
            left = state if reach is None else max(0, state - 1)
            arcs[(state, symbol)] = (full if symbol == trigger else left, out)
    return Transducer(arcs)


def quotation(marks: dict[str, str], symbols: list[str]) -> Transducer:
    """Rewrites by ``marks`` between quotation marks and after a reporting verb."""
    arcs = {}
    for state in (0, 1, 2):  # outside, after a verb, in quotation marks
        for symbol in symbols:
            to = {REPORT: max(state, 1), QUOTE: 0 if state == 2 else 2}.get(symbol, state)
            arcs[(state, symbol)] = (to, marks.get(symbol, symbol) if state else symbol)
    return Transducer(arcs)


def grammar() -> Transducer:
    """From input symbols to kinds of match; any other symbol comes out as it is.

    A target counts before an insult or threat, within three symbols.
    """
    symbols = list(INPUTS)
    deny = scope(NEGATION, {INSULT: "insult_denied", THREAT: "threat_denied"}, symbols, 3)
    symbols += ["insult_denied", "threat_denied"]
    quote = quotation({INSULT: "insult_quoted", THREAT: "threat_quoted"}, symbols)
    symbols += ["insult_quoted", "threat_quoted"]
    address = scope(TARGET, {INSULT: "insult_targeted", THREAT: "threat_targeted"}, symbols, 3)
    symbols += ["insult_targeted", "threat_targeted"]
    plain = {INSULT: "insult", THREAT: "threat"}
    name = Transducer({(0, s): (0, plain.get(s, s)) for s in symbols})
    return compose(compose(compose(deny, quote), address), name)


# --- lexicon ------------------------------------------------------------------------

def _features(text: str) -> set[str]:
    """Words (ending in $) and stems of three to eight letters of a text."""
    found = set()
    for word in set(re.findall(r"[^\W\d_]{3,}", text.lower())):
        found.add(word + "$")
        found.update(word[:n] for n in range(3, min(8, len(word)) + 1))
    return found


def learn_lexicon(toxic: list[str], clean: list[str]) -> dict[str, float]:
    """Stems and words that mark toxic texts, with their log odds.

    An entry must be frequent, significant and stronger than any entry it
    begins with; of stems that mark the same texts the longest stays.
    """
    with_, without = Counter(), Counter()
    for texts, counter in ((toxic, with_), (clean, without)):
        for text in texts:
            counter.update(_features(text))
    n, m = len(toxic), len(clean)
    odds, support = {}, {}
    for entry, a in with_.items():
        if a < 4:
            continue
        b = without.get(entry, 0)
        weight = math.log((a + 0.5) / (n + 1)) - math.log((b + 0.5) / (m + 1))
        if weight < 1.2:
            continue
        share = (a + b) / (n + m)
        g = 2 * (a * math.log(a / (n * share)) + (b * math.log(b / (m * share)) if b else 0))
        if g > 30 or (b == 0 and a >= 8 and g > 20):
            odds[entry], support[entry] = min(weight, 6.0), (a, b)
    # A stem whose extension marks nearly the same texts gives way to it.
    for entry in sorted(odds, key=len, reverse=True):
        for shorter in (entry.rstrip("$")[:k] for k in range(3, len(entry))):
            if shorter != entry and shorter in odds and support[entry][0] >= 0.95 * support[shorter][0]:
                odds.pop(shorter)
    # An extension that says no more than its stem goes.
    for entry in sorted(odds, key=len):
        if any(entry[:k] in odds and odds[entry[:k]] >= odds[entry] - 0.7 for k in range(3, len(entry))):
            odds.pop(entry)
    best = sorted(odds, key=lambda e: (-support[e][0] * odds[e], e))[:LEXICON]
    return {e: odds[e] for e in best}


class Model(NamedTuple):
    lexicon: dict[str, float]
    weights: dict[str, float]
    length: float
    bias: float


class Reader:
    """Runs the composed grammar over the clauses around lexicon words."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.arcs = grammar().arcs
        self.symbols = {w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS}
        self.symbols |= {w: REPORT for w in REPORTS} | {w: THREAT for w in THREATS} | {q: QUOTE for q in "\"“”„«»"}
        self.longest = max((len(e) for e in lexicon), default=0)
        self.anchors = ahocorasick.Automaton()
        for entry in lexicon:
            self.anchors.add_word(entry.rstrip("$"), len(entry.rstrip("$")))
        for word in THREATS:
            self.anchors.add_word(word, len(word))
        if len(self.anchors):
            self.anchors.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.lexicon.get(word + "$")
        for n in range(min(len(word), self.longest), 2, -1) if weight is None else ():
            if weight := self.lexicon.get(word[:n]):
                break
        if weight:
            return INSULT, weight
        return self.symbols.get(word, OTHER), 1.0

    def collect(self, text: str) -> list[float]:
        """What the clauses of a whole text collect, by kind of match."""
        text = text.lower()
        total = dict.fromkeys(KINDS, 0.0)
        end = 0  # of the last clause that was run
        for last, length in self.anchors.iter(text) if len(self.anchors) else ():
            start = last + 1 - length
            if last < end or (start and text[start - 1].isalpha()):
                continue
            # The whole clause, however long: what stands between two clauses that
            # are run is looked at once.
            begin = end
            for stop in CLAUSE_END.finditer(text, end, start):
                begin = stop.end()
            stop = CLAUSE_END.search(text, last)
            end = stop.start() if stop else len(text)
            state = 0
            for word in WORDS.finditer(text, begin, end):
                symbol, weight = self.symbol(word.group())
                state, out = self.arcs[(state, symbol)]
                if out in total:
                    total[out] += weight
        return [math.log1p(total[k]) for k in KINDS]


# --- learning -----------------------------------------------------------------------

def fit(reader: Reader, toxic: list[str], clean: list[str], share: float) -> Model:
    """Weights of the kinds of match, near ``PRIOR`` unless the sample says otherwise.

    ``share`` is the share of toxic rows among all labelled ones; the sample
    has as many of each class as it can, and the bias makes up for that.
    """
    x = np.array([[*reader.collect(t), math.log1p(t.count(" "))] for t in (*toxic, *clean)])
    y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    prior = np.array([2.0 * v for v in PRIOR.values()] + [0.0, -2.5])
    weights = prior.copy()
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.array([2.0] * len(KINDS) + [2.0, 0.01])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (weights - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    bias = float(weights[-1])
    if 0 < share < 1:
        bias += math.log(share / (1 - share)) - math.log(len(toxic) / len(clean))
    return Model(reader.lexicon, dict(zip(KINDS, map(float, weights), strict=False)), float(weights[-2]), bias)


def default_model() -> Model:
    """For tables without labels of both classes: the seed words and the prior."""
    return Model({w + "$": 3.0 for w in SEED_INSULTS}, {k: 2.0 * v for k, v in PRIOR.items()}, 0.0, -2.5)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, chars: int):
    """(texts of label 1, texts of label 0, share of label 1) for learning.

    At most ``bound`` texts a class, those with the smallest hash of their id,
    none of a held-out row. Only ids with a text of at most ``chars`` characters
    count towards the bound, and of several such texts of an id the least is
    taken. Labels other than 0 and 1 and null ids are passed over; of several
    labels of an id the largest counts.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    short = docs.where(F.col("text").isNotNull() & (F.length("text") <= chars)).select("doc_id", "text")
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    # The ids alone meet the labels; only the texts of those picked go further.
    usable = park(known.join(short.select("doc_id").distinct(), "doc_id"), "labelled")
    picked = [
        usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        for value in (1, 0)
    ]
    ids = park(picked[0].unionByName(picked[1]).select("doc_id", "label"), "sample")  # two times bound rows
    rows = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts: dict[int, list[str]] = {1: [], 0: []}
    for r in rows.orderBy("doc_id").collect():
        texts[r["label"]].append(r["text"])
    total = sum(counts.values())
    return texts[1], texts[0], counts.get(1, 0) / total if total else 0.0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    toxic, clean, share = labelled_sample(docs, labels, "toxic", SAMPLE, SAMPLE_CHARS)
    if not toxic or not clean:
        return default_model()
    lexicon = learn_lexicon(toxic, clean) | {w + "$": 3.0 for w in SEED_INSULTS}
    lexicon |= learn_lexicon(toxic, clean)
    return fit(Reader(lexicon), toxic, clean, share)


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` (doc_id, text, anything else) with ``into``, 0 to 1.

    Whole texts are read. Null and empty texts collect nothing and get the
    score of that. Repeated rows score alike, no rows give no rows, and a
    column named ``into`` is replaced.
    """
    docs = docs.drop(into)
    schema = docs.withColumn(into, F.lit(0.0)).schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.lexicon)
        weights = [model.weights[k] for k in KINDS]
        for batch in batches:
            scores = []
            for text in batch.column(at):
                text = text.as_py() or ""
                found = reader.collect(text)
                z = model.bias + model.length * math.log1p(text.count(" "))
                z += sum(w * f for w, f in zip(weights, found, strict=True))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)
