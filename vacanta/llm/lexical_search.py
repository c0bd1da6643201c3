"""Ranked lexical search of many items at once, with shared sums evaluated once.

Items have terms in common. Their term sets, ordered so that terms of the same
items lie side by side, are mined for pairs that stand in two items or more;
each such pair becomes a node, nodes are paired again, and so on until nothing
is shared. That gives a graph: its leaves are terms, an inner node is the set of
the terms below it, and an item is the sum of a few nodes. Over a batch of
documents a node is one array of partial scores. It is computed once, used by
every node and item above it, and given up after its last use.

Items come in blocks of at most ``PAIRS`` (item, term) pairs or one item. Per
block one scan of the texts counts the block's terms in every document and
stores these counts; document frequencies, and then the scores, are read from
them. Every task keeps ``top`` documents per item, so what is shuffled does not
grow with the documents that match.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacanta.llm.common import park

TOP = 10
PAIRS = 100_000  # (item, term) pairs of a block
CELLS = 1 << 23  # partial scores that a task holds at once
PIECE = 1 << 20  # bytes of a text that are split at once
PARTS = 64  # first ranking: an item's rows are dealt over so many groups

# A-Z become a-z, every other ASCII character but digits and letters a space.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def term_counts(text: bytes | None) -> Counter[bytes]:
    """Terms of a whole text in UTF-8 with their occurrences."""
    found: Counter[bytes] = Counter()
    text = text or b""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _TERM_BYTES[text[end]] != 0x20:  # to the end of the term
            end += 1
        found.update(text[at:end].translate(_TERM_BYTES).split())
        at = end
    return found


# --- items as a graph of shared term sets --------------------------------------------------

class Sharing(NamedTuple):
    """Nodes ``0 .. n_terms - 1`` are terms; node ``n_terms + i`` joins ``pairs[i]``."""

    n_terms: int
    pairs: list[tuple[int, int]]
    items: list[list[int]]  # the nodes an item adds up

    @property
    def additions(self) -> int:
        """Arrays added for one batch of documents."""
        return len(self.pairs) + sum(max(len(i) - 1, 0) for i in self.items)


def share(sets: list[set[int]], n_terms: int) -> Sharing:
    """Mine the pairs of neighbours that several items hold, again and again.

    A pass is linear in the items' lengths and each one shortens them.
    """
    held: dict[int, list[int]] = {}
    for number, terms in enumerate(sets):
        for t in terms:
            held.setdefault(t, []).append(number)
    # Terms of many items first, terms of the same items side by side.
    order = {t: n for n, t in enumerate(sorted(held, key=lambda t: (-len(held[t]), held[t], t)))}
    rows = [sorted(terms, key=order.__getitem__) for terms in sets]
    pairs: list[tuple[int, int]] = []
    while True:
        seen = Counter(p for row in rows for p in zip(row, row[1:]))
        if max(seen.values(), default=0) < 2:
            return Sharing(n_terms, pairs, rows)
        node: dict[tuple[int, int], int] = {}
        for i, row in enumerate(rows):
            new, at = [], 0
            while at < len(row):
                here = seen[(row[at], row[at + 1])] if at + 1 < len(row) else 0
                after = seen[(row[at + 1], row[at + 2])] if at + 2 < len(row) else 0
                if here >= 2 and here >= after:
                    pair = (row[at], row[at + 1])
                    if pair not in node:
                        node[pair] = n_terms + len(pairs)
                        pairs.append(pair)
                    new.append(node[pair])
                    at += 2
                else:
                    new.append(row[at])
                    at += 1
            rows[i] = new


def evaluate(sharing: Sharing, leaf) -> Iterator[np.ndarray | None]:
    """Each item's array, in order; ``leaf(term)`` gives a term's, or None for zeros."""
    uses = Counter(n for row in [*sharing.pairs, *sharing.items] for n in row)
    ready: dict[int, np.ndarray | None] = {}

    def value(node: int) -> np.ndarray | None:
        stack = [node]
        while stack:  # children first
            n = stack[-1]
            if n in ready:
                stack.pop()
            elif n < sharing.n_terms:
                ready[n] = leaf(n)
            else:
                pair = sharing.pairs[n - sharing.n_terms]
                missing = [c for c in pair if c not in ready]
                if missing:
                    stack += missing
                else:
                    ready[n] = total([use(c) for c in pair])
        return use(node)

    def use(node: int) -> np.ndarray | None:
        uses[node] -= 1
        return ready[node] if uses[node] else ready.pop(node)

    def total(arrays):
        some = [a for a in arrays if a is not None]
        if len(some) < 2:
            return some[0] if some else None
        added = some[0] + some[1]
        for a in some[2:]:
            added += a
        return added

    for row in sharing.items:
        yield total([value(n) for n in row])


class Block(NamedTuple):
    items: list[int | None]
    vocabulary: dict[bytes, int]
    sharing: Sharing


def blocks(items: DataFrame, pairs: int = PAIRS) -> Iterator[Block]:
    """Items by id, with the terms of all their rows; one block at a time is on the driver."""
    ids: list[int | None] = []
    sets: list[set[bytes]] = []

    def close() -> Block:
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*sets)))}
        return Block(list(ids), vocabulary, share([{vocabulary[t] for t in s} for s in sets], len(vocabulary)))

    rows = items.select(F.col("item_id").cast("long"), F.encode("text", "UTF-8").alias("text"))
    for r in rows.orderBy("item_id").toLocalIterator():
        if not ids or ids[-1] != r["item_id"]:
            if sum(map(len, sets)) >= pairs:
                yield close()
                ids, sets = [], []
            ids.append(r["item_id"])
            sets.append(set())
        sets[-1].update(term_counts(bytes(r["text"]) if r["text"] is not None else None))
    if ids:
        yield close()


# --- documents --------------------------------------------------------------------------

def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: ``n``, its terms, and which of the vocabulary it has how often."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a block's terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = known.value
        for batch in batches:
            ids, lengths, terms, times, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                found = term_counts(text.as_py())
                if found:
                    mine = look.keys() & found.keys()
                    ids.append(doc_id)
                    lengths.append(found.total())
                    terms += [look[t] for t in mine]
                    times += [found[t] for t in mine]
                    ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))],
                ["doc_id", "n", "terms", "times"],
            )

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>")


def weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


class _Best:
    """The highest-scoring documents per item so far; equal scores by id, without id last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        none = np.zeros(0, np.int64)
        self.kept = [(none, none, none.astype(bool))] * n_items

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, without: np.ndarray) -> None:
        top = self.top
        old = self.kept[item]
        least = max(1, old[0][-1] if len(old[0]) == top else 1)
        if len(scores) > top:
            least = max(least, np.partition(scores, -top)[-top])
        rows = np.flatnonzero(scores >= least)  # with all that equal the last
        if len(rows):
            both = [np.concatenate(x) for x in zip(old, (scores[rows], ids[rows], without[rows]))]
            order = np.lexsort((both[1], both[2], -both[0]))[:top]
            self.kept[item] = tuple(x[order] for x in both)

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, (scores, ids, without) in enumerate(self.kept):
            for s, i, w in zip(scores.tolist(), ids.tolist(), without.tolist()):
                yield item, None if w else i, s


def _scored(postings: DataFrame, block: Block, weights: np.ndarray, n_documents: int, n_terms: int, top: int) -> DataFrame:
    """The best documents of every task for each item."""
    items, sharing = block.items, block.sharing
    step = max(16, CELLS // max(1, len(sharing.pairs) + sharing.n_terms))
    shared = postings.sparkSession.sparkContext.broadcast((sharing, weights))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weigh = shared.value
        best = _Best(len(items), top)
        for batch in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
            ids = batch.column("doc_id")
            without = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            lists = batch.column("terms")
            terms, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            # Python integers: n times the number of documents may pass 64 bits.
            norm = np.array([10 + 90 * n * n_documents // n_terms for n in batch.column("n").to_pylist()], np.int64)
            part = weigh[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * norm[doc]))
            order = np.argsort(terms, kind="stable")
            doc, part = doc[order], part[order]
            border = np.searchsorted(terms[order], np.arange(graph.n_terms + 1))

            def leaf(term: int) -> np.ndarray | None:
                low, high = border[term], border[term + 1]
                if low == high:
                    return None
                scores = np.zeros(len(ids), np.int64)
                scores[doc[low:high]] = part[low:high]
                return scores

            for item, scores in enumerate(evaluate(graph, leaf)):
                if scores is not None:
                    best.add(item, scores, ids, without)
        found = list(best.rows())
        yield pa.RecordBatch.from_arrays(
            [pa.array([items[i] for i, _, _ in found], pa.int64()), pa.array([d for _, d, _ in found], pa.int64()),
             pa.array([s for _, _, s in found], pa.int64())],
            ["item_id", "doc_id", "score"],
        )

    return postings.mapInArrow(rank, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: ``item_id``, ``rank``,
    ``doc_id`` and ``score``.

    Only scores above 0 are ranked, equal ones by ``doc_id``, rows without one
    last; rows that are alike take a rank each. Null and empty texts have no
    term, and such documents count nowhere. Rows of one ``item_id`` (or without
    one) are one item with the terms of all its rows; items without terms give
    no rows, nor do empty tables. Only ``doc_id``, ``item_id`` and the texts are
    read, so other columns may have any names.
    """
    spark = docs.sparkSession
    ranked = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items):
        postings = park(_postings(docs, block.vocabulary), "postings")
        whole = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        if not whole["documents"]:
            continue
        weights = np.zeros(len(block.vocabulary), np.int64)
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
        for r in held.toLocalIterator():  # a row per term of the block
            weights[r["term"]] = weight(whole["documents"], r["count"])
        best = _scored(postings, block, weights, whole["documents"], whole["terms"], top)
        place = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
        for keys in (["item_id", part], ["item_id"]):
            place_of = F.row_number().over(W.partitionBy(*keys).orderBy(*place))
            best = best.withColumn("rank", place_of).where(F.col("rank") <= top)
        ranked = ranked.unionByName(best)
    return ranked


def oracle(top: int = TOP) -> str:
    """The query's rows in SQL."""
    terms = r"""unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
    return f"""
    with docs as (select row_number() over () as row_no, doc_id, text from documents),
    found as (select row_no, doc_id, {terms} as term from docs),
    tf as (select row_no, doc_id, term, count(*) as tf from found group by all),
    lengths as (select row_no, sum(tf) as n from tf group by row_no),
    whole as (select count(*) as documents, cast(sum(n) as bigint) as terms from lengths),
    norms as (
      select row_no, cast(10 + (90 * n * documents) // terms as bigint) as m from lengths, whole
    ),
    wanted as (select distinct item_id, {terms} as term from benchmark),
    df as (select term, count(*) as df from tf group by term),
    weights as (
      select term, cast(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) as bigint) as w from df, whole
    ),
    scores as (
      select item_id, row_no, doc_id,
        cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
      from wanted join weights using (term) join tf using (term) join norms using (row_no)
      group by item_id, row_no, doc_id
    )
    select item_id, cast(place as int) as rank, doc_id, score from (
      select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place
      from scores where score > 0
    ) where place <= {top}"""
