"""Near duplicates by min-max hashing, links confirmed on whole shingle sets.

Each of ``HASHES`` permutations keeps its minimum and its maximum, so 2 *
``HASHES`` values cost half as many hash evaluations. Bands of these values
are bucket keys; the number of values a band has follows from the similarity
wanted, so that a pair just similar enough misses all its buckets with a
probability below ``MISS``.

Equal sets are one class, and only classes go on, each by its smallest id. In
a bucket every member is compared with one leader, the member that shares most
buckets, which settles groups of any size with one pair a member. Components
of the links found show which buckets still hold members that are not linked;
there the remaining members are compared with the others, a block of the
bucket against a block at a time and only across components. So every two
texts that share a bucket are linked, in one component, or compared, and no
step writes the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import bloom_bits, in_bloom, mix_bits, park, powers

HASHES = 64
MISS = 1e-6
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 500_000
PIECE = 1 << 20  # bytes of a text that are hashed at once

_rng = np.random.default_rng(20)
_SALTS = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64)[:, None]
_FACTORS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_ORDER = _rng.permutation(2 * HASHES)  # mixes minima and maxima in the bands
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class Likeness(NamedTuple):
    words: int = 5  # of a shingle
    percent: int = 80  # 100 * intersection >= percent * union

    @property
    def rows(self) -> int:
        """Values of a band: as many as the chance of a miss allows."""
        share = self.percent / 100
        fit = [r for r in range(1, 9) if (1 - share**r) ** (2 * HASHES // r) <= MISS]
        return max(fit, default=1)


# --- one text -----------------------------------------------------------------------

def _hash_piece(data: np.ndarray) -> np.ndarray:
    """Hash of each word of a piece: a polynomial of its bytes, any place alike."""
    data = _LOWER[data]
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mix_bits((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a whole text, A-Z read as a-z."""
    if len(data) <= PIECE:
        return _hash_piece(data)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):  # to the end of the word
            spaces = np.flatnonzero(_SPACE[data[end : end + PIECE]])
            end = end + int(spaces[0]) if len(spaces) else min(len(data), end + PIECE)
            if len(spaces):
                break
        found.append(_hash_piece(data[at:end]))
        at = end
    return np.concatenate(found)


def shingles(data: np.ndarray, words: int) -> np.ndarray:
    """Distinct shingles of a text, sorted; a text of fewer words is one shingle."""
    hashes = word_hashes(data)
    if not len(hashes):
        return np.zeros(0, np.uint64)
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mix_bits(total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    return np.unique(total)


def min_max(values: np.ndarray) -> np.ndarray:
    """Minimum and maximum of a set under each permutation."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(HASHES, np.uint64)
    for at in range(0, len(values), 4096):
        hashed = (values[None, at : at + 4096] ^ _SALTS) * _FACTORS
        low = np.minimum(low, hashed.min(1))
        high = np.maximum(high, hashed.max(1))
    return np.concatenate([low, high])


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """Bucket keys of a set: one per band of its signature."""
    signature = min_max(values)[_ORDER]
    bands = len(signature) // rows
    keys = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for column in signature[: bands * rows].reshape(bands, rows).T:
        keys = mix_bits(keys * np.uint64(0xD6E8FEB86659FD93) + column)
    return keys


def _bytes(text: pa.StringScalar) -> np.ndarray:
    raw = text.as_buffer() if text.is_valid else None
    return np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)


# --- jobs ---------------------------------------------------------------------------

def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n_shingles, a set's 128-bit digest (d1, d2) and its bucket keys."""
    words, rows = like.words, like.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, first, second, keys = [], [], [], []
            for text in batch.column(1):
                found = shingles(_bytes(text), words)
                counts.append(len(found))
                first.append(found.sum(dtype=np.uint64))
                second.append(mix_bits(found ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64))
                keys.append(band_keys(found, rows).view(np.int64) if len(found) else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(offsets, np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "keys"],
            )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, shingles) for the ids of ``wanted``.

    A Bloom filter of fixed size picks the texts, so the rest is neither
    hashed nor shuffled; the join leaves out what the filter let pass.
    """
    words = like.words
    bits = bloom_bits(wanted.select(F.xxhash64("doc_id").alias("hash")), "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = np.flatnonzero(in_bloom(bits, batch.column(2).to_numpy().view(np.uint64)))
            sets = [shingles(_bytes(batch.column(1)[i]), words).view(np.int64) for i in picked.tolist()]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(picked)), pa.ListArray.from_arrays(offsets, flat)],
                names=["doc_id", "shingles"],
            )

    keyed = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    keyed = keyed.withColumn("hash", F.xxhash64("doc_id"))
    found = keyed.mapInArrow(run, "doc_id long, shingles array<long>").join(wanted, "doc_id", "left_semi")
    # Of rows that repeat an id, the one that stands for it.
    longest = found.groupBy("doc_id").agg(F.max(F.struct(F.size("shingles"), "shingles")).alias("s"))
    return longest.select("doc_id", "s.shingles")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) and the smallest node it reaches.

    Alternates large and small stars, which halves distances at each turn; a
    node with many edges only ever takes part in sums and joins.
    """
    edges = park(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = park(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = park(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """(key, rep, members) of buckets with two members or more.

    Of buckets with the same members one stays.
    """
    buckets = keyed.groupBy("key").agg(
        F.count("*").alias("members"),
        F.min("rep").alias("least"),
        F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("again"), "rep")).alias("y"),
    )
    one = buckets.where("members > 1").groupBy("members", "least", "x", "y").agg(F.min("key").alias("key"))
    return keyed.join(one.select("key", "members"), "key")


def leader_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket and the bucket's most shared member."""
    degree = shared.groupBy("rep").agg(F.sum("members").alias("degree"))
    ranked = shared.join(degree, "rep")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("degree", -F.col("rep"))).alias("top"))
    leaders = leaders.select("key", (-F.col("top.col2")).alias("leader"))
    pairs = shared.join(leaders, "key").where("rep <> leader")
    return pairs.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs that are similar enough, by their whole sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    sizes = F.size("left") + F.size("right")
    both = F.size(F.array_intersect("left", "right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", sizes.alias("sizes"), both.alias("both"))
    return joined.where(F.col("both") * 100 >= (F.col("sizes") - F.col("both")) * like.percent).select("a", "b")


def _across(percent: int):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between different components of two blocks; at most one less than there are members."""
        rows = rows.drop_duplicates("rep")
        group = rows["component"].to_numpy().copy()
        block, reps = rows["block"].to_numpy(), rows["rep"].to_numpy()
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        sets = rows["shingles"].tolist()
        sizes = np.array([len(s) for s in sets])
        flat, ids = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        flat = np.unique(flat, return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(flat.max() + 1, bool)
        found = []
        # Members of the smallest components look for partners first.
        names, where, count = np.unique(group, return_inverse=True, return_counts=True)
        for i in np.argsort(count[where], kind="stable"):
            other = (group != group[i]) & ((block == low) & (block[i] == high) | (block == high) & (block[i] == low))
            if not other.any():
                continue
            mine = flat[starts[i] : starts[i + 1]]
            mark[mine] = True
            same = np.bincount(ids[mark[flat]], minlength=len(sets))
            mark[mine] = False
            union = sizes + sizes[i] - same
            for j in np.flatnonzero(other & (same * 100 >= union * percent)):
                if group[i] != group[j]:
                    found.append((reps[i], reps[j]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def remaining_links(shared: DataFrame, sets: DataFrame, found: DataFrame, like: Likeness) -> DataFrame:
    """Links between members of one bucket that no link found so far connects."""
    labelled = shared.where("members > 2").join(found, shared["rep"] == found["node"], "left")
    labelled = labelled.select("key", "rep", "members", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    labelled = labelled.join(mixed.where("lo <> hi").select("key"), "key")
    rows = labelled.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    weight = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("weight"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    rows = rows.join(weight.select("key", blocks.alias("blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", "rep", "component", "block", "shingles",
        F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"),
    )
    return rows.groupBy("key", "low", "high").applyInPandas(_across(like.percent), "a long, b long")


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    ``docs`` has doc_id and text; other columns are not read. Null and empty
    texts have no shingles and are linked with nothing. Rows that repeat a
    doc_id are one document, the one with the most shingles. Rows without a
    doc_id come back as they are, unlinked and kept. No rows give no rows.
    """
    rows = park(signatures(docs, like), "signatures")
    known = rows.where("doc_id is not null")
    own = known.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "d1", "d2")).alias("s")).select("doc_id", "s.*")
    classes = own.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = park(classes, "classes")
    match = (F.col("doc_id") == F.col("rep")) & (known["d1"] == classes["d1"]) & (known["d2"] == classes["d2"])
    keyed = known.join(classes, match).select("rep", F.explode("keys").alias("key")).distinct()
    shared = park(shared_buckets(keyed), "shared")
    pairs = park(leader_pairs(shared), "pairs")
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = park(shingle_sets(docs, wanted, like), "sets")
    links = park(confirmed(pairs, sets, like), "links")
    found = park(components(links), "components")
    more = park(remaining_links(shared, sets, found, like), "more")
    found = components(links.union(more))
    named = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", "rep", F.coalesce("component", "rep").alias("component_id")
    )
    whole = own.join(named, (own["d1"] == named["d1"]) & (own["d2"] == named["d2"]) & (own["n_shingles"] > 0), "left")
    component = F.coalesce("component_id", "doc_id")
    result = whole.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )
    nameless = rows.where("doc_id is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    return result.union(nameless)


def _by_text(rows: DataFrame) -> DataFrame:
    """``row, doc_id, text`` with an id of its own for every further text of a doc_id.

    The further texts get numbers below all ids. They are stored, so every step
    that follows sees the same ones.
    """
    tie = F.xxhash64("row.text")
    plain = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))
    ties = rows.select(F.col("row.doc_id").cast("long").alias("of"), tie.alias("tie")).distinct()
    per_id = ties.groupBy("of").agg(F.min("tie").alias("first"), F.max("tie").alias("last"))
    several = park(per_id.where("first <> last").select("of", "first"), "several")
    if several.isEmpty():
        return plain
    least = rows.agg(F.min(F.col("row.doc_id").cast("long"))).first()[0]
    further = ties.join(several, "of").where("tie <> first").select("of", "tie")
    further = park(further.withColumn("own", F.lit(least) - 1 - F.monotonically_increasing_id()), "further")
    known = plain.withColumn("tie_", tie).join(
        further, (F.col("doc_id") == F.col("of")) & (F.col("tie_") == F.col("tie")), "left"
    )
    return known.select("row", F.coalesce("own", "doc_id").alias("doc_id"), "text")


def keep_one(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, with all columns.

    Different texts of one doc_id are documents of their own; of rows alike in
    id and text one stays. Null and empty texts are like nothing, and rows
    without a doc_id stay as they are. No rows give no rows, and columns may
    have any names.
    """
    rows = docs.where(docs["doc_id"].isNotNull()).select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = _by_text(rows)
    kept = near_duplicates(keyed, like).where("kept").select(F.col("doc_id").alias("keep"))
    named = keyed.join(kept, keyed["doc_id"] == kept["keep"], "left_semi").dropDuplicates(["doc_id"])
    return named.select("row.*").unionByName(docs.where(docs["doc_id"].isNull()))
