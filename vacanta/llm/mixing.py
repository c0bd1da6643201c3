"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents are dealt into blocks by a hash and its blocks put in a
random order. Its target in words is a number of whole rounds over all blocks,
a run of whole blocks of one more round, and one last block taken in part. The
blocks drawn from all sources are then split among the output shards: at each
node of a binary tree a multivariate hypergeometric draw says how many blocks
of each source go left, so every shard's share is an exact sample without
replacement and the quotas of all shards add up. A shard's blocks are disjoint
stretches of the permuted blocks, and its rows are shuffled within the shard.

Only numbers per block travel to the driver, at most ``BLOCKS`` a source. The
block that is taken in part is dealt into blocks again until few documents are
left, so no step looks at more rows of a source than fit in a task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm.common import WORD, column, others, park

BLOCKS = 512  # per source and level
DOCS_PER_BLOCK = 32  # a source with fewer documents than BLOCKS of these gets fewer blocks
LAST_DOCS = 1024  # a block of so few documents is settled document by document
SHARE = 1.5
MOST = 2.0
WEIGHTS = (3.0, 1.0, 2.0)


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source: ``share`` of all, by weight, at most ``most`` times its size.

    What a source cannot take is shared again by weight among the others,
    until none is above its limit.
    """
    left = share * sum(sizes)
    open_, result = set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] > most * sizes[i] * weight}
        if not full:
            for i in open_:
                result[i] = left * weights[i] / weight
            break
        for i in full:
            result[i] = most * sizes[i]
        left = max(0.0, left - sum(result[i] for i in full))
        open_ -= full
    return result


def split_quotas(quotas: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (column) for each shard (row); columns add up to ``quotas``."""
    quotas = np.asarray(quotas, dtype=np.int64)
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    # Shards are equally large up to one block; the tree draws without replacement.
    here = int(quotas.sum()) * left // shards
    if quotas.sum():
        drawn = rng.multivariate_hypergeometric(quotas, here, method="marginals")
    else:
        drawn = quotas * 0
    return np.vstack([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


class Source(NamedTuple):
    number: int
    name: str | None
    words: int
    documents: int
    target: float
    rounds: int  # times that every document is taken
    rest: int  # words of one more round


class Mix(NamedTuple):
    """``rows``: id, source_no, tie, size, times, shards (one per copy), extra_shard, extra, part."""

    rows: DataFrame
    sources: list[Source]


def document_key(docs: DataFrame) -> DataFrame:
    """Slim rows of the documents: what a draw depends on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("id"),
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"),
    )


def _permuted(blocks: int, *seed: int) -> list[int]:
    return np.random.default_rng(seed).permutation(blocks).tolist()


def _blocks(documents: int) -> int:
    return max(1, min(BLOCKS, documents // DOCS_PER_BLOCK))


def _with_block(spark: SparkSession, rows: DataFrame, counts: dict[int, int], level: int, seed: int) -> DataFrame:
    width = spark.createDataFrame(list(counts.items()), "source_no int, blocks int")
    spot = F.xxhash64(F.lit(f"block {seed} {level}"), "id", "tie")
    return (
        rows.join(F.broadcast(width), "source_no")
        .withColumn("block", F.pmod(spot, F.col("blocks")).cast("int"))
        .drop("blocks")
    )


def _draw(rows: DataFrame, rest: dict[int, int], counts: dict[int, int], *seed: int):
    """Whole blocks in permuted order while they fit, and the block that the rest ends in."""
    sums = rows.groupBy("source_no", "block").agg(
        F.sum(F.col("size") * F.col("times")).alias("words"), F.count("*").alias("documents")
    )
    # At most BLOCKS numbers a source.
    of = {(r[0], r[1]): (int(r[2]), int(r[3])) for r in sums.collect()}
    whole: dict[int, list[int]] = {}
    cut: dict[int, tuple[int, int, int]] = {}
    for source, words in rest.items():
        whole[source] = []
        for block in _permuted(counts[source], *seed, source) if words else []:
            has, documents = of.get((source, block), (0, 0))
            if has > words:
                if words:
                    cut[source] = (block, documents, words)
                break
            words -= has
            whole[source].append(block)
    return whole, cut


def _deal(sources: list[Source], counts, whole, cut, shards: int, seed: int) -> list[tuple]:
    """(source, block, shard of each copy, shard of the part, is cut) by the splitting tree."""
    drawn = []
    for s in sources:
        order = _permuted(counts[s.number], seed, 0, s.number)
        last = [cut[s.number][0]] if s.number in cut else []
        drawn.append(order * s.rounds + whole[s.number] + last)
    rng = np.random.default_rng([seed, 1 << 20])
    quotas = split_quotas([len(d) for d in drawn], shards, rng)
    dealt = []
    for s, blocks, mine in zip(sources, drawn, quotas.T, strict=True):
        to = np.repeat(np.arange(shards), mine).tolist()
        of: dict[int, list[int]] = {block: [] for block in range(counts[s.number])}
        part = None
        if s.number in cut:
            blocks, part, to = blocks[:-1], to[-1], to[:-1]
        for block, shard in zip(blocks, to, strict=True):
            of[block].append(shard)
        for block, copies in of.items():
            ends = part is not None and block == cut[s.number][0]
            dealt.append((s.number, block, copies, part if ends else None, ends))
    return dealt


def _fill(seed: int, whole_only: bool):
    def fill(block: pd.DataFrame) -> pd.DataFrame:
        """Documents in random order while they fit; the words left come from one that does not."""
        spot = [xxhash.xxh64_intdigest(f"{seed} {i} {t}") for i, t in zip(block["id"], block["tie"], strict=True)]
        block = block.assign(spot=spot).sort_values("spot")
        rest = int(block["rest"].iloc[0])
        extra, part, over = [], [], False
        for size, times in zip(block["size"], block["times"], strict=True):
            n = min(int(times), rest // int(size)) if size else 0
            rest -= n * int(size)
            extra.append(n)
        for n, times, size in zip(extra, block["times"], block["size"], strict=True):
            here = not whole_only and not over and rest > 0 and n < times and size > rest
            part.append(rest if here else 0)
            over = over or here
        return block.assign(extra=extra, part=part).drop(columns=["rest", "spot"])

    return fill


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    shards: int = 16,
    seed: int = 7,
    whole: bool = False,
) -> Mix:
    """Decide how often each document is taken, and into which shard each copy goes.

    ``docs`` has doc_id, source and text; other columns are not read. Sources
    in code-point order, null last, take ``weights`` in turn. At most one
    document of a source is taken in ``part``, so that the source's words meet
    its target to the word; with ``whole`` that part is left out. Null texts
    have size 0 and null ids are ids like any other. Equal rows are one row
    whose ``times`` says how many; they are drawn one by one. No rows give no
    rows. The draw depends on ids, texts and ``seed`` alone, so reruns agree.
    """
    spark = docs.sparkSession
    slim = document_key(docs).groupBy("id", "source", "size", "tie").agg(F.count("*").alias("times"))
    slim = park(slim, "mix")
    stats = slim.groupBy("source").agg(
        F.sum(F.col("size") * F.col("times")).alias("words"), F.count("*").alias("documents")
    )
    # A few numbers per source.
    found = sorted(stats.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    words = [int(r["words"]) for r in found]
    goals = targets(words, [weights[i % len(weights)] for i in range(len(found))], share, most)
    sources = []
    for i, (r, n, goal) in enumerate(zip(found, words, goals, strict=True)):
        rounds = round(goal) // n if n else 0
        sources.append(Source(i, r["source"], n, int(r["documents"]), goal, rounds, round(goal) - rounds * n))
    numbers = spark.createDataFrame([(s.number, s.name) for s in sources], "source_no int, name string")
    rows = slim.join(F.broadcast(numbers), slim["source"].eqNullSafe(numbers["name"])).drop("name", "source")

    counts = {s.number: _blocks(s.documents) for s in sources}
    rows = _with_block(spark, rows, counts, 0, seed)
    rest = {s.number: s.rest for s in sources}
    chosen, cut = _draw(rows, rest, counts, seed, 0)
    dealt = spark.createDataFrame(
        _deal(sources, counts, chosen, cut, shards, seed),
        "source_no int, block int, shards array<int>, extra_shard int, ends boolean",
    )
    rows = rows.join(F.broadcast(dealt), ["source_no", "block"]).drop("block")
    nothing = {"extra": F.lit(0).cast("long"), "part": F.lit(0).cast("long")}
    settled = rows.where(~F.col("ends")).drop("ends").withColumns(nothing)
    edge = rows.where("ends").drop("ends")
    level = 0
    while cut:
        level += 1
        last = {i: words for i, (_, documents, words) in cut.items() if documents <= LAST_DOCS}
        if last:
            ends = spark.createDataFrame(list(last.items()), "source_no int, rest long")
            few = edge.join(F.broadcast(ends), "source_no")
            settled = settled.unionByName(
                few.groupBy("source_no").applyInPandas(_fill(seed, whole), settled.schema)
            )
        more = {i: c for i, c in cut.items() if i not in last}
        if not more:
            break
        counts = {i: _blocks(documents) for i, (_, documents, _) in more.items()}
        edge = _with_block(spark, edge, counts, level, seed)
        chosen, cut = _draw(edge, {i: c[2] for i, c in more.items()}, counts, seed, level)
        state = [
            (i, block, block in set(chosen[i]), i in cut and cut[i][0] == block)
            for i in counts
            for block in range(counts[i])
        ]
        state = spark.createDataFrame(state, "source_no int, block int, taken boolean, ends boolean")
        edge = edge.join(F.broadcast(state), ["source_no", "block"]).drop("block")
        done = edge.where(~F.col("ends")).withColumns(
            {"extra": F.when(F.col("taken"), F.col("times")).otherwise(0).cast("long"), "part": nothing["part"]}
        )
        settled = settled.unionByName(done.drop("taken", "ends"))
        edge = edge.where("ends").drop("taken", "ends")
    return Mix(settled, sources)


def mixed_rows(docs: DataFrame, mixture: Mix, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` once per whole copy taken, with all their columns.

    Adds ``mix_shard`` and ``mix_order``, a random place in the shard; sort by
    both to write the shards. Columns of ``docs`` of these names, in whatever case,
    are replaced. Rows alike in id, source and text count as one here, as
    their copies are all decided together; where their other columns differ,
    the row whose JSON comes first stays. Parts of documents are not given. No
    rows give no rows.
    """
    extra = F.array_repeat("extra_shard", F.col("extra").cast("int"))
    every = F.flatten(F.array_repeat("shards", F.col("times").cast("int")))
    names = mixture.rows.sparkSession.createDataFrame(
        [(s.number, s.name) for s in mixture.sources], "source_no int, mix_source string"
    )
    copies = (
        mixture.rows.where((F.size("shards") > 0) | (F.col("extra") > 0))
        .join(F.broadcast(names), "source_no")
        .select(F.col("id").alias("mix_id"), "mix_source", F.col("tie").alias("mix_tie"), F.concat(every, extra).alias("to"), "times")
    )
    repeated = copies.where("times > 1").limit(1).count()
    row = F.struct(*[column(c) for c in others(docs, ["mix_shard", "mix_order"])])
    text = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(
        row.alias("row"), F.col("doc_id").alias("row_id"), F.col("source").alias("row_source"), text.alias("row_text")
    )
    if repeated:
        keyed = keyed.groupBy("row_id", "row_source", "row_text").agg(F.min_by("row", F.to_json("row")).alias("row"))
    same = (
        keyed["row_id"].eqNullSafe(copies["mix_id"])
        & (keyed["row_text"] == copies["mix_tie"])
        & keyed["row_source"].eqNullSafe(copies["mix_source"])
    )
    spot = F.xxhash64(F.lit(f"order {seed}"), "row_id", "row_text", "copy")
    taken = keyed.join(copies, same).select("row", "row_id", "row_text", F.posexplode("to").alias("copy", "mix_shard"))
    return taken.select("row.*", "mix_shard", spot.alias("mix_order"))
