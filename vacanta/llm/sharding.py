"""Consistent-hash ring with virtual nodes and bounded loads.

Keys and virtual nodes lie on a ring of a fixed number of cells. A key belongs
to the first virtual node clockwise of its cell; what a full shard cannot take
goes on clockwise to the next shard that has room. Every shard's bound is the
exact mean (rounded up for the first ``n mod shards``), so counts are at most
one apart whatever the keys, and only the overflow leaves its home.

The work is one sort of slim rows. Their order on the ring gives each row its
rank; how many rows a cell holds (at most ``CELLS`` numbers) is all that the
driver needs to lay out which stretch of a cell goes to which shard.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import park

CELLS = 1 << 14
VIRTUAL_NODES = 64


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise.

    A shard's nodes depend on its number alone: one more shard adds nodes and
    moves none.
    """
    nodes = (
        (xxhash.xxh64_intdigest(f"{shard}:{node}") % CELLS, shard)
        for shard in range(n_shards)
        for node in range(virtual_nodes)
    )
    return sorted(nodes)


def preference(n_shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[list[int]]:
    """Per node of the ring, the shards in the order they come clockwise."""
    nodes = ring(n_shards, virtual_nodes)
    order = []
    for first in range(len(nodes)):
        seen = dict.fromkeys(nodes[(first + k) % len(nodes)][1] for k in range(len(nodes)))
        order.append(list(seen))
    return order


def bounds(rows: int, n_shards: int) -> list[int]:
    """Room of each shard: together exactly ``rows``, at most one apart."""
    return [rows // n_shards + (shard < rows % n_shards) for shard in range(n_shards)]


def layout(
    cells: dict[int, int], n_shards: int, virtual_nodes: int = VIRTUAL_NODES
) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank + 1, shard, first slot) for the rows per cell.

    All cells are served by their home before any overflow moves on, then all
    overflow moves one shard further, and so on: keys travel no further than
    full shards make them.
    """
    nodes = [cell for cell, _ in ring(n_shards, virtual_nodes)]
    order = preference(n_shards, virtual_nodes)
    room = bounds(sum(cells.values()), n_shards)
    slots = [0] * n_shards
    start, waiting = 0, []
    for cell in sorted(cells):
        waiting.append((cell, start, start + cells[cell], bisect_left(nodes, cell) % len(nodes)))
        start += cells[cell]
    stretches = []
    for step in range(n_shards):
        left = []
        for cell, first, end, node in waiting:
            shard = order[node][step]
            take = min(end - first, room[shard])
            if take:
                stretches.append((cell, first, first + take, shard, slots[shard]))
                room[shard] -= take
                slots[shard] += take
            if first + take < end:
                left.append((cell, first + take, end, node))
        waiting = left
    return stretches


def assign_shards(
    rows: DataFrame, key: Column, tie: Column, n_shards: int, virtual_nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard).

    ``key`` gives the place on the ring; rows of equal key stay together as far
    as the bounds allow, and ``tie`` orders them. Nulls are a key like any
    other, equal rows get slots of their own, and no rows give no rows. ``rows``
    should be slim: they are sorted once and written once.
    """
    spark = rows.sparkSession
    placed = rows.drop("shard", "slot").select(F.struct("*").alias("row"), F.xxhash64(key).alias("spot"), F.xxhash64(tie).alias("tie"))
    placed = placed.withColumn("cell", F.pmod("spot", F.lit(CELLS)).cast("int"))
    ordered = (
        placed.repartitionByRange("cell", "spot", "tie")
        .sortWithinPartitions("cell", "spot", "tie")
        .withColumn("at", F.monotonically_increasing_id())
        .select("row", "cell", F.shiftright("at", 33).cast("int").alias("piece"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at"))
    )
    ordered = park(ordered, "ring")
    # One number per cell and one per sorted piece: bounded by CELLS and by the
    # number of tasks, whatever the rows.
    cells = {r[0]: r[1] for r in ordered.groupBy("cell").count().collect()}
    pieces = sorted(ordered.groupBy("piece").count().collect())
    begins, total = [], 0
    for piece, count in pieces:
        begins.append((piece, total))
        total += count
    stretches = spark.createDataFrame(
        layout(cells, n_shards, virtual_nodes),
        "cell int, first long, end long, shard int, slot0 long",
    )
    begins = spark.createDataFrame(begins, "piece int, begin long")
    rank = F.col("begin") + F.col("at")
    return (
        ordered.join(F.broadcast(begins), "piece")
        .join(F.broadcast(stretches), "cell")
        .where((rank >= F.col("first")) & (rank < F.col("end")))
        .select("row.*", "shard", (F.col("slot0") + rank - F.col("first")).alias("slot"))
    )
