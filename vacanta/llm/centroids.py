"""Centroid clustering of integer vectors, with a vantage-point tree over the centroids.

Every round builds the tree anew on the driver, broadcasts it, and each vector
searches it best first: of the nodes it has not opened it opens the one with
the least lower bound, and it stops where that bound exceeds the distance of
the best centroid found. A bound equal to it is still opened, so ties are seen;
of equally near centroids the smaller number wins. Centroids at inner nodes and
in leaves are compared by exact integer squared distances; only bounds are
floating point, and they are rounded down.

The searches of a batch run in step: each vector has its own bounds and its own
best, and numpy opens, for all vectors that chose a node, that node at once.
Sums for the new centroids are exact and are added per task before the shuffle.
What reaches the driver is one row per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import park

DIMENSIONS = 64
SCALE = 64  # components are floor(SCALE * x)
CENTROIDS = 16
ROUNDS = 3
SEED = 1
LEAF = 3  # centroids of a leaf at most
# With components up to this, a squared distance of LARGEST_DIMENSIONS components is a long.
LARGEST = 1 << 27
LARGEST_DIMENSIONS = 64
BATCH = 4096  # vectors that search in step

VECTORS = "vec_id long, vector array<long>"


# --- the tree ---------------------------------------------------------------------------

class Tree(NamedTuple):
    """Nodes in arrays; node 0 is the root and ``-1`` stands for no node."""

    centroids: np.ndarray  # one row each, integers
    members: list[list[int]]  # centroids compared when a node is opened
    children: np.ndarray  # nearer and farther child
    near: np.ndarray  # least and greatest distance of a child's centroids
    far: np.ndarray  # from the vantage point, per child


def squared_distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances as 64-bit integers."""
    gap = vectors - centroid
    return np.einsum("ij,ij->i", gap, gap)


def build_tree(centroids: np.ndarray, leaf: int = LEAF) -> Tree:
    """Vantage-point tree: each inner node's centroid parts the others at their median distance.

    The vantage point of a node is the centroid farthest from the first one, as
    distances from the rim spread most. Equal distances are parted by number.
    """
    members: list[list[int]] = []
    children: list[list[int]] = []
    near: list[list[float]] = []
    far: list[list[float]] = []

    def grow(numbers: list[int]) -> int:
        node = len(members)
        members.append(numbers)
        children.append([-1, -1])
        near.append([0.0, 0.0])
        far.append([0.0, 0.0])
        if len(numbers) > leaf:
            first = squared_distances(centroids[numbers], centroids[numbers[0]])
            point = numbers[int(first.argmax())]
            others = [n for n in numbers if n != point]
            squares = squared_distances(centroids[others], centroids[point])
            order = np.lexsort((others, squares))
            members[node] = [point]
            half = (len(others) + 1) // 2
            for side, part in enumerate((order[:half], order[half:])):
                reach = np.sqrt(squares[part].astype(float))
                near[node][side], far[node][side] = reach.min(), reach.max()
                children[node][side] = grow(sorted(others[i] for i in part))
        return node

    if len(centroids):
        grow(list(range(len(centroids))))
    return Tree(centroids, members, np.array(children, int).reshape(-1, 2), np.array(near).reshape(-1, 2),
                np.array(far).reshape(-1, 2))


def search(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and how many distances were taken."""
    n = len(vectors)
    best = np.full(n, np.iinfo(np.int64).max)
    nearest = np.full(n, len(tree.centroids))
    bounds = np.full((n, len(tree.members)), np.inf)
    bounds[:, 0] = 0.0
    active, taken = np.arange(n), 0
    while len(active):
        node = bounds[active].argmin(1)
        least = bounds[active, node]
        # Inclusive: a node that may hold a centroid just as near is opened.
        stay = (least < np.inf) & (least <= np.sqrt(best[active].astype(float)))
        active, node = active[stay], node[stay]
        for k in np.unique(node):
            rows = active[node == k]
            bounds[rows, k] = np.inf
            for c in tree.members[k]:
                square = squared_distances(vectors[rows], tree.centroids[c])
                taken += len(rows)
                better = (square < best[rows]) | ((square == best[rows]) & (c < nearest[rows]))
                best[rows[better]], nearest[rows[better]] = square[better], c
            if tree.children[k, 0] >= 0:  # an inner node has one member, its vantage point
                reach = np.sqrt(square.astype(float))
                for side, child in enumerate(tree.children[k]):
                    gap = np.maximum(reach - tree.far[k, side], tree.near[k, side] - reach)
                    slack = 1e-12 * (reach + tree.far[k, side])  # more than the roots are rounded by
                    bounds[rows, child] = np.maximum(gap - slack, 0.0)
    return nearest, best, taken


# --- Spark ------------------------------------------------------------------------------

def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``, floor(scale * x) of each component x as a double.

    Vectors are left out that are null, have another number of components or a
    component that is null, infinite or not a number, and those with a
    component beyond ``LARGEST``, whose squared distances no long can hold.
    """
    assert dimensions <= LARGEST_DIMENSIONS
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    # The bound also fails for infinities and NaN, which is above all numbers.
    whole = F.forall("scaled", lambda x: F.coalesce((x >= -LARGEST) & (x <= LARGEST), F.lit(False)))
    return (
        embeddings.select(F.col("vec_id").cast("long"), scaled.alias("scaled"))
        .where((F.size("scaled") == dimensions) & whole)
        .select("vec_id", F.transform("scaled", lambda x: F.floor(x).cast("long")).alias("vector"))
    )


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order.

    Vectors without an id come last; vectors of one id in the order of their components.
    """
    name = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    order = F.sha2(F.encode(name, "UTF-8"), 256).asc_nulls_last()
    rows = vectors.orderBy(order, "vector").limit(k).collect()  # k rows
    return np.array([r["vector"] for r in rows], np.int64)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("vector")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` (the nearest centroid, the smaller of equals) and squared ``distance``."""
    tree = vectors.sparkSession.sparkContext.broadcast(build_tree(centroids))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            number, square, _ = search(tree.value, _matrix(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(square)],
                ["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(nearest, "vec_id long, cluster int, distance long")


def moved_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as floor(sum / count) of their vectors, exactly; those without vectors stay."""
    tree = vectors.sparkSession.sparkContext.broadcast(build_tree(centroids))
    k, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Python integers carry what 64 bits cannot.
        total, count = np.zeros((k, width), object), np.zeros(k, np.int64)
        for batch in _batches(batches):
            matrix = _matrix(batch)
            number, _, _ = search(tree.value, matrix)
            for c in np.unique(number):
                total[c] += matrix[number == c].sum(0).astype(object)
            count += np.bincount(number, minlength=k)
        some = [(c, i) for c in range(k) if count[c] for i in range(width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in some], pa.int32()), pa.array([i for _, i in some], pa.int32()),
             pa.array([str(total[c, i]) for c, i in some], pa.string()), pa.array([count[c] for c, _ in some], pa.int64())],
            ["cluster", "place", "total", "vectors"],
        )

    parts = vectors.mapInArrow(sums, "cluster int, place int, total string, vectors long")
    added = parts.groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("vectors").alias("vectors")
    )
    moved = centroids.copy()
    for r in added.toLocalIterator():  # k * width rows
        moved[r["cluster"], r["place"]] = int(r["total"]) // r["vectors"]
    return moved


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Assigned vectors after ``rounds`` rounds, and the final centroids.

    ``vectors`` has ``vec_id`` and ``vector`` (``integer_vectors``). Fewer
    vectors than ``k`` are a centroid each; no vectors give no rows. Rows of one
    ``vec_id``, and rows without one, are vectors like all others.
    """
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved_centroids(vectors, centroids)
    return assign(vectors, centroids), centroids


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to assigned vectors."""
    spark = assigned.sparkSession
    rows = park(assigned, "assigned")
    spread = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia")
    per_cluster = {r["cluster"]: r["cluster_inertia"] for r in rows.groupBy("cluster").agg(spread).collect()}
    whole = sum(per_cluster.values())
    facts = [(c, s, whole, centroid_sha256(centroids[c])) for c, s in sorted(per_cluster.items())]
    small = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(small), "cluster")  # a row per centroid


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The query's rows in SQL: all distances in every round, no tree."""
    parts = [
        f"""with recursive scaled as (
      select vec_id, list_transform(embedding, lambda x: {SCALE} * cast(x as double)) as v from embeddings
    ), kept as materialized (
      select vec_id, list_transform(v, lambda x: cast(floor(x) as bigint)) as v from scaled
      where len(v) = {DIMENSIONS} and len(list_filter(v, lambda x: x between -{LARGEST} and {LARGEST})) = {DIMENSIONS}
    ), c0 as (
      select cast(row_number() over (order by h nulls last, v) - 1 as int) as cluster, v
      from (select *, sha256('{seed}:' || cast(vec_id as varchar)) as h from kept) order by h nulls last, v limit {k}
    ), numbered as materialized (select row_number() over () as row_no, * from kept)"""
    ]
    for r in range(rounds + 1):
        parts.append(f"""d{r} as materialized (
      select row_no, vec_id, cluster, distance from (
        select n.row_no, n.vec_id, c.cluster,
          cast(list_sum(list_transform(list_zip(n.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as distance
        from numbered n, c{r} c
      ) qualify row_number() over (partition by row_no order by distance, cluster) = 1
    )""")
        if r < rounds:
            parts.append(f"""s{r} as (
      select d.cluster, i, sum(n.v[i]) as total, count(*) as vectors
      from d{r} d join numbered n using (row_no), range(1, {DIMENSIONS} + 1) t(i) group by all
    ), m{r} as (
      select cluster, list(cast((total - ((total % vectors) + vectors) % vectors) // vectors as bigint) order by i) as v
      from s{r} group by cluster
    ), c{r + 1} as materialized (select c.cluster, coalesce(m.v, c.v) as v from c{r} c left join m{r} m using (cluster))""")
    return ",\n    ".join(parts) + f"""
    select vec_id, cluster, distance,
      cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
      cast(sum(distance) over () as bigint) as inertia,
      sha256(list_aggregate(list_transform(c.v, lambda x: cast(x as varchar)), 'string_agg', ',')) as centroid_sha256
    from d{rounds} join c{rounds} c using (cluster)"""
