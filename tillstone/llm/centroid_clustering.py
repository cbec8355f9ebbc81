"""Centroid clustering: rounds of assignment through a vantage-point tree over the centroids.

Vectors are whole numbers, so distances, sums and ties are exact. Before every round the centroids (as many
as the parameter ``k`` says, whatever the table's size) are put into a vantage-point tree, which is
broadcast. A node holds a vantage centroid and, for the centroids nearer and farther than the median, the
least and largest distance from it; by the triangle inequality a vector whose own distance to the vantage
is d is at least ``max(least - d, d - largest)`` away from any of them. Each vector walks the tree best
first: it opens its own open node with the smallest bound until that bound exceeds its best distance. The
bound prunes only beyond that distance (inclusive, with room for the rounding of square roots), so a
centroid of equal distance and smaller number is still seen; distances to centroids are whole numbers. The
walk of all vectors of an Arrow batch advances together, one node a vector and step.

A task keeps one sum a cluster and dimension for all its vectors; Spark adds these up by (cluster,
dimension), and the driver gets ``k`` times ``dims`` rows whatever the table's size.

Results: one row for each kept row; rows that repeat an id are vectors of their own. A row is kept if its
vector has exactly ``dims`` components and none is null, NaN or infinite. Equal distances go to the smaller
centroid number; equal hashes of first centroids go by the components. A null id hashes as an empty one.
With fewer than ``k`` kept vectors there are that many centroids; without any the result is empty. Whole
numbers beyond 2^27 are reckoned with Python's integers; those beyond a long are held at its ends, and a
distance or sum of distances that a long can't hold is null. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut

SCALE = 64
LEAF = 3
# Up to this size squared distances of 64 dimensions stay far below 2^63.
EXACT_LONG = 1 << 27
# Share of a distance by which bounds are lowered, above any rounding of two square roots.
ROOM = 1e-9
LONG_MAX = (1 << 63) - 1


def whole_vectors(df: DataFrame, dims: int, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector): kept rows with components as whole numbers."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(vector.isNotNull() & (F.size(vector) == dims) & finite).select(
        F.col(id_column).alias("id"), F.transform(vector, lambda x: F.floor(x * SCALE)).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(row.vector) for row in vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()]


def as_array(rows) -> np.ndarray:
    """Longs where distances between them stay exact, Python's integers else."""
    found = np.asarray(rows, dtype=np.int64)
    # the least long has no positive counterpart, so both ends are looked at
    if found.size and max(int(found.max()), -int(found.min())) > EXACT_LONG:
        return found.astype(object)
    return found


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


def root(distances: np.ndarray) -> np.ndarray:
    return np.sqrt(distances.astype(np.float64))


def build_tree(centroids: np.ndarray) -> list[tuple]:
    """Nodes (vantage or -1, members of a leaf, children); a child is (node, least, largest) distance."""
    nodes: list[tuple] = []

    def grow(members: list[int]) -> int:
        place = len(nodes)
        nodes.append(())
        if len(members) <= LEAF:
            nodes[place] = (-1, members, ())
            return place
        vantage, rest = members[0], members[1:]
        far = root(squared(centroids[rest], centroids[vantage]))
        order = np.argsort(far, kind="stable")
        half = len(rest) // 2
        children = []
        for part in (order[:half], order[half:]):
            children.append((grow([rest[i] for i in part]), float(far[part].min()), float(far[part].max())))
        nodes[place] = (vantage, [], tuple(children))
        return place

    grow(list(range(len(centroids))))
    return nodes


def nearest(vectors: np.ndarray, centroids: np.ndarray, nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of every vector."""
    if vectors.dtype == object or centroids.dtype == object:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    n = len(vectors)
    best = np.full(n, LONG_MAX if vectors.dtype != object else 1 << 200, dtype=vectors.dtype)
    label = np.full(n, len(centroids), dtype=np.int64)
    bounds = np.full((n, len(nodes)), np.inf)
    bounds[:, 0] = 0.0

    def meet(rows: np.ndarray, centroid: int) -> np.ndarray:
        found = squared(vectors[rows], centroids[centroid])
        better = ((found < best[rows]) | ((found == best[rows]) & (centroid < label[rows]))).astype(bool)
        best[rows[better]], label[rows[better]] = found[better], centroid
        return found

    waiting = np.arange(n)
    while len(waiting):
        node_of = bounds[waiting].argmin(axis=1)
        within = bounds[waiting, node_of] <= root(best[waiting]) * (1 + ROOM)
        waiting, node_of = waiting[within], node_of[within]
        for node in np.unique(node_of):
            rows = waiting[node_of == node]
            above = bounds[rows, node]
            bounds[rows, node] = np.inf
            vantage, members, children = nodes[node]
            for member in members:
                meet(rows, member)
            if vantage >= 0:
                d = root(meet(rows, vantage))
                for child, least, largest in children:
                    bound = np.maximum(least - d, d - largest) - ROOM * (d + largest)
                    bounds[rows, child] = np.maximum(np.maximum(bound, above), 0.0)
        waiting = waiting[np.isfinite(bounds[waiting].min(axis=1))]
    return label, best


def _batch_vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return as_array(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))


def _sums(batches: Iterator[pa.RecordBatch], shared, dims: int) -> Iterator[pa.RecordBatch]:
    """One row a cluster met by the task: cluster, number of vectors, component sums."""
    centroids, nodes = shared.value
    counts, totals = [0] * len(centroids), [np.zeros(dims, dtype=object) for _ in centroids]
    for batch in batches:
        if batch.num_rows:
            vectors = _batch_vectors(batch, dims)
            label, _ = nearest(vectors, centroids, nodes)
            for cluster in np.unique(label):
                own = vectors[label == cluster]
                counts[cluster] += len(own)
                totals[cluster] = totals[cluster] + own.sum(axis=0)
    met = [c for c, n in enumerate(counts) if n]
    yield pa.RecordBatch.from_arrays([
        pa.array(met, pa.int32()), pa.array([counts[c] for c in met], pa.int64()),
        pa.array([[Decimal(int(x)) for x in totals[c]] for c in met], pa.list_(pa.decimal128(38, 0))),
    ], names=["cluster", "n", "totals"])


def _labels(batches: Iterator[pa.RecordBatch], shared, dims: int) -> Iterator[pa.RecordBatch]:
    centroids, nodes = shared.value
    for batch in batches:
        if batch.num_rows:
            label, best = nearest(_batch_vectors(batch, dims), centroids, nodes)
            held = [int(d) if d <= LONG_MAX else None for d in best.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label, pa.int32()), pa.array(held, pa.int64())], names=["id", "cluster", "distance"])


def cluster_vectors(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, seed: int = 1,
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = df.sparkSession
    vectors = whole_vectors(df, dims, id_column, vector_column)
    id_type = vectors.schema["id"].dataType.simpleString()
    start = first_centroids(vectors, k, seed)
    if not start:
        return spark.createDataFrame([], f"`{id_column}` {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    centroids = as_array(start)

    def shared():
        return spark.sparkContext.broadcast((centroids, build_tree(centroids)))

    for _ in range(rounds):
        tree = shared()
        sums = vectors.select("vector").mapInArrow(lambda batches: _sums(batches, tree, dims), "cluster int, n bigint, totals array<decimal(38,0)>")
        met = sums.select("cluster", "n", F.posexplode("totals").alias("dim", "total")).groupBy("cluster", "dim").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        moved = [list(map(int, c)) for c in centroids]
        for row in met:
            moved[row.cluster][row.dim] = int(row.total) // row.n
        centroids = as_array(moved)
        tree.unpersist()
    tree = shared()
    labelled = cut(vectors.mapInArrow(lambda batches: _labels(batches, tree, dims), f"id {id_type}, cluster int, distance bigint"))
    # at most k rows, whatever the table's size
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    inertias = labelled.groupBy("cluster").agg(total.alias("own")).collect()
    whole = None if any(row.own is None for row in inertias) else sum(int(row.own) for row in inertias)
    rows = [(row.cluster, _held(row.own), _held(whole), hashlib.sha256(",".join(str(int(x)) for x in centroids[row.cluster]).encode()).hexdigest())
            for row in inertias]
    described = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return labelled.join(F.broadcast(described), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _held(value) -> int | None:
    return int(value) if value is not None and int(value) <= LONG_MAX else None
