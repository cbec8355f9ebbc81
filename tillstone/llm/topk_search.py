"""Exact top-k search by inner product: blocks of queries walk a cover tree of candidates.

The upper levels of a cover tree are fitted on a bounded, documented sample: nested nets whose radius
halves with each level, each center covered by one of the level above. Every vector, query or candidate,
is then put under the nearest center of the last level, and the vectors under a center are dealt into
blocks of bounded size by a hash of the id, each with its own centroid and covering radius. Radii are
those of the rows that they really hold. Only the candidate side is walked as a tree; queries are flat
blocks, and blocks of one center do not part it further.

Each query block first meets one candidate block under its own center, which gives every query a kth
score to beat. Then each query block walks the tree: for query block and candidate node, with centers q, p
and covering radii r, s, no product exceeds q.p + r|p| + s|q| + rs, and the pair is dropped if that is
below the worst kth score of the block's queries. Upper nodes are walked in the task that holds the query
block's summary, as the tree is bounded; surviving centers are joined with their blocks, which are
pruned in the same way, and only surviving pairs of blocks are joined with their vectors.

Scores are integers and all comparisons exact: products are taken in double precision where no sum can
leave 2**53 and in 64-bit integers otherwise.

Results: one row per query and rank. Vectors that are null or hold a null or non-finite component, and
rows without id, take no part. Only vectors of a query's own length are candidates. A query's own row is
any row with its id. Repeated rows are candidates each. Ties go to the smaller id. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstone.llm.common import cut

SAMPLE_ROWS = 2048  # vectors that the upper levels are fitted on
CENTERS = 64  # of the last fitted level, at most
BLOCK_ROWS = 2048  # expected vectors of a block
QUERY_BLOCK_ROWS = 256
LOWEST = -(1 << 63)


@dataclass
class Tree:
    """Nested nets over one vector length: per level the centers' places in the last level and parents."""

    centers: np.ndarray
    levels: list[np.ndarray]
    parents: list[np.ndarray]


def fit_tree(points: np.ndarray, most: int = CENTERS) -> Tree:
    """Cover tree levels: a level keeps the centers above and adds points that lie beyond its radius."""
    chosen = [0]
    gap = np.linalg.norm(points - points[0], axis=1)
    radius = float(gap.max())
    levels, parents = [np.array([0])], [np.array([0])]
    while radius > 1e-9 and len(chosen) < most:
        radius /= 2
        above = len(chosen)
        while len(chosen) < most:
            far = int(gap.argmax())
            if gap[far] <= radius:
                break
            chosen.append(far)
            gap = np.minimum(gap, np.linalg.norm(points - points[far], axis=1))
        if len(chosen) == above:
            continue
        now = points[chosen]
        up = np.linalg.norm(now[:, None] - now[None, :above], axis=2).argmin(axis=1)
        up[:above] = np.arange(above)
        levels.append(np.arange(len(chosen)))
        parents.append(up)
    return Tree(points[chosen], levels, parents)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _place(trees: dict[int, Tree]):
    """Nearest center of the last level for every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            center = np.zeros(batch.num_rows, dtype=np.int32)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                if dim and int(dim) in trees:
                    x = _vectors(batch.column("vector").take(pa.array(at))).astype(np.float64)
                    c = trees[int(dim)].centers
                    center[at] = ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)
            yield pa.record_batch([batch.column("id"), batch.column("dim"), pa.array(center), batch.column("vector")], names=["id", "dim", "center", "vector"])

    return run


BLOCK = "block string, dim int, center int, part int, ids binary, vectors binary, middle array<double>, radius double"


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    dim, center, part = (k.as_py() for k in key)
    ids = rows.column("id").combine_chunks().to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    vectors = _vectors(rows.column("vector").combine_chunks())[order]
    middle = vectors.mean(axis=0)
    radius = float(np.sqrt(((vectors - middle) ** 2).sum(axis=1).max()))
    return pa.table({
        "block": [f"{dim}/{center}/{part}"], "dim": pa.array([dim], pa.int32()), "center": pa.array([center], pa.int32()), "part": pa.array([part], pa.int32()),
        "ids": pa.array([ids[order].tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()), "middle": [middle.tolist()], "radius": [radius],
    })


def _blocks(placed: DataFrame, rows: int) -> DataFrame:
    """Blocks of about ``rows`` vectors; a crowded center is dealt by a hash of the ids."""
    crowd = placed.groupBy("dim", "center").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))
    dealt = placed.join(crowd, ["dim", "center"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return cut(dealt.select("id", "dim", "center", "part", "vector").groupBy("dim", "center", "part").applyInArrow(_block, BLOCK))


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if largest < 2 ** 53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def best(ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
    """Per query the k best (score, id) at or above its floor, as flat arrays: query place, id, score."""
    scores = products(queries, vectors)
    places, names, values = [], [], []
    for i in range(len(own)):
        row = scores[i]
        ok = np.flatnonzero((row >= floor[i]) & (ids != own[i]))
        if len(ok) > k:
            # all that tie with the kth stay, and ids are in order
            least = np.partition(row[ok], len(ok) - k)[len(ok) - k]
            ok = ok[row[ok] >= least]
        ok = ok[np.argsort(-row[ok], kind="stable")][:k]
        places.append(np.full(len(ok), i))
        names.append(ids[ok])
        values.append(row[ok])
    return np.concatenate(places), np.concatenate(names), np.concatenate(values)


def _side(batch: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(batch.column(f"{prefix}_ids")[i].as_py(), dtype=np.int64)
    return ids, np.frombuffer(batch.column(f"{prefix}_vectors")[i].as_py(), dtype=np.int64).reshape(len(ids), -1)


def _first_floor(k: int):
    """Each query's kth score within one candidate block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, least = [], []
            for i in range(batch.num_rows):
                own, queries = _side(batch, i, "q")
                floor = np.full(len(own), LOWEST)
                if batch.column("c_ids")[i].is_valid:
                    ids, vectors = _side(batch, i, "c")
                    at, _, score = best(ids, vectors, own, queries, k, floor)
                    full = np.bincount(at, minlength=len(own)) >= k
                    lowest = np.full(len(own), np.iinfo(np.int64).max)
                    np.minimum.at(lowest, at, score)
                    floor[full] = lowest[full]
                floors.append(floor.tobytes())
                least.append(int(floor.min()))
            yield pa.record_batch([batch.column("q_block"), pa.array(floors, pa.binary()), pa.array(least, pa.int64())], names=["q_block", "floors", "floor"])

    return run


def reach(q: np.ndarray, r: float, p: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Upper bounds of the products between a ball (q, r) and balls (rows of p, s)."""
    sizes = np.linalg.norm(p, axis=1)
    bound = p @ q + r * sizes + s * np.linalg.norm(q) + r * s
    return bound + 1e-9 * (1 + np.abs(bound) + (np.linalg.norm(q) + r) * (sizes + s))


def _walk(trees: dict[int, Tree], radii: dict[int, np.ndarray]):
    """Centers of the last level that a query block has to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, centers = [], []
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                floor = batch.column("floor")[i].as_py()
                if dim not in trees or dim == 0:
                    found = [0]
                else:
                    tree = trees[dim]
                    q, r = np.array(batch.column("middle")[i].as_py()), batch.column("radius")[i].as_py()
                    alive = np.array([0])
                    for level in range(len(tree.levels)):
                        nodes = alive if level == 0 else np.flatnonzero(np.isin(tree.parents[level], alive))
                        ok = reach(q, r, tree.centers[nodes], radii[dim][level][nodes]) >= floor
                        alive = nodes[ok]
                    found = alive.tolist()
                blocks += [batch.column("q_block")[i].as_py()] * len(found)
                centers += found
            yield pa.record_batch([pa.array(blocks, pa.string()), pa.array(centers, pa.int32())], names=["q_block", "center"])

    return run


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks that can still hold one of the k best."""
    for batch in batches:
        keep = []
        for i in range(batch.num_rows):
            floor = batch.column("floor")[i].as_py()
            q, p = np.array(batch.column("middle")[i].as_py()), np.array(batch.column("c_middle")[i].as_py())
            keep.append(bool(reach(q, batch.column("radius")[i].as_py(), p[None], np.array([batch.column("c_radius")[i].as_py()]))[0] >= floor))
        chosen = pa.array(keep)
        yield pa.record_batch([batch.column("q_block").filter(chosen), batch.column("c_block").filter(chosen)], names=["q_block", "c_block"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, queries = _side(batch, i, "q")
                ids, vectors = _side(batch, i, "c")
                at, names, score = best(ids, vectors, own, queries, k, np.frombuffer(batch.column("floors")[i].as_py(), dtype=np.int64))
                block = pa.array([batch.column("q_block")[i].as_py()] * len(at), pa.string())
                yield pa.record_batch([block, pa.array(np.asarray(at, dtype=np.int32)), pa.array(own[at]), pa.array(names), pa.array(score)],
                                      names=["q_block", "q_row", "query_id", "vec_id", "score"])

    return run


def node_radii(tree: Tree, leaf: np.ndarray) -> list[np.ndarray]:
    """Covering radius of each node of each level, from those of the last level's rows up."""
    out = [leaf]
    for level in range(len(tree.levels) - 1, 0, -1):
        up = tree.parents[level]
        gap = np.linalg.norm(tree.centers[tree.levels[level]] - tree.centers[up], axis=1)
        radius = np.zeros(len(tree.levels[level - 1]))
        np.maximum.at(radius, up, gap + out[0])
        out.insert(0, radius)
    return out


def scaled(vector: Column, factor: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def top_k(vectors: DataFrame, k: int = 20, factor: int = 64, is_query: Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best among all rows of other ids.

    Rows that repeat an id are ranked each by itself when they are queries, and are each a candidate for others.
    """
    is_query = F.pmod(F.col("id"), F.lit(20)) == 0 if is_query is None else is_query
    infinite = F.lit(float("inf"))
    usable = F.forall(F.col("v"), lambda x: F.coalesce((F.abs(x.cast("double")) < infinite) & ~F.isnan(x.cast("double")), F.lit(False)))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & usable)
    rows = cut(rows.select("id", F.size("v").alias("dim"), scaled(F.col("v"), factor).alias("vector")))

    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("dim", "vector").toArrow()
    sizes = sample.column("dim").to_numpy()
    trees = {}
    for dim in np.unique(sizes).tolist():
        if dim:
            at = pa.array(np.flatnonzero(sizes == dim))
            trees[dim] = fit_tree(np.unique(_vectors(sample.column("vector").combine_chunks().take(at)).astype(np.float64), axis=0))

    placed = cut(rows.mapInArrow(_place(trees), "id long, dim int, center int, vector array<bigint>"))
    candidates, queries = _blocks(placed, BLOCK_ROWS), _blocks(placed.filter(is_query), QUERY_BLOCK_ROWS)

    # covering radius of each fitted center over all rows under it: one row per center
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far = [float(np.linalg.norm(np.array(m) - trees[d].centers[c]) + r) if d in trees else 0.0
                   for d, c, m, r in zip(batch["dim"], batch["center"], batch["middle"], batch["radius"], strict=True)]
            yield pd.DataFrame({"dim": batch["dim"], "center": batch["center"], "far": far})

    held = candidates.select("dim", "center", "middle", "radius").mapInPandas(spread, "dim int, center int, far double")
    radii = {dim: np.full(len(tree.centers), -np.inf) for dim, tree in trees.items()}
    for row in held.groupBy("dim", "center").agg(F.max("far").alias("far")).toLocalIterator():
        if row.dim in radii:
            radii[row.dim][row.center] = row.far
    walked = {dim: node_radii(tree, radii[dim]) for dim, tree in trees.items()}

    q = queries.select(F.col("block").alias("q_block"), "dim", "center", "part", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "middle", "radius")
    c = candidates.select(F.col("block").alias("c_block"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
    # one candidate block under the query block's own center
    parts = candidates.groupBy("dim", "center").agg(F.max("part").alias("last"))
    first = q.join(parts, ["dim", "center"], "left").withColumn("c_block", F.concat_ws("/", "dim", "center", F.pmod("part", F.coalesce(F.col("last"), F.lit(0)) + 1)))
    floors = cut(first.join(c, "c_block", "left").mapInArrow(_first_floor(k), "q_block string, floors binary, floor long"))
    summary = q.select("q_block", "dim", "middle", "radius").join(floors.select("q_block", "floor"), "q_block")
    centers = summary.mapInArrow(_walk(trees, walked), "q_block string, center int")
    pairs = (centers.join(summary.select("q_block", "dim", "middle", "radius", "floor"), "q_block")
             .join(candidates.select("dim", "center", F.col("block").alias("c_block"), F.col("middle").alias("c_middle"), F.col("radius").alias("c_radius")), ["dim", "center"])
             .mapInArrow(_prune, "q_block string, c_block string"))
    found = (pairs.join(q.select("q_block", "q_ids", "q_vectors").join(floors.select("q_block", "floors"), "q_block"), "q_block").join(c, "c_block")
             .mapInArrow(_search(k), "q_block string, q_row int, query_id long, vec_id long, score long"))
    order = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
