from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tillstone.llm.centroid_clustering import as_array, build_tree, cluster_vectors, nearest

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, distance string, id int, vector int"


def brute(rows, k=16, rounds=3):
    """Plain rounds over Python integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), number) for number, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, label) in zip(kept, found, strict=True) if label == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    total = sum(d for d, _ in found)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by = {c: sum(d for d, label in found if label == c) for c in range(len(centroids))}
    return sorted(((i, c, d, by[c], total, hashes[c]) for (i, _), (d, c) in zip(kept, found, strict=True)), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", "y", 1, 2) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in cluster_vectors(df, **options).collect()), key=repr)


def vectors(seed, n, grain):
    """Vectors of few different values, so that distances tie."""
    rng = random.Random(seed)
    groups = [[rng.randrange(-8, 8) / grain for _ in range(64)] for _ in range(6)]
    return [(i, [x + rng.choice([0, 0, 0, 1 / 64, -1 / 64]) for x in rng.choice(groups)]) for i in range(n)]


def test_equals_plain_rounds(spark):
    rows = vectors(3, 300, 8)
    rows += [(rows[5][0], rows[5][1]), (7, rows[9][1]), (None, rows[1][1]), (None, None), (900, None), (901, rows[2][1][:63]),
             (902, rows[2][1] + [0.0]), (903, [float("nan")] + rows[0][1][1:]), (904, [float("inf")] + rows[0][1][1:]), (905, [None] + rows[0][1][1:]), (906, [])]
    assert run(spark, rows) == brute(rows)


def test_all_equal_and_few(spark):
    same = [(i, [0.5] * 64) for i in range(40)]
    assert run(spark, same) == brute(same)
    assert run(spark, same[:5]) == brute(same[:5])
    assert run(spark, vectors(1, 3, 4), rounds=1, k=2) == brute(vectors(1, 3, 4), k=2, rounds=1)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


def test_large_components(spark):
    big = 2.0 ** 23
    rows = [(i, [big * (i % 5)] + [1.0 * i] * 63) for i in range(30)]
    assert run(spark, rows) == brute(rows)


def test_beyond_a_long(spark):
    rows = [(1, [1e30] + [0.0] * 63), (2, [0.0] * 64), (3, [1.0] * 64)]
    found = run(spark, rows, k=1, rounds=0)
    assert len(found) == 3 and any(r[2] is None for r in found) and all(r[4] is None for r in found)


@pytest.mark.parametrize("grain", [1, 3, 50])
def test_tree_meets_the_nearest(grain):
    rng = np.random.default_rng(grain)
    points = as_array(rng.integers(-grain, grain + 1, (500, 64)))
    centroids = as_array(np.vstack([points[:12], points[:4]]))
    label, best = nearest(points, centroids, build_tree(centroids))
    every = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
