"""Dual-tree top-k search against all products."""

from __future__ import annotations

import math

import numpy as np

from tillstone.llm import topk_search as ts


def brute(rows, k=20, factor=64):
    ok = [(i, [math.floor(x * factor) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    return sorted(tuple(r) for r in ts.top_k(frame, **options).collect())


def test_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ts, "QUERY_BLOCK_ROWS", 5)
    monkeypatch.setattr(ts, "SAMPLE_ROWS", 100)
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(6, 8))
    rows = [(i, (middles[i % 6] * (1 + i % 3) + rng.normal(scale=0.05, size=8)).astype(np.float32).tolist()) for i in range(700)]
    rows[7] = (7, rows[40][1])  # a tie
    rows[8] = (8, rows[40][1])
    rows += [(1000, None), (1020, [1.0, None, *[0.0] * 6]), (1040, [float("nan"), *[0.0] * 7]), (1060, [float("inf"), *[0.0] * 7]), (None, [1.0] * 8)]
    rows += [(2000 + i, [0.5, -0.25 * i, 3.0]) for i in range(12)]
    rows += [(20, rows[40][1]), rows[20], (33, rows[40][1]), (33, rows[41][1])]  # repeated queries and candidates
    assert run(spark, rows) == brute(rows)


def test_equal_vectors_few_rows_and_empty(spark):
    rows = [(i, [0.5, -1.0]) for i in range(25)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 64 * 128)]
    assert run(spark, [(0, [1.0])]) == []
    frame = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>").limit(0)
    assert ts.top_k(frame).collect() == []


def test_nodes_are_pruned():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(loc=c, scale=0.1, size=(50, 4)) for c in (-20, 0, 20)])
    tree = ts.fit_tree(points, 16)
    near = np.linalg.norm(points[:, None] - tree.centers[None], axis=2)
    leaf = np.array([near[near.argmin(axis=1) == i, i].max(initial=0) for i in range(len(tree.centers))])
    radii = ts.node_radii(tree, leaf)
    for level, nodes in enumerate(tree.levels):
        assert len(radii[level]) == len(nodes)
    assert (np.linalg.norm(points - tree.centers[0], axis=1) <= radii[0][0] + 1e-9).all()
    floor = np.sort(points @ np.full(4, 20.0))[-20]
    assert (ts.reach(np.full(4, 20.0), 0.5, tree.centers, leaf) >= floor).sum() < len(tree.centers)
