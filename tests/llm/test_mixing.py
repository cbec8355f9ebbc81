"""Mixing: rates, inversion against a plain Poisson, weights, edge cases."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from tillstone.llm import mixing


def plain(rate, seed, key):
    u = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16) / 16 ** 13
    n, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        n += 1
        p = p * rate / n
        total += p
    return n


def test_copies_follow_the_inverted_distribution(spark):
    rows = [(i, "x" * (50 + i % 7), "big" if i % 3 else ("small" if i % 2 else None)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    rates = {r.mix_source: r.rate for r in mixing.source_rates(docs).collect()}
    mixed = mixing.mix_sources(docs)
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == Counter({i: n for i, _, s in rows if (n := plain(rates[s], mixing.SEED, i))})
    share = {r.source: r.s for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("s")).collect()}
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text)
    weight = {s: math.sqrt(n) for s, n in sizes.items()}
    for s in sizes:
        assert abs(share[s] / sum(share.values()) - weight[s] / sum(weight.values())) < 0.03


def test_given_weights_and_large_rates(spark):
    rows = [(i, "abc", "a") for i in range(2000)] + [(i, "abc", "b") for i in range(2000, 2010)] + [(9999, "abc", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(r.source for r in mixing.mix_sources(docs, {"a": 0.5, "b": 0.5}).collect())
    assert set(got) == {"a", "b"}
    assert abs(got["a"] - 1005) < 120 and abs(got["b"] - 1005) < 120


def plain_large(rate, key):
    u = int(hashlib.md5(f"{mixing.SEED}:{key}".encode()).hexdigest()[:13], 16) / 16 ** 13
    n, total = 0, math.exp(-rate)
    while total <= u:
        n += 1
        total += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
    return n


def test_rates_above_a_thousand(spark):
    # where the first step is not 0 any more, where exp(-rate) is 0, and above
    for rate in (150, 190, 800, 3000):
        rows = [(i, "x", None) for i in range(20)] + [(1000 + i, "y" * (2 * rate - 1), "big") for i in range(20)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        weights = {None: 0.5, "big": 0.5}
        real = {r.mix_source: r.rate for r in mixing.source_rates(docs, weights).collect()}[None]
        assert abs(real - rate) < 1e-9
        got = Counter(r.doc_id for r in mixing.mix_sources(docs, weights).filter("source is null").collect())
        assert got == {i: plain_large(real, i) for i in range(20)} and len(set(got.values())) > 10


def test_nulls_repeats_clashes_and_empty(spark):
    rows = [(None, None, None, 7), (None, None, None, 7), (1, "", "s", 7), (1, "", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    found = mixing.mix_sources(docs, {"s": 1.0, None: 1.0})
    assert found.columns == ["doc_id", "text", "source", "copy", "mix_key"]
    by = Counter((r.doc_id, r.copy) for r in found.collect())
    assert all(n == 2 for n in by.values())
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_same_mix_for_any_partitioning(spark):
    docs = spark.createDataFrame([(i, "t" * i, f"s{i % 4}") for i in range(200)], "doc_id long, text string, source string")
    one, two = (sorted(tuple(r) for r in mixing.mix_sources(d).collect()) for d in (docs.repartition(1), docs.repartition(7)))
    assert one == two
