"""Duplicate operators against a plain reading of what they mean."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from tillstone.operators import duplicates as d


def rows(seed, hot):
    rng = random.Random(seed)
    data = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.randint(0, 2), rng.randint(0, 3), str(rng.randint(0, 4)))
            for _ in range(200)]
    return data + [("hot", 1, 1, "same")] * hot + [("hot", 1, i, "other") for i in range(hot)]


def frame(spark, data):
    return spark.createDataFrame(data, "k string, n int, t int, v string").repartition(3)


def test_flags_mark_all_but_the_first(spark):
    data = rows(1, 100)
    got = d.flag_duplicates(frame(spark, data), ["k", "n"], ["t"], flag="f").collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(data)
    groups = defaultdict(list)
    for r in got:
        groups[(r.k, r.n)].append((r.t, r.f))
    for members in groups.values():
        assert sorted(f for _, f in members) == [0] + [1] * (len(members) - 1)
        first = next(t for t, f in members if f == 0)
        assert first == min(t for t, _ in members)


def test_row_id_gives_the_same_flags(spark):
    data = [(*row, i) for i, row in enumerate(rows(2, 50))]
    df = spark.createDataFrame(data, "k string, n int, t int, v string, id int")
    got = d.flag_duplicates(df, ["k", "n"], ["t"], row_id=["id"], flag="f").collect()
    assert len(got) == len(data)
    assert sum(1 - r.f for r in got) == len({(r[0], r[1]) for r in data})


def test_null_order_comes_last(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 5, "y")], "k string, t int, v string")
    got = {r.v: r.f for r in d.flag_duplicates(df, ["k"], ["t"], flag="f").collect()}
    assert got == {"x": 1, "y": 0}
    assert [r.v for r in d.dedup_keep_first(df, ["k"], ["t"]).collect()] == ["y"]


def test_identity_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(*d.row_identity(["x", "y"])).distinct().count() == 2


def test_keep_first_is_idempotent_and_fixed(spark):
    data = rows(3, 40)
    once = d.dedup_keep_first(frame(spark, data), ["k", "n"], ["t"])
    survivors = sorted(once.collect(), key=str)
    assert survivors == sorted(d.dedup_keep_first(once, ["k", "n"], ["t"]).collect(), key=str)
    assert survivors == sorted(d.dedup_keep_first(frame(spark, data[::-1]), ["k", "n"], ["t"]).collect(), key=str)


def test_keep_first_drops_rows_before_the_shuffle(spark):
    plan = d.dedup_keep_first(frame(spark, rows(4, 5)), ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_counts(spark):
    data = rows(5, 30)
    keys = Counter((r[0], r[1]) for r in data)
    df = frame(spark, data)
    assert d.duplicate_groups(df, ["k", "n"]).first()[0] == sum(1 for n in keys.values() if n > 1)
    assert d.duplicate_rows(df, ["k", "n"]).first()[0] == len(data) - len(keys)
    counts = d.distinct_row_counts(df).first()
    assert (counts.rows_before, counts.rows_after) == (len(data), len(set(data)))
    assert d.distinct_rows(df).count() == len(set(data))
