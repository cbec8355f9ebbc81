from __future__ import annotations

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillstone.operators.duplicates import flag_duplicates
from tillstone.streaming import stateful

SCHEMA = pa.schema([("k", pa.string()), ("at", pa.timestamp("us")), ("n", pa.int64())])


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.Table.from_pylist([{"k": k, "at": datetime.datetime.fromisoformat(at), "n": n} for k, at, n in rows], schema=SCHEMA), folder / name)


def flags(spark, tmp_path, delay):
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    paths = [str(tmp_path / name) for name in ("out", "state", "checkpoint")]
    stateful.flag_stream(stateful.read_lines(spark, str(tmp_path / "in"), schema), ["k"], ["at", "n"], "at", *paths, delay).awaitTermination()
    return {r.n: r.potential_duplicate_flag for r in spark.read.parquet(paths[0]).collect()}


def test_flags_across_restarts_equal_the_batch_flag(spark, tmp_path):
    first = [("a", "2025-01-01", 2), ("a", "2025-01-01", 1), ("b", "2025-01-01", 3), (None, "2025-01-01", 4)] + [("hot", "2025-01-01", 100 + i) for i in range(300)]
    second = [("a", "2025-01-02", 5), ("c", "2025-01-02", 6), (None, "2025-01-02", 7), ("hot", "2025-01-02", 8)]
    land(tmp_path / "in", "1.parquet", first)
    flags(spark, tmp_path, 10 * 86400)
    land(tmp_path / "in", "2.parquet", second)
    found = flags(spark, tmp_path, 10 * 86400)
    batch = flag_duplicates(spark.read.parquet(str(tmp_path / "in")), ["k"], ["at", "n"])
    assert found == {r.n: r.potential_duplicate_flag for r in batch.collect()}
    # an epoch that is run again gives the same rows and keys
    frame = spark.read.parquet(str(tmp_path / "in" / "2.parquet")).select(
        "*", F.col("_metadata.file_path").alias(stateful.POSITION[0]), F.col("_metadata.row_index").alias(stateful.POSITION[1]))
    stateful._flag(frame, 1, ["k"], ["at", "n"], "at", str(tmp_path / "out"), str(tmp_path / "state"), 10 * 86400)
    assert found == {r.n: r.potential_duplicate_flag for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_keys_expire(spark, tmp_path):
    for number, at in enumerate(("2025-01-01", "2025-01-02", "2025-02-01", "2025-02-02")):
        land(tmp_path / "in", f"{number}.parquet", [("a", at, number), (f"only{number}", at, 10 + number)])
        found = flags(spark, tmp_path, 5 * 86400)
    # the keys of January are forgotten once an event of February was seen
    assert [found[n] for n in range(4)] == [0, 1, 1, 1]
    left = {p.name for p in (tmp_path / "state" / "keys").iterdir() if p.is_dir()}
    assert left == {"epoch=2", "epoch=3"}
    land(tmp_path / "in", "5.parquet", [("only0", "2025-02-03", 20), ("only2", "2025-02-03", 21)])
    found = flags(spark, tmp_path, 5 * 86400)
    assert (found[20], found[21]) == (0, 1)


def test_daily_totals_grow_close_and_fold(spark, tmp_path):
    def run():
        schema = spark.read.parquet(str(tmp_path / "in")).schema
        rows = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        totals = stateful.daily_totals(rows, "at", ["k"], {"total": "n"}, "3 days")
        stateful.upsert_stream(totals, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return held()

    def held():
        return sorted(((str(r.day), r.k, r["rows"], r.total) for r in stateful.read_totals(spark, str(tmp_path / "out"), ["k"]).collect()), key=repr)

    land(tmp_path / "in", "1.parquet", [("a", "2025-01-01 10:00", 1), ("a", "2025-01-01 11:00", 2), (None, "2025-01-02", 4)])
    assert run() == [("2025-01-01", "a", 2, 3), ("2025-01-02", None, 1, 4)]
    land(tmp_path / "in", "2.parquet", [("a", "2025-01-01 12:00", 10), ("a", "2025-01-20", 5)])
    grown = [("2025-01-01", "a", 3, 13), ("2025-01-02", None, 1, 4), ("2025-01-20", "a", 1, 5)]
    assert run() == sorted(grown, key=repr)
    land(tmp_path / "in", "3.parquet", [("a", "2025-01-01 13:00", 100), ("a", "2025-01-20", 1)])  # the first day is closed
    grown[2] = ("2025-01-20", "a", 2, 6)
    assert run() == sorted(grown, key=repr)
    stateful.compact_totals(spark, str(tmp_path / "out"), ["k"])
    assert held() == sorted(grown, key=repr) and len(list((tmp_path / "out").glob("epoch=*"))) == 1
