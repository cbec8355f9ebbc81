from __future__ import annotations

import datetime
import itertools

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillstone.operators import calendar, temporal
from tillstone.plans import bronze
from tillstone.plans.bronze import BronzeStore
from tillstone.plans.dimensions import Dimension
from tillstone.sources.versions import VersionedTable
from tillstone.streaming.bronze_stream import stream_bronze

JAN, FEB, MAR = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00"
EXPORTS = {
    JAN: [("a", "x", 1), ("b", "x", None), ("c", None, 3)],
    FEB: [("a", "y", 1), ("c", None, 3), ("d", "", 4), ("d", "z", 4), (None, "n", 1)],
    MAR: [("a", "x", 1), ("b", "x", None), ("c", None, 3), ("d", "", 4)],
}


def day(text):
    return datetime.datetime.fromisoformat(text)


def history_of(spark, path, order):
    dimension = Dimension(spark, str(path), ["code"], ["name", "class"])
    for at in order:
        dimension.merge(spark.createDataFrame(EXPORTS[at], "code string, name string, class int"), at)
    return sorted((tuple(r) for r in dimension.history().select("code", "name", "class", "valid_from", "valid_to", "is_current").collect()), key=repr)


def test_history_does_not_depend_on_the_order_of_exports(spark, tmp_path):
    expected = sorted([
        ("a", "x", 1, day(JAN), day(FEB), False), ("a", "y", 1, day(FEB), day(MAR), False), ("a", "x", 1, day(MAR), None, True),
        ("b", "x", None, day(JAN), day(FEB), False), ("b", "x", None, day(MAR), None, True), ("c", None, 3, day(JAN), None, True),
        ("d", "", 4, day(FEB), None, True),
    ], key=repr)
    for number, order in enumerate(itertools.permutations(EXPORTS)):
        if number in (0, 3, 5):
            assert history_of(spark, tmp_path / str(number), order) == expected
    assert history_of(spark, tmp_path / "again", [JAN, MAR, FEB, FEB, JAN, MAR]) == expected


def test_a_version_is_seen_when_it_is_whole(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.write(spark.range(3), 1, JAN)
    table.write(spark.range(5), 2, FEB)
    spark.range(9).write.parquet(f"{tmp_path}/t/rows/3")  # a job died before it logged its version
    assert table.read().count() == 5 and table.read(1).count() == 3
    table.write(spark.range(9), 3, MAR)
    assert table.read().count() == 9


@pytest.mark.parametrize("facts_per_part", [1_000_000, 2])
def test_as_of_join(spark, facts_per_part):
    dimension = spark.createDataFrame(
        [("a", day(JAN), day(FEB), "x", 1), ("a", day(MAR), None, None, 2), ("b", day(FEB), None, "y", None), (None, day(JAN), None, "n", 0)],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string, class int")
    times = ["2024-12-31", "2025-01-01", "2025-01-31", "2025-02-01", "2025-02-15", "2025-03-01", "2025-06-01", None]
    rows = [(i, k, None if t is None else datetime.date.fromisoformat(t)) for i, (k, t) in enumerate(itertools.product(["a", "b", "c", None], times))]
    rows += rows[:3]
    facts = spark.createDataFrame(rows, "id int, k string, at date")
    joined = temporal.as_of_join(facts, dimension, ["k"], "at", ["name", "class"], facts_per_part=facts_per_part)
    held = facts.alias("f").join(dimension.alias("d"), (F.col("f.k") == F.col("d.k")) & (F.col("at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))), "left").select("f.*", "name", "class")
    assert sorted(joined.collect(), key=repr) == sorted(held.collect(), key=repr)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = temporal.as_of_join(facts.limit(0), dimension, ["k"], "at", ["name"])
    assert none.count() == 0 and temporal.as_of_join(facts, dimension.limit(0), ["k"], "at", ["name"]).count() == len(rows)


def test_missing_and_stale_days(spark):
    dates = ["2025-01-03", "2025-01-03", "2025-01-06", "2025-01-10", None]  # a Friday, a Monday, a Friday
    rows = spark.createDataFrame([(1, d) for d in dates] + [(None, "2025-01-01"), (2, "2025-01-10")], "b int, d string")
    every = sorted((r.b, str(r.missing_from), str(r.missing_to), r.open_days) for r in calendar.missing_days(rows, "b", "d").collect())
    assert every == [(1, "2025-01-04", "2025-01-05", 2), (1, "2025-01-07", "2025-01-09", 3)]
    week = calendar.missing_days(rows, "b", "d", range(calendar.MONDAY, calendar.SATURDAY), until="2025-01-14")
    found = sorted((r.b, str(r.missing_from), str(r.missing_to), r.open_days) for r in week.collect())
    assert found == [(1, "2025-01-07", "2025-01-09", 3), (1, "2025-01-13", "2025-01-14", 2), (2, "2025-01-13", "2025-01-14", 2)]
    stale = calendar.stale_branches(rows.withColumn("b", F.coalesce("b", F.lit(3))), "b", "d", "2025-01-12", 3)
    assert [(r.b, r.age_days) for r in stale.collect()] == [(3, 11)]


def test_streams_keep_to_their_ranges(spark, tmp_path):
    """The first of two streams is started again; no rows and no log entries of the other go."""
    folder = tmp_path / "landing" / "sales" / "cash_invoices" / "detailed"
    store = BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    for part, (year, values) in enumerate((("2024", [1]), ("2025", [10, 20, 30]), ("2024", [2, 3]))):
        (folder / year).mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"DOCUMENT_NUMBER": values}), folder / year / f"{part}.parquet")
        schema = spark.read.parquet(str(folder / year / f"{part}.parquet")).schema
        stream_bronze(spark, str(tmp_path / "landing"), schema, store, str(tmp_path / f"stream-{year}"), "2025-02-01 00:00:00",
                      folder=f"sales/cash_invoices/detailed/{year}").awaitTermination()
    rows = spark.read.parquet(store.table("bronze_sales_cash_invoices_detailed"))
    assert sorted(r.DOCUMENT_NUMBER for r in rows.collect()) == [1, 2, 3, 10, 20, 30]
    log = bronze.read_file_log(spark, store).collect()
    assert sorted((r.operation_id, r.records_count, r.file_size > 0, r.last_modified is not None) for r in log) == [
        (1_000_000_000, 1, True, True), (1_000_000_001, 2, True, True), (1_001_000_000, 3, True, True)]
    assert bronze.load_bronze(spark, str(tmp_path / "landing"), store, 1, "2025-02-02 00:00:00").count() == 0
    with pytest.raises(ValueError):
        bronze.stream_batch(1_000_000_000, bronze.STREAM_RANGE)
