"""Whole rows must be neither shuffled, sorted nor kept where keys and positions do."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tillstone.operators import duplicates
from tillstone.plans import bronze, incremental
from tillstone.sources import sinks
from tillstone.sources.files import read_with_row_id
from tillstone.sources.tables import bronze_detailed
from tillstone.streaming import bronze_stream

POSITION = ("_row_file", "_row_index")
DATA = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flag_by_position_shuffles_no_wide_rows(spark, tmp_path):
    key = F.when(F.col("id") % 50_000 != 7, F.col("id") % 50_000)
    rows = spark.range(0, 120_000, 1, 3).select(
        key.alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("o"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("wide"), F.col("id"))
    rows.union(rows.filter("id < 100")).write.parquet(str(tmp_path / "rows"))
    read = read_with_row_id(spark, str(tmp_path / "rows"))
    found = duplicates.flag_by_position(read, ["k"], ["o"], POSITION, "f")
    assert "Exchange hashpartitioning" not in _plan(found)
    assert found.columns == [*read.columns, "f"] and found.count() == 120_100
    expected = duplicates.flag_duplicates(read, ["k"], ["o"], POSITION, "f")
    counted = [df.groupBy("k", "o", "f").count() for df in (found, expected)]
    assert counted[0].exceptAll(counted[1]).isEmpty() and counted[1].exceptAll(counted[0]).isEmpty()
    assert found.filter("f = 0").count() == 50_000


def test_older_loads_need_no_join_of_the_log(spark):
    log = spark.createDataFrame(
        [("a", 1, "SUCCESS", 1), ("a", 3, "SUCCESS", 2), ("a", 3, "SUCCESS", 2), ("a", 4, "FAILED", 3), ("b", 2, "SUCCESS", 1), (None, 1, "SUCCESS", 1)],
        "file_path string, operation_id int, status string, processed_at int")
    rows = spark.createDataFrame(
        [("a", 1), ("a", 3), ("a", 4), ("b", 2), ("c", 1), (None, 1), ("a", None)], "source_file_path string, batch_id int")
    found = bronze.current_rows(rows, log)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert {tuple(r) for r in found.collect()} == {("a", 3), ("a", 4), ("b", 2), ("c", 1), (None, 1), ("a", None)}


def test_a_stream_keeps_no_copy_of_its_rows(spark, tmp_path, monkeypatch):
    root, kept = str(tmp_path / "in"), []
    spark.range(10).select(F.col("id").alias("Key"), F.lit("w").alias("wide")).write.parquet(f"{root}/sales/orders/all/1")
    persist = DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: (kept.append(df.columns), persist(df, *level))[1])
    store = bronze.BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs"))
    bronze_stream.stream_bronze(
        spark, root, spark.read.parquet(f"{root}/sales/orders/all/1").schema, store, str(tmp_path / "check"), "2025-01-01 00:00:00").awaitTermination()
    assert spark.read.parquet(store.table("bronze_sales_orders_all")).count() == 10
    assert bronze.read_file_log(spark, store).agg(F.sum("records_count")).first()[0] == 10
    assert not any("wide" in columns for columns in kept)


def test_a_fresh_table_is_not_staged(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "t"), []
    write = incremental.write_tree
    monkeypatch.setattr(incremental, "write_tree", lambda df, target, **options: (staged.append(target), write(df, target, **options)))
    rows = spark.range(90).select("id", F.format_string("2024-%02d", F.col("id") % 9 + 1).alias("period"))
    periods = [f"2024-{month:02d}" for month in range(1, 10)]
    incremental.replace_periods(spark, path, rows, str(tmp_path / "s1"), periods, fresh=True)
    assert not staged
    kept = spark.read.schema(rows.schema).parquet(path).filter("id >= 9 and period <> '2024-05'")
    incremental.replace_periods(spark, path, kept, str(tmp_path / "s2"), periods)
    assert staged and sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == [n for n in range(9, 90) if n % 9 != 4]


def test_partitioned_writes_sort_nothing(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), sinks.unsorted_partitions(spark):
        assert spark.conf.get(name) == str(sinks.OPEN_FILES)
        1 / 0
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("module, name", [("file_queries", "daily_summary_incremental"), ("stream_queries", "stream_duplicate_flag")])
def test_deliveries_come_out_of_one_pass(spark, monkeypatch, module, name):
    query, passes, seen = entry_points.queries()[name], [], []
    writer = sinks.write_tree

    def counted(df, path, *args, **kwargs):
        passes.append(any("lineitem.parquet" in f for f in df.inputFiles()))
        return writer(df, path, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_tree", counted)
    monkeypatch.setattr(f"tillstone.queries.{module}.bronze_detailed", lambda *args: (seen.append(1), bronze_detailed(*args))[1])
    query(spark, DATA)
    assert len(seen) == 1 and sum(passes) <= 1
