"""Shuffles and files that must not grow faster than the input."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillstone.operators import duplicates
from tillstone.plans import landing, summary
from tillstone.sources import workbooks
from tillstone.sources.files import read_with_row_id
from tillstone.sources.tables import bronze_detailed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _invoices(spark):
    names = [*summary.DAILY_KEYS, "customer_code", "invoice_number"]
    day, kinds = date(2024, 1, 1), ["date", "int", "int", "string", "int", "string", "string", "string"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    keys = [(2024, 1, "b", 1, "u"), (2024, 1, "b", None, None)]
    rows = [
        (day, *key, customer, document)
        for key in keys
        for customer, document in (("c1", "d1"), ("c1", "d1"), ("c1", "d2"), ("c2", "d2"), (None, "d3"), ("c3", None), (None, None))
    ]
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns({column: F.lit("1.50").cast("decimal(15,2)") for column in summary.TOTALS.values()})


@pytest.mark.parametrize("daily", [summary.daily_invoices_detailed, summary.daily_invoices_summarized])
def test_daily_invoices_shuffle_once(spark, daily):
    found = daily(_invoices(spark))
    assert _plan(found).count("Exchange hashpartitioning") == 1
    rows = found.orderBy("branch_code").collect()
    documents = 3 if daily is summary.daily_invoices_detailed else 7
    assert [(r.invoice_count, r.unique_customers, str(r.total_sales)) for r in rows] == [(documents, 3, "10.50")] * 2


def test_a_landed_sheet_is_one_file(spark, tmp_path):
    rows = spark.range(400).select(
        F.concat(F.lit("book "), (F.col("id") % 2).cast("string")).alias("book"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("sheet"),
        F.col("id").alias("Key"))
    root = str(tmp_path / "in")
    workbooks.write_workbooks(rows, root, "book", "sheet", ["Key"]).collect()
    store = landing.LandingStore(str(tmp_path / "out"), str(tmp_path / "logs"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landing.run_landing(spark, root, store, "2025-01-01 00:00:00")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(list(Path(store.tables).rglob("*.parquet"))) == 6
    assert spark.read.parquet(store.tables).count() == 400


def test_customers_meet_orders_and_not_lines(spark, tmp_path):
    tables = {
        "lineitem": "1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1L l_linenumber, 1D l_quantity, 2D l_extendedprice, 0D l_discount, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus",
        "orders": "1L o_orderkey, 1L o_custkey, 'O' o_orderstatus, 2D o_totalprice, timestamp_ntz'2024-01-01' o_orderdate",
        "customer": "1L c_custkey, 'c' c_name, 1L c_nationkey, 'm' c_mktsegment",
        "part": "1L p_partkey, 'p' p_name, 't' p_type, 3D p_retailprice", "supplier": "1L s_suppkey, 's' s_name",
    }
    for name, columns in tables.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = bronze_detailed(spark, str(tmp_path))
    assert found.count() == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    at = next(line for line in plan.splitlines() if "Join" in line and "c_custkey" in line)
    assert "l_" not in plan[plan.index(at):].split("Relation")[0] + at


def test_dedup_by_position_shuffles_no_wide_rows(spark, tmp_path):
    key = F.when(F.col("id") % 50_000 != 7, F.col("id") % 50_000)
    rows = spark.range(0, 120_000, 1, 3).select(
        key.alias("k"), (F.col("id") % 3).alias("o"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("wide"), F.col("id"))
    rows.write.parquet(str(tmp_path / "rows"))
    read = read_with_row_id(spark, str(tmp_path / "rows"))
    position = ("_row_file", "_row_index")
    found = duplicates.dedup_by_position(read, ["k"], ["o"], position)
    assert "Exchange hashpartitioning" not in _plan(found)
    expected = duplicates.dedup_keep_first(read, ["k"], ["o", *position])
    assert found.columns == read.columns and found.count() == 50_000
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
