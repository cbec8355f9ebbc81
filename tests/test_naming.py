"""Names of columns, tables and sheets."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.functions import naming

names = st.text(alphabet="aB1 ._-é", max_size=12)


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v"))).first()[0]


def test_headers():
    assert naming.clean_headers(["Unit Price", " a.b ", "x", "x", 7]) == ["Unit_Price", "a_b", "x_0", "x_1", "7"]


@settings(max_examples=50, deadline=None)
@given(st.lists(names, max_size=6))
def test_clean_headers_keep_count_and_forbidden_marks_out(headers):
    cleaned = naming.clean_headers(headers)
    assert len(cleaned) == len(headers)
    assert not any(mark in name for name in cleaned for mark in " .")


@settings(max_examples=50, deadline=None)
@given(names)
def test_standard_name_is_stable(name):
    standard = naming.standard_column_name(name)
    assert standard and "__" not in standard and standard == naming.standard_column_name(standard)


def test_standard_names():
    assert naming.standard_column_name(" Unit-Price. (KES)") == "unit_price_(kes)"
    assert naming.standard_column_name("--") == "unknown_column"


def test_bronze_names(spark):
    relative = lambda c: naming.bronze_table_name(naming.relative_path(c, "/data/output"))
    path = "file:///data/output/Sales/cash_invoices/detailed/2025/jan/a.parquet"
    assert one(spark, path, relative) == "bronze_sales_cash_invoices_detailed"
    assert one(spark, "/data/output/sales/short.parquet", relative) == "bronze_sales_short.parquet"


def test_warehouse_names(spark):
    assert one(spark, "file:///Out.d/Sub/My File-1.parquet", naming.warehouse_table_name) == "out_sub_my_file_1"
    prefixed = lambda c: naming.warehouse_table_name(c, "p", 8)
    assert one(spark, "/a/bcdefghijk.parquet", prefixed) == "p_a_bcde"
    assert one(spark, None, naming.warehouse_table_name) == "unknown_table"


def test_sheet_names(spark):
    assert one(spark, " Jan (1)/2025 é_x-y ", naming.safe_sheet_name) == "Jan_12025_é_x-y"
