"""Runs through files keep little on disk: shuffles and landed files go, whole rows are neither staged nor shuffled."""

from __future__ import annotations

import time
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tillstone.plans import bronze, incremental, medallion
from tillstone.queries import load_all
from tillstone.sources import sinks, tables
from tillstone.sources.sinks import write_tree

load_all()
from tillstone.queries import file_queries  # noqa: E402  it needs the others' checks

ROWS = {
    "lineitem": "id l_orderkey, id % 3 l_partkey, 1L l_suppkey, 1L l_linenumber, 1D l_quantity, 2D l_extendedprice, 0D l_discount, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus",
    "orders": "id o_orderkey, 1L o_custkey, 'O' o_orderstatus, 2D o_totalprice, timestamp_ntz'1996-01-01' + make_interval(cast(id % 4 as int)) o_orderdate",
    "customer": "1L c_custkey, 'c' c_name, 1L c_nationkey, 'm' c_mktsegment",
    "part": "id p_partkey, 'p' p_name, 't' p_type, 3D p_retailprice", "supplier": "1L s_suppkey, 's' s_name",
}
COUNTS = {"lineitem": 40, "orders": 40, "customer": 1, "part": 3, "supplier": 1}


@pytest.fixture
def data(spark, tmp_path):
    for name, columns in ROWS.items():
        spark.range(COUNTS[name]).selectExpr(*columns.split(", ")).write.parquet(str(tmp_path / "data" / f"{name}.parquet"))
    return str(tmp_path / "data")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    bronze.write_batch(spark.range(1000).repartition(3, "id").withColumn("batch_id", F.lit(1)), str(tmp_path / "b"))
    write_tree(spark.range(1000).groupBy(F.col("id") % 7).count(), str(tmp_path / "t"))
    for _ in range(40):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.25)
    assert not _shuffle_files(spark) - before
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_incremental_rows_are_neither_staged_nor_shuffled(spark, tmp_path, monkeypatch):
    folder, plans, staged = tmp_path / "landing" / "sales" / "cash_invoices" / "detailed", [], []
    folder.mkdir(parents=True)
    line = {"DOCUMENT_NUMBER": "INV1", "ITEM_CODE": "P1", "TRN_DATE": "2025-01-05", "AMOUNT": 2.0, "CUS_CODE": "C1", "BCODE": "1"}
    for name, rows in (("a", [line, line]), ("b", [line | {"TRN_DATE": "2025-02-05"}, line | {"AMOUNT": -1.0}])):
        pq.write_table(pa.Table.from_pylist(rows), folder / f"{name}.parquet")
    store, target = bronze.BronzeStore(str(tmp_path / "bronze"), str(tmp_path / "logs")), medallion.SilverStore(str(tmp_path / "silver"), str(tmp_path / "silver_logs"))
    write, tree = incremental._write_periods, incremental.write_tree
    monkeypatch.setattr(incremental, "_write_periods", lambda rows, path: (plans.append((path, _plan(rows))), write(rows, path))[1])
    monkeypatch.setattr(incremental, "write_tree", lambda df, path, **options: (staged.append(df.columns), tree(df, path, **options))[1])
    for batch in (1, 2):
        bronze.load_bronze(spark, str(tmp_path / "landing"), store, batch, f"2025-05-0{batch} 00:00:00")
        incremental.run_incremental(spark, store, target, batch, batch, f"2025-05-0{batch} 01:00:00")
        pq.write_table(pa.Table.from_pylist([line, line | {"ITEM_CODE": "P2"}]), folder / "a.parquet")
    # the paths of the files may be shuffled, rows are not
    assert all("hashpartitioning(period" not in plan for path, plan in plans if "daily" not in path) and len(plans) > 4
    assert staged and all(columns == ["period"] for columns in staged)
    lines = spark.read.parquet(target.table("detailed_invoices")).select("product_code", "period", "potential_duplicate_flag").collect()
    assert sorted((r[0], str(r[1]), r[2]) for r in lines) == [("P1", "2025-01", 0), ("P1", "2025-02", 0), ("P2", "2025-01", 0)]


def test_states_are_shuffled_once_and_sets_merged(spark):
    schema = ("transaction_date date, transaction_year int, transaction_month int, branch_name string, branch_code int, cashier_username string, data_source string, "
              "lines bigint, total_sales decimal(25,2), total_sales_inclusive decimal(25,2), total_sales_exclusive decimal(25,2), total_vat decimal(25,2), "
              "total_discount decimal(25,2), customers array<string>, documents array<string>")
    rows = spark.sql("""SELECT * FROM VALUES ('a', 2L, 3.0, array('x', 'y'), array('1')), ('a', 1L, 1.5, array('y'), array('1', '2')),
        ('b', 4L, 2.0, array('x', 'z'), array('1', '2', '3')), (NULL, 1L, CAST(NULL AS DOUBLE), array(), array('9')) AS t(who, n, s, c, d)""").selectExpr(
        "date'2025-01-01' transaction_date", "2025 transaction_year", "1 transaction_month", "'b' branch_name", "CAST(NULL AS INT) branch_code",
        "who cashier_username", "'DETAILED' data_source", "n lines", *[f"CAST(s AS DECIMAL(25,2)) {n}" for n in incremental.summary.TOTALS], "c customers", "d documents")
    state = spark.createDataFrame(rows.collect(), schema)
    merged = incremental.merged_invoices(state)
    assert _plan(merged).count("Exchange") == 1
    found = {r.cashier_username: (r.invoice_count, r.unique_customers, r.total_sales) for r in merged.collect()}
    assert {k: (a, b, None if c is None else float(c)) for k, (a, b, c) in found.items()} == {"a": (2, 2, 4.5), "b": (3, 2, 2.0), None: (1, 0, None)}


def test_exports_are_dealt_before_columns_are_made(spark, data, tmp_path):
    rows = tables.bronze_detailed(spark, data, True)
    plan = _plan(rows)
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(substring(date_format(")
    assert rows.exceptAll(tables.bronze_detailed(spark, data)).isEmpty()
    sums = tables.bronze_summarized(spark, data, True)
    assert sums.exceptAll(tables.bronze_summarized(spark, data)).isEmpty() and sums.count() == tables.bronze_summarized(spark, data).count()
    exports = rows.select("DOCUMENT_NUMBER", F.lit(1).alias("export"), tables.export_year(F.col("_processed_at")).alias("year"))
    file_queries._stage_exports(exports, str(tmp_path / "staged"))
    years = [p.parent.name for p in (tmp_path / "staged").rglob("*.parquet")]
    assert sorted(years) == ["year=1996", "year=1997", "year=1998", "year=1999"]


@pytest.mark.parametrize("name", ["medallion_daily_summary", "medallion_after_change", "medallion_from_stream", "duplicates_removed_log", "bronze_deduplicated"])
def test_landed_files_go_when_they_are_loaded(spark, data, monkeypatch, name):
    landed, run = [], {}
    folder = file_queries.working_folder
    monkeypatch.setattr(file_queries, "working_folder", lambda s, purpose: (landed.append(p := folder(s, purpose)), p)[1])
    for step in ("run_silver", "clean_grain", "write_deduplicated"):
        def stand_in(*args, _step=getattr(medallion, step), **kwargs):
            held = [p for p in landed if Path(p).name.startswith(("landing", "export")) and list(Path(p).rglob("*.parquet"))]
            run.setdefault("held", []).extend(held)
            return _step(*args, **kwargs)
        monkeypatch.setattr(medallion, step, stand_in)
    entry_points.queries()[name](spark, data).count()
    assert run["held"] == [] and any(Path(p).name.startswith("landing") for p in landed)


def test_detailed_invoices_shuffle_no_lines_for_their_flag(spark, data):
    found = entry_points.queries()["silver_detailed_invoices"](spark, data)
    assert "hashpartitioning(__identity" not in _plan(found)
    flags = [r[0] for r in found.select("potential_duplicate_flag").collect()]
    # of the 40 lines, orders 0 and 31 have no amount; 13, 26 and 39 come twice
    assert len(flags) == 38 + 3 and sum(flags) == 3


def test_settings_come_back_after_a_failure(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), sinks.tidy(spark):
        assert spark.conf.get(name) == "8000"
        1 / 0
    assert spark.conf.get(name) == before
