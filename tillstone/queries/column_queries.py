"""Column names, column sets and lineage columns over the given tables, and the watch log of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.naming import clean_headers, file_name
from tillstone.operators import profile
from tillstone.operators.schema_evolution import ensure_columns
from tillstone.plans.bronze import BronzeStore
from tillstone.queries.registry import query
from tillstone.session import working_folder
from tillstone.sources import workbooks
from tillstone.sources.nested import with_landing_lineage
from tillstone.sources.tables import read_table
from tillstone.streaming.bronze_stream import stream_bronze

_STAMP = "2025-01-01 00:00:00"


@query("clean_headers", """SELECT o_orderkey AS "Order_Key", o_custkey AS "a_b_0", o_totalprice AS "a_b_1", o_orderstatus AS "plain" FROM orders""")
def cleaned_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces and dots become underscores; all members of a repeated name are numbered."""
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return rows.toDF(*clean_headers([" Order Key", "a.b", "a b", "plain"]))


@query("landing_lineage", f"SELECT *, 'Nations' AS _source_sheet, '{_STAMP}' AS _processed_at FROM customer")
def landing_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_landing_lineage(read_table(spark, sf_dir, "customer"), "Nations", _STAMP)


@query("columns_only_in", """SELECT 'c_custkey' AS column_name, COUNT(*) AS value_rows FROM customer WHERE c_custkey IS NOT NULL
UNION ALL SELECT 'c_mktsegment', COUNT(c_mktsegment) FROM customer UNION ALL SELECT 'c_name', COUNT(c_name) FROM customer
UNION ALL SELECT 'c_nationkey', COUNT(c_nationkey) FROM customer""")
def columns_only_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that customers have and suppliers lack, with the values they hold."""
    customers = read_table(spark, sf_dir, "customer")
    suppliers = read_table(spark, sf_dir, "supplier").withColumnRenamed("s_acctbal", "c_acctbal")
    names = profile.columns_only_in(customers, suppliers)
    counts = customers.agg(*[F.count(name).alias(name) for name in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("value_rows")) for n in names])))


@query("ensure_columns", "SELECT *, CAST(NULL AS VARCHAR) AS source_file_path, CAST(NULL AS INTEGER) AS batch_id FROM supplier")
def ensured_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = T.StructType.fromDDL("source_file_path string, batch_id int")
    return ensure_columns(read_table(spark, sf_dir, "supplier"), lineage)


@query("sheet_row_counts", """SELECT c_nationkey AS nation, COUNT(*) AS data_rows,
  COUNT(CASE WHEN c_acctbal >= 0 THEN 1 END) AS first_column_rows FROM customer GROUP BY c_nationkey""")
def sheet_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cells of one sheet per nation, whose first column is filled for no debtor."""
    rows = read_table(spark, sf_dir, "customer")
    sheet = rows.select(
        F.lit("customers.xlsx").alias("file_path"), F.col("c_nationkey").cast("string").alias("sheet_name"), (F.col("c_custkey") + 1).cast("int").alias("row_number"),
        F.posexplode(F.array(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")), F.col("c_name"))).alias("column_number", "value"),
    ).filter("value is not null").withColumn("error_message", F.lit(None).cast("string"))
    counts = workbooks.landing_counts(sheet)
    return counts.select(F.col("sheet_name").cast("int").alias("nation"), "data_rows", "first_column_rows")


@query("watch_log", """SELECT 'supplier.parquet' AS file_name, 'created' AS event_type, COUNT(*) AS rows, true AS success,
  CAST(NULL AS VARCHAR) AS error_message FROM supplier""")
def watch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = BronzeStore(working_folder(spark, "bronze"), working_folder(spark, "bronze-logs"))
    schema = read_table(spark, sf_dir, "supplier").schema
    stream_bronze(spark, sf_dir, schema, store, working_folder(spark, "stream"), _STAMP, glob="supplier.parquet").awaitTermination()
    log = spark.read.parquet(store.log("file_watcher_logs"))
    return log.select(file_name(F.col("file_path")).alias("file_name"), "event_type", "rows", "success", "error_message")
