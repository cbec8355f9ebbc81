"""Dimensions with history, temporal joins, completeness, drift, and files: pruning, workbooks, orphans, errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.naming import file_name
from tillstone.operators import calendar, drift, temporal
from tillstone.plans import bronze, landing, silver
from tillstone.plans.dimensions import Dimension
from tillstone.queries import silver_sql as sql
from tillstone.queries.registry import query
from tillstone.session import working_folder
from tillstone.sources import files, footers, workbooks
from tillstone.sources.tables import bronze_summarized, read_table

RUN = silver.Run(process_id=sql.PROCESS_ID, load_timestamp=sql.STAMP)
_FIRST, _SECOND, _THIRD = "1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"
_KEYS, _ATTRIBUTES = ["customer_code"], ["customer_name", "segment"]


def _export(spark: SparkSession, sf_dir: str, at: str) -> DataFrame:
    """The customer table as it was exported: customers come, go, come back, and change their segment."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    there = {_FIRST: key % 10 != 9, _SECOND: key % 13 != 0, _THIRD: F.lit(True)}[at]
    moved = {_FIRST: F.lit(False), _SECOND: key % 7 == 0, _THIRD: (key % 7 == 0) & (key % 2 == 1)}[at]
    return read_table(spark, sf_dir, "customer").filter(there).select(
        key.cast("string").alias("customer_code"), F.col("c_name").alias("customer_name"),
        F.when(moved, F.lit("MOVED")).otherwise(segment).alias("segment"))


def _merged(spark: SparkSession, sf_dir: str) -> Dimension:
    """The second export comes late, and then once more."""
    dimension = Dimension(spark, working_folder(spark, "customers"), _KEYS, _ATTRIBUTES)
    for at in (_FIRST, _THIRD, _SECOND, _SECOND):
        dimension.merge(_export(spark, sf_dir, at), at)
    return dimension


HISTORY = f"""exports AS (
SELECT TIMESTAMP '{_FIRST}' AS exported, c_custkey::VARCHAR AS customer_code, c_name AS customer_name, c_mktsegment AS segment
FROM customer WHERE c_custkey % 10 <> 9
UNION ALL SELECT TIMESTAMP '{_SECOND}', c_custkey::VARCHAR, c_name, if(c_custkey % 7 = 0, 'MOVED', c_mktsegment) FROM customer WHERE c_custkey % 13 <> 0
UNION ALL SELECT TIMESTAMP '{_THIRD}', c_custkey::VARCHAR, c_name, if(c_custkey % 7 = 0 AND c_custkey % 2 = 1, 'MOVED', c_mktsegment) FROM customer),
times AS (SELECT exported, lead(exported) OVER (ORDER BY exported) AS until FROM (SELECT DISTINCT exported FROM exports)),
marked AS (SELECT *, if(lag(segment) OVER w = segment AND lag(until) OVER w = exported, 0, 1) AS begins FROM exports JOIN times USING (exported)
  WINDOW w AS (PARTITION BY customer_code ORDER BY exported)),
islands AS (SELECT *, sum(begins) OVER (PARTITION BY customer_code ORDER BY exported) AS island FROM marked),
history AS (SELECT customer_code, any_value(customer_name) AS customer_name, any_value(segment) AS segment, min(exported) AS valid_from,
  if(count(until) = count(*), max(until), NULL) AS valid_to, count(until) < count(*) AS is_current FROM islands GROUP BY customer_code, island)"""


@query("scd2_customers", f"WITH {HISTORY} SELECT * FROM history")
def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).history().drop("version_key")


@query("enriched_invoices_as_of", sql.with_tables(*sql.FROM_SUMMARIZED, HISTORY) + """
SELECT i.invoice_number, i.customer_code, i.transaction_date, i.amount, i.bronze_load_timestamp, h.customer_name AS customer_name_then, h.segment AS segment_then
FROM summarized_invoices i LEFT JOIN history h ON h.customer_code = i.customer_code AND i.transaction_date >= h.valid_from
  AND (h.valid_to IS NULL OR i.transaction_date < h.valid_to)""")
def enriched_invoices_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = silver.summarized_invoices(bronze_summarized(spark, sf_dir), RUN).select(
        "invoice_number", "customer_code", "transaction_date", "amount", "bronze_load_timestamp")
    history = _merged(spark, sf_dir).history().withColumnsRenamed({name: f"{name}_then" for name in _ATTRIBUTES})
    return temporal.as_of_join(invoices, history, _KEYS, "transaction_date", [f"{name}_then" for name in _ATTRIBUTES])


_SOLD = sql.with_tables(*sql.FROM_SUMMARIZED)
_DATED = "transaction_date <> DATE '1900-01-01'"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices whose date could be read."""
    invoices = silver.summarized_invoices(bronze_summarized(spark, sf_dir), RUN)
    return invoices.filter(F.col("transaction_date") != F.lit("1900-01-01").cast("date"))


@query("missing_days", _SOLD.rstrip() + f""",
seen AS (SELECT DISTINCT branch_code, transaction_date AS day FROM summarized_invoices WHERE branch_code IS NOT NULL AND {_DATED}),
days AS (SELECT branch_code, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM seen GROUP BY branch_code),
numbered AS (SELECT *, row_number() OVER (PARTITION BY branch_code ORDER BY day) AS n FROM days WHERE isodow(day) <> 7),
gaps AS (SELECT branch_code, day, n - row_number() OVER (PARTITION BY branch_code ORDER BY day) AS run FROM numbered ANTI JOIN seen USING (branch_code, day))
SELECT branch_code, min(day) AS missing_from, max(day) AS missing_to, count(*) AS open_days FROM gaps GROUP BY branch_code, run""")
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches are closed on Sundays."""
    return calendar.missing_days(_dated(spark, sf_dir), "branch_code", "transaction_date", range(calendar.MONDAY, calendar.SUNDAY))


@query("stale_branches", _SOLD + f"""SELECT branch_code, max(transaction_date) AS last_day, date_diff('day', max(transaction_date), DATE '2001-08-01')::INTEGER AS age_days
FROM summarized_invoices WHERE {_DATED} AND branch_code IS NOT NULL GROUP BY branch_code HAVING age_days > 7""")
def stale_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.stale_branches(_dated(spark, sf_dir), "branch_code", "transaction_date", "2001-08-01", 7)


@query("batch_drift", """WITH cells AS (
  UNPIVOT (SELECT l_orderkey % 6 AS batch, if(l_orderkey % 6 = 4, l_extendedprice * 1.5, l_extendedprice)::DOUBLE AS l_extendedprice,
    l_quantity::DOUBLE AS l_quantity, l_discount::DOUBLE AS l_discount FROM lineitem)
  ON l_extendedprice, l_quantity, l_discount INTO NAME column_name VALUE v),
batches AS (SELECT DISTINCT batch, column_name FROM cells WHERE batch > 0),
points AS (SELECT batch, column_name, unnest(found) AS v FROM (SELECT b.batch, b.column_name, quantile_disc(v, [i / 20.0 for i in range(1, 20)]) AS found
  FROM batches b JOIN cells c ON c.column_name = b.column_name AND c.batch < b.batch GROUP BY ALL)),
shares AS (SELECT p.batch, p.column_name, p.v,
    count(*) FILTER (c.batch < p.batch AND c.v <= p.v) / count(*) FILTER (c.batch < p.batch)
    - count(*) FILTER (c.batch = p.batch AND c.v <= p.v) / count(*) FILTER (c.batch = p.batch) AS apart
  FROM (SELECT DISTINCT * FROM points) p JOIN cells c ON c.column_name = p.column_name AND c.batch <= p.batch GROUP BY ALL)
SELECT batch, column_name, max(abs(apart)) > 0.1 AS drifted FROM shares GROUP BY ALL""")
def batch_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of one batch are half as high again."""
    batch = F.col("l_orderkey") % 6
    lines = read_table(spark, sf_dir, "lineitem").withColumn("batch", batch).withColumn(
        "l_extendedprice", F.when(batch == 4, F.col("l_extendedprice") * 1.5).otherwise(F.col("l_extendedprice")))
    sketches = drift.batch_sketches(lines, "batch", ["l_extendedprice", "l_quantity", "l_discount"])
    return drift.batch_drift(sketches).drop("drift")


@query("prune_by_date", """SELECT o_orderkey, o_orderdate, true AS files_left_out FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""")
def prune_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a year, from the files that may hold one."""
    root = working_folder(spark, "by-date")
    read_table(spark, sf_dir, "orders").repartitionByRange(12, "o_orderdate").write.parquet(root)
    rows, used = footers.read_between(spark, root, "o_orderdate", "1997-01-01", "1997-12-31", "timestamp_ntz")
    left_out = used.filter(~F.col("was_read")).count() > 0
    return rows.select("o_orderkey", "o_orderdate", F.lit(left_out).alias("files_left_out"))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, landing.LandingStore]:
    """Workbooks of customers, one a nation and ten thousand keys, a sheet a segment; landed."""
    root = working_folder(spark, "workbooks")
    book = F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"), F.lit("/part "), F.floor(F.col("c_custkey") / 10_000).cast("string"))
    customers = read_table(spark, sf_dir, "customer").select(
        book.alias("book"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Customer.Name"))
    workbooks.write_workbooks(customers, root, "book", "segment", ["Customer Key"]).write.parquet(working_folder(spark, "export-log"))
    store = landing.LandingStore(working_folder(spark, "landed"), working_folder(spark, "landing-logs"))
    landing.run_landing(spark, root, store, "2025-01-01 00:00:00")
    return root, store


@query("land_workbooks", "SELECT c_custkey::VARCHAR AS customer_key, c_name AS customer_name, c_mktsegment AS segment FROM customer")
def land_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the customer table after they were written as workbooks and landed from them."""
    _, store = _landed(spark, sf_dir)
    return spark.read.parquet(store.tables).select(
        F.col("Customer_Key").cast("string").alias("customer_key"), F.col("Customer_Name").alias("customer_name"), F.col("_source_sheet").alias("segment"))


@query("delete_orphans", """SELECT 'nation ' || c_nationkey AS nation, c_mktsegment AS sheet, true AS deleted, 0 AS left_behind
FROM customer WHERE c_nationkey % 5 = 2 GROUP BY c_nationkey, c_mktsegment, c_custkey // 10000""")
def delete_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of the workbooks of some nations, after these workbooks were taken away."""
    root, store = _landed(spark, sf_dir)
    listed = files.list_files(spark, root, files.WORKBOOK_GLOB).filter(F.regexp_extract("file_path", "nation ([0-9]+)/", 1).cast("int") % 5 == 2)
    files.delete_listed(listed.select("uri")).write.parquet(working_folder(spark, "taken-away"))
    log = landing.delete_orphans(spark, root, store, "2025-01-02 00:00:00")
    left = spark.read.parquet(store.tables).filter(F.regexp_extract("__workbook", "nation_([0-9]+)_", 1).cast("int") % 5 == 2).count()
    return log.select(
        F.regexp_extract("file_path", "(nation [0-9]+)/", 1).alias("nation"), F.regexp_extract("output_file", "__sheet=(.*)$", 1).alias("sheet"),
        "deleted", F.lit(left).cast("int").alias("left_behind"))


@query("settled_load", """SELECT 'young files' AS load, 0::BIGINT AS records UNION ALL SELECT 'all files', count(*) FROM supplier""")
def settled_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that leaves files of the last hour to the next, and one that takes them."""
    root = working_folder(spark, "landing")
    read_table(spark, sf_dir, "supplier").write.parquet(f"{root}/supplies/suppliers/all")
    store = bronze.BronzeStore(working_folder(spark, "bronze"), working_folder(spark, "bronze-logs"))
    loads = []
    for batch, (name, seconds) in enumerate((("young files", 3600), ("all files", 0)), 1):
        log = bronze.load_bronze(spark, root, store, batch, sql.STAMP, settle_seconds=seconds)
        loads.append(log.agg(F.lit(name).alias("load"), F.coalesce(F.sum("records_count"), F.lit(0)).alias("records")))
    return loads[0].unionByName(loads[1])


@query("scan_error_rows", """SELECT 'torn.parquet' AS file_name, true AS has_error, NULL::BIGINT AS row_count
UNION ALL SELECT 'sound', false, count(*) FROM part""")
def scan_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the readable files of a folder, and an error row for one that is cut short."""
    root = working_folder(spark, "scan")
    parts = read_table(spark, sf_dir, "part")
    parts.write.parquet(root)

    def tear(batches):
        for batch in batches:
            for uri in batch["uri"].to_pylist():
                with files.create_file(f"{root}/torn.parquet") as handle, files.open_file(uri) as source:
                    handle.write(source.read(100))
            yield batch

    files.list_files(spark, root).orderBy("uri").limit(1).select("uri").mapInArrow(tear, "uri string").count()
    rows, errors = files.scan_sound(spark, root)
    return errors.select(file_name(F.col("file_path")).alias("file_name"), F.col("error_message").isNotNull().alias("has_error"), F.lit(None).cast("bigint").alias("row_count")).unionByName(
        rows.agg(F.lit("sound").alias("file_name"), F.lit(False).alias("has_error"), F.count(F.lit(1)).alias("row_count")))
