"""Scans, names, bronze loads and sinks. Loads write below the session's working folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.naming import bronze_table_name, file_name, relative_path, safe_sheet_name, warehouse_table_name
from tillstone.operators import oplog, profile, quality
from tillstone.plans import bronze, incremental, medallion, silver, summary, warehouse
from tillstone.queries import silver_sql as sql
from tillstone.queries.registry import CHECKS, query
from tillstone.session import working_folder
from tillstone.sources import files, sinks
from tillstone.sources.tables import (
    SQL_BRONZE_DETAILED,
    SQL_BRONZE_SUMMARIZED,
    TABLES,
    bronze_detailed,
    bronze_summarized,
    export_year,
    read_table,
)
from tillstone.streaming.bronze_stream import stream_bronze

_LOADED, _RELOADED = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


@query("scan_lineitem", "SELECT *, 'lineitem.parquet' AS source_file FROM lineitem")
def scan_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.scan_tree(spark, sf_dir, "lineitem.parquet")
    return rows.select("*", file_name(F.col("source_file_path")).alias("source_file")).drop("source_file_path")


@query("file_row_counts", " UNION ALL ".join(
    f"SELECT '{table}.parquet' AS file_name, COUNT(*) AS row_count FROM {table}" for table in TABLES))
def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [files.file_row_counts(read_table(spark, sf_dir, name)) for name in TABLES]
    merged = reduce(DataFrame.unionByName, counts)
    return merged.select(file_name(F.col("file_path")).alias("file_name"), F.col("rows").alias("row_count"))


_PLAIN_URL = "regexp_replace(url, '^[A-Za-z]+:/+', '')"


@query("route_table_name", f"""SELECT page_id, 'bronze_' || lower(array_to_string(
  list_slice(string_split({_PLAIN_URL}, '/'), 1, 3), '_')) AS table_name FROM pages""")
def route_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    relative = relative_path(F.col("url"), "/no-such-root")
    return read_table(spark, sf_dir, "pages").select("page_id", bronze_table_name(relative).alias("table_name"))


@query("warehouse_table_name", f"""WITH split AS (SELECT page_id,
  list_filter(string_split({_PLAIN_URL}, '/'), lambda p: p <> '') AS parts FROM pages)
SELECT page_id, 'pos_' || array_to_string(list_concat(
  list_transform(parts[1:len(parts) - 1], lambda p: regexp_replace(lower(p), '^(.+)\\.[^.]+$', '\\1')),
  [regexp_replace(lower(regexp_replace(parts[len(parts)], '^(.+)\\.[^.]+$', '\\1')), '[^\\p{{L}}\\p{{N}}_]', '_', 'g')]),
  '_') AS table_name FROM split""")
def warehouse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = warehouse_table_name(F.col("url"), "pos")
    return read_table(spark, sf_dir, "pages").select("page_id", name.alias("table_name"))


@query("safe_sheet_name", """SELECT item_id, replace(trim(regexp_replace(text, '[^\\p{L}\\p{N} _\\-]', '', 'g'), ' '),
  ' ', '_') AS sheet_name FROM benchmark""")
def safe_sheet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark").select("item_id", safe_sheet_name(F.col("text")).alias("sheet_name"))


@query("bronze_with_lineage", f"""SELECT *, 'orders.parquet' AS source_file,
  TIMESTAMP '{_LOADED}' AS load_timestamp, 1 AS batch_id FROM orders""")
def bronze_with_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = bronze.with_lineage(read_table(spark, sf_dir, "orders"), _LOADED, 1)
    return loaded.withColumn("source_file", file_name(F.col("source_file_path"))).drop("source_file_path")


@query("bronze_append_by_name", """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END
  AS o_orderpriority, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey FROM orders""")
def bronze_append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    held = orders.filter(finished).select("o_orderkey", "o_totalprice", "o_orderpriority")
    arriving = orders.filter(~finished).select("o_custkey", "o_totalprice", "o_orderkey")
    return bronze.append_by_name(held, arriving)


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Both bronze-shaped views as a landing tree, without the columns the load adds."""
    root = working_folder(spark, "landing")
    for grain, view in (("summarized", bronze_summarized), ("detailed", bronze_detailed)):
        rows = view(spark, sf_dir).drop("source_file_path", "load_timestamp", "batch_id")
        sinks.write_tree(rows, f"{root}/sales/cash_invoices/{grain}/2025/january")
    return root


def _load_once(spark: SparkSession, sf_dir: str) -> bronze.BronzeStore:
    """A store with the views landed and loaded; what was landed goes, as nothing reads it any more."""
    root, store = _landing(spark, sf_dir), _store(spark)
    bronze.load_bronze(spark, root, store, 1, _LOADED)
    sinks.delete_paths(spark, [root])
    return store


def _store(spark: SparkSession) -> bronze.BronzeStore:
    return bronze.BronzeStore(working_folder(spark, "bronze"), working_folder(spark, "bronze-logs"))


@query("bronze_load", sql.with_tables(SQL_BRONZE_SUMMARIZED, SQL_BRONZE_DETAILED) + " UNION ALL ".join(
    f"""SELECT 'bronze_sales_cash_invoices_{grain}' AS table_name, 'SUCCESS' AS status,
  CAST(COUNT(*) AS BIGINT) AS records_count FROM bronze_{grain}""" for grain in ("summarized", "detailed")))
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = bronze.load_bronze(spark, _landing(spark, sf_dir), _store(spark), 1, _LOADED)
    return log.groupBy("table_name", "status").agg(F.sum("records_count").alias("records_count"))


def _silver(spark: SparkSession) -> medallion.SilverStore:
    return medallion.SilverStore(working_folder(spark, "silver"), working_folder(spark, "silver-logs"))


@query("medallion_daily_summary", None)
def medallion_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, silver_store = _load_once(spark, sf_dir), _silver(spark)
    medallion.run_silver(spark, store, silver_store, sql.PROCESS_ID, sql.STAMP)
    return spark.read.parquet(silver_store.table("daily_sales_summary"))


def _exported_twice(spark: SparkSession, sf_dir: str, after_load: Callable[[int, bronze.BronzeStore], None]) -> bronze.BronzeStore:
    """One file a grain and year; half of the rows of some years landed and loaded, then exported again with the rest."""
    root, store, staged = working_folder(spark, "landing"), _store(spark), working_folder(spark, "export")
    for grain, view in (("summarized", bronze_summarized), ("detailed", bronze_detailed)):
        rows = view(spark, sf_dir, True).drop("source_file_path", "load_timestamp", "batch_id").withColumn("year", export_year(F.col("_processed_at")))
        again = F.col("year").isin("1996", "1999")
        half = F.pmod(F.xxhash64("DOCUMENT_NUMBER"), F.lit(2)) == 0
        # both exports come out of one pass over the view
        exports = F.array_compact(F.array(F.when(~again | half, 1), F.when(again, 2)))
        _stage_exports(rows.withColumn("export", F.explode(exports)), f"{staged}/{grain}")
    for batch, stamp in ((1, _LOADED), (2, _RELOADED)):
        for grain in ("summarized", "detailed"):
            _export(spark, f"{staged}/{grain}/export={batch}", f"{root}/sales/cash_invoices/{grain}")
        bronze.load_bronze(spark, root, store, batch, stamp)
        if batch == 2:
            sinks.delete_paths(spark, [root, staged])  # nothing reads the exports any more
        after_load(batch, store)
    return store


def _stage_exports(rows: DataFrame, staged: str) -> None:
    """Rows of a year come in one task, so there is one file for each export and year."""
    with sinks.unsorted_partitions(rows.sparkSession):
        sinks.write_tree(rows, staged, codec=sinks.SILVER_CODEC, partitions=["export", "year"])


def _export(spark: SparkSession, staged: str, folder: str) -> None:
    """A file of a fixed name for each year, as the exporting program writes it: a re-export overwrites it."""
    for written in files.list_files(spark, staged).select("uri", F.regexp_extract("uri", "year=([0-9]+)", 1).alias("year")).collect():
        sinks.move_file(spark, written.uri, f"{folder}/{written.year}/export.parquet")


@query("medallion_after_change", None)
def medallion_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full silver run after files were exported again."""
    silver_store = _silver(spark)
    store = _exported_twice(spark, sf_dir, lambda batch, store: None)
    medallion.run_silver(spark, store, silver_store, sql.PROCESS_ID, sql.STAMP)
    return spark.read.parquet(silver_store.table("daily_sales_summary"))


def _incremental(spark: SparkSession, sf_dir: str) -> medallion.SilverStore:
    """Silver brought up to each of the two batches; the second reads and writes what its files touch."""
    silver_store = _silver(spark)
    _exported_twice(spark, sf_dir, lambda batch, store: incremental.run_incremental(spark, store, silver_store, batch, sql.PROCESS_ID, sql.STAMP))
    return silver_store


@query("silver_incremental", None)
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily summary over the silver tables that the incremental run left."""
    store = _incremental(spark, sf_dir)
    pairs = [tuple(incremental.read_silver(spark, store, f"{grain}_{kind}") for kind in ("invoices", "credit_notes")) for grain in ("summarized", "detailed")]
    return summary.daily_sales_summary(*pairs, sql.STAMP)


@query("daily_summary_incremental", None)
def daily_summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily summary merged from the states of files."""
    return incremental.read_silver(spark, _incremental(spark, sf_dir), "daily_sales_summary")


@query("medallion_from_stream", None)
def medallion_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both grains streamed into bronze, each with a checkpoint of its own, then the silver run."""
    root, store, silver_store = _landing(spark, sf_dir), _store(spark), _silver(spark)
    for grain in ("summarized", "detailed"):
        schema = spark.read.parquet(f"{root}/sales/cash_invoices/{grain}/2025/january").schema
        stream_bronze(spark, root, schema, store, working_folder(spark, "stream"), _LOADED,
                      glob="*.parquet", folder=f"sales/cash_invoices/{grain}").awaitTermination()
    sinks.delete_paths(spark, [root])  # nothing reads the landed files any more
    medallion.run_silver(spark, store, silver_store, sql.PROCESS_ID, sql.STAMP)
    return spark.read.parquet(silver_store.table("daily_sales_summary"))


@query("load_operations", sql.with_tables(SQL_BRONZE_SUMMARIZED, SQL_BRONZE_DETAILED) + """SELECT feature_name, 'COMPLETED' AS status,
  CASE WHEN feature_name = 'sales' THEN (SELECT COUNT(*) FROM bronze_summarized) + (SELECT COUNT(*) FROM bronze_detailed) ELSE 0 END AS rows_loaded
FROM (SELECT unnest(['sales', 'supplies', 'inventory']) AS feature_name)""")
def load_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    bronze.load_bronze(spark, _landing(spark, sf_dir), store, 1, _LOADED)
    return bronze.load_operations(spark, store).select("feature_name", "status", "rows_loaded")


@query("duplicates_removed_log", sql.with_tables(SQL_BRONZE_SUMMARIZED, SQL_BRONZE_DETAILED) + """SELECT 'detailed_invoices' AS target_table,
  (SELECT COUNT(*) - COUNT(DISTINCT (coalesce(trim(DOCUMENT_NUMBER), '~'), coalesce(trim(ITEM_CODE), '~'), coalesce(trim(TRN_DATE), '~'),
     coalesce(trim(CAST(AMOUNT AS VARCHAR)), '~'))) FROM bronze_detailed) AS removed_rows""")
def duplicates_removed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the removal of duplicates left out, as its log says."""
    store, silver_store = _load_once(spark, sf_dir), _silver(spark)
    medallion.clean_grain(spark, store, silver_store, "detailed", silver.Run(sql.PROCESS_ID, sql.STAMP), remove_duplicates=True)
    log = spark.read.parquet(silver_store.log("data_quality_log")).filter(F.col("issue_type") == quality.DUPLICATES_REMOVED)
    return log.select(F.lit("detailed_invoices").alias("target_table"), F.col("affected_rows").alias("removed_rows"))


@query("bronze_deduplicated", sql.with_tables(SQL_BRONZE_DETAILED) + """SELECT DISTINCT trim(DOCUMENT_NUMBER) AS DOCUMENT_NUMBER, trim(ITEM_CODE) AS ITEM_CODE,
  trim(TRN_DATE) AS TRN_DATE, AMOUNT, 2 AS versions FROM bronze_detailed""")
def bronze_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a bronze table's second version without repeats; the first one stays readable."""
    store, target = _load_once(spark, sf_dir), working_folder(spark, "deduplicated")
    for version in (1, 2):
        table = medallion.write_deduplicated(spark, store, target, "detailed", version, _LOADED)
    versions = table.versions().count()
    return table.read().select(*silver.BRONZE_KEYS["detailed"], F.lit(versions).alias("versions"))


@query("state_json", """SELECT s_suppkey AS id, s_name AS name, NULL AS corrupt_line FROM supplier
UNION ALL SELECT NULL, NULL, '{"id": ' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 0""")
def state_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of JSON lines of which some are cut short."""
    path = working_folder(spark, "state")
    suppliers = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    whole = suppliers.select(F.to_json(F.struct("id", "name")).alias("value"))
    torn = suppliers.filter(F.col("id") % 10 == 0).select(F.concat(F.lit('{"id": '), F.col("id").cast("string")).alias("value"))
    whole.unionByName(torn).write.text(path)
    return sinks.read_state_json(spark, path, "id bigint, name string")


_KINDS = ("xls", "xlsx", "xlsm", "xlsb", "csv", "xlsx~")


@query("list_workbooks", f"""SELECT {list(_KINDS)!r}[s_suppkey % {len(_KINDS)} + 1] AS kind, count(*) AS found FROM supplier
WHERE s_suppkey % {len(_KINDS)} < 4 GROUP BY ALL""")
def list_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the landing takes for workbooks, among files of a folder tree."""
    root = working_folder(spark, "mixed")

    def create(batches):
        for batch in batches:
            for key in batch["s_suppkey"].to_pylist():
                with files.create_file(f"{root}/{key % 3}/{key}.{_KINDS[key % len(_KINDS)]}") as handle:
                    handle.write(b"x")
            yield batch

    read_table(spark, sf_dir, "supplier").select("s_suppkey").mapInArrow(create, "s_suppkey bigint").write.parquet(working_folder(spark, "created"))
    listed = files.list_files(spark, root, files.WORKBOOK_GLOB)
    return listed.groupBy(F.regexp_extract("file_path", "[.]([^.]+)$", 1).alias("kind")).agg(F.count(F.lit(1)).alias("found"))


@query("stream_bronze", f"""SELECT *, 'orders.parquet' AS source_file,
  TIMESTAMP '{_LOADED}' AS load_timestamp, 1000000000 AS batch_id FROM orders""")
def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_table(spark, sf_dir, "orders").schema
    store = _store(spark)
    stream_bronze(
        spark, sf_dir, schema, store, working_folder(spark, "stream"), _LOADED, glob="orders.parquet"
    ).awaitTermination()
    loaded = spark.read.parquet(store.table("bronze_orders.parquet"))
    return loaded.withColumn("source_file", file_name(F.col("source_file_path"))).drop("source_file_path")


@query("two_streams", """SELECT o_orderkey, o_totalprice, if(o_orderkey % 3 = 1, 1001000000, if(o_orderkey % 3 = 0, 1000000000, 1000000001)) AS batch_id,
  3 AS logged_files FROM orders""")
def two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a checkpoint each fill one table, and the first is started again for a new file."""
    root, store, orders = working_folder(spark, "landing"), _store(spark), read_table(spark, sf_dir, "orders")
    checkpoints = {"2024": working_folder(spark, "stream"), "2025": working_folder(spark, "stream")}
    for part, (folder, year) in enumerate((("a", "2024"), ("b", "2025"), ("c", "2024"))):
        sinks.write_tree(orders.filter(F.col("o_orderkey") % 3 == part).coalesce(1), f"{root}/sales/orders/all/{year}/{folder}")
        stream_bronze(spark, root, orders.schema, store, checkpoints[year], _LOADED, folder=f"sales/orders/all/{year}").awaitTermination()
    loaded = spark.read.parquet(store.table("bronze_sales_orders_all"))
    logged = bronze.read_file_log(spark, store).select("file_path").distinct().count()
    return bronze.current_rows(loaded, bronze.read_file_log(spark, store)).select("o_orderkey", "o_totalprice", "batch_id", F.lit(logged).alias("logged_files"))


@query("warehouse_upload", "SELECT 'loaded' AS state, * FROM orders")
def warehouse_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table after every file was uploaded and a second run found nothing to do."""
    target, log_path = working_folder(spark, "warehouse"), working_folder(spark, "upload-log")
    warehouse.upload(spark, sf_dir, target, log_path, _LOADED)
    log = warehouse.upload(spark, sf_dir, target, log_path, _RELOADED)
    name = log.filter(file_name(F.col("file_path")) == "orders.parquet").first().table_name
    return warehouse.read_uploaded(spark, target, name).select(F.lit("loaded").alias("state"), "*")


@query("warehouse_upload_log", " UNION ALL ".join(
    f"""SELECT '{table}.parquet' AS file_name, 'SUCCESS' AS status, COUNT(*) AS records_processed FROM {table}"""
    for table in TABLES))
def warehouse_upload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = warehouse.upload(
        spark, sf_dir, working_folder(spark, "warehouse"), working_folder(spark, "upload-log"), _LOADED
    )
    return log.select(file_name(F.col("file_path")).alias("file_name"), "status", "records_processed")


@query("upload_rerun_stats", f"""SELECT {len(TABLES)}::BIGINT AS total_files, 0::BIGINT AS successful_files, 0::BIGINT AS failed_files,
  {len(TABLES)}::BIGINT AS skipped_files, (SELECT COUNT(*) FROM lineitem) AS lineitem_rows""")
def upload_rerun_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of a second run over unchanged files, next to the rows that the tables then hold."""
    target, log_path = working_folder(spark, "warehouse"), working_folder(spark, "upload-log")
    warehouse.upload(spark, sf_dir, target, log_path, _LOADED)
    log = warehouse.upload(spark, sf_dir, target, log_path, _RELOADED)
    events = warehouse.run_events(spark, log_path, _RELOADED).withColumn("run_id", F.lit(2))
    name = log.filter(file_name(F.col("file_path")) == "lineitem.parquet").first().table_name
    rows = warehouse.read_uploaded(spark, target, name).count()
    stats = oplog.upload_run_stats(events)
    return stats.select("total_files", "successful_files", "failed_files", "skipped_files", F.lit(rows).cast("bigint").alias("lineitem_rows"))


@query("file_fingerprints", " UNION ALL ".join(f"SELECT '{table}.parquet' AS file_name, true AS same_hash" for table in TABLES))
def file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each file has the same hash when Spark hashes it whole and when a task reads it by blocks."""
    whole = files.fingerprints(spark, sf_dir)
    blocks = files.fingerprints(spark, sf_dir, whole=-1).select("file_path", F.col("file_hash").alias("by_blocks"))
    named = file_name(F.col("file_path"))
    return whole.join(blocks, "file_path").filter(named.isin([f"{t}.parquet" for t in TABLES])).select(
        named.alias("file_name"), (F.col("file_hash") == F.col("by_blocks")).alias("same_hash"))


@query("sink_silver_files", "SELECT * FROM lineitem")
def sink_silver_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "silver-files")
    lines = read_table(spark, sf_dir, "lineitem")
    sinks.write_tree(lines, path, codec=sinks.SILVER_CODEC, partitions=["l_linestatus", "l_returnflag"])
    return spark.read.parquet(path).select(*lines.columns)


@query("warehouse_dispositions", """SELECT event_type, COUNT(*) * 2 AS loaded_rows FROM events GROUP BY event_type""")
def warehouse_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "dispositions")
    events = read_table(spark, sf_dir, "events")
    sinks.load_table(events, path, sinks.EMPTY)
    sinks.load_table(events, path, sinks.TRUNCATE)
    sinks.load_table(events, path, sinks.APPEND)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("loaded_rows"))


@query("export_csv_head", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders
ORDER BY orders.o_orderkey LIMIT 20""")
def export_csv_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "csv")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    sinks.export_csv(profile.head(orders, ["o_orderkey"], 20), path)
    return spark.read.option("header", True).csv(path)


@query("sample_tail", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 20")
def sample_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.tail(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 20)


# The runs through files must end in the same summary as the direct query.
for _name in ("medallion_daily_summary", "medallion_after_change", "medallion_from_stream", "silver_incremental", "daily_summary_incremental"):
    CHECKS[_name] = CHECKS["daily_sales_summary"]
