"""Log reports, over run logs and manifests derived from events and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators import oplog
from tillstone.operators.manifest import latest
from tillstone.queries.registry import query
from tillstone.sources.tables import TABLES, bronze_detailed, read_table
from tillstone.sources.tables import SQL_BRONZE_DETAILED

# Run log: one event per row.
_SQL_LOGS = """pipeline_logs AS (
SELECT CAST(event_id AS VARCHAR) AS log_id, ts AS timestamp,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
  event_type AS operation_type, CAST(floor(value * 10) AS INTEGER) AS duration_ms, event_type <> 'error' AS success
FROM events)"""

# Upload log: many entries per file over time.
_SQL_FILES = """processed_files AS (
SELECT 'in/f' || CAST(user_id AS VARCHAR) || '.parquet' AS file_path, event_type AS table_name, ts AS processed_at,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
  event_id % 1000 AS records_processed, CASE WHEN event_type = 'error' THEN 'bad file' END AS error_message,
  value AS processing_time_seconds, 'run' || strftime(ts, '%Y%m%d') AS run_id
FROM events)"""


def pipeline_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("log_id"),
        F.col("ts").alias("timestamp"),
        F.when(kind == "error", "ERROR").when(kind == "signup", "WARNING").otherwise("INFO").alias("level"),
        kind.alias("operation_type"),
        F.floor(F.col("value") * 10).cast("int").alias("duration_ms"),
        (kind != "error").alias("success"),
    )


def processed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("in/f"), F.col("user_id").cast("string"), F.lit(".parquet")).alias("file_path"),
        kind.alias("table_name"),
        F.col("ts").alias("processed_at"),
        F.when(kind == "error", "FAILED").when(kind == "view", "SKIPPED").otherwise("SUCCESS").alias("status"),
        (F.col("event_id") % 1000).alias("records_processed"),
        F.when(kind == "error", "bad file").alias("error_message"),
        F.col("value").alias("processing_time_seconds"),
        F.concat(F.lit("run"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
    )


@query("recent_logs", f"WITH {_SQL_LOGS} SELECT * FROM pipeline_logs ORDER BY timestamp DESC, log_id LIMIT 100")
def recent_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.recent_logs(pipeline_logs(spark, sf_dir))


@query("recent_warnings", f"""WITH {_SQL_LOGS} SELECT * FROM pipeline_logs WHERE level = 'WARNING'
ORDER BY timestamp DESC, log_id LIMIT 25""")
def recent_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.recent_logs(pipeline_logs(spark, sf_dir), 25, "WARNING")


@query("recent_errors", f"WITH {_SQL_LOGS} SELECT * FROM pipeline_logs WHERE level = 'ERROR'")
def recent_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.recent_errors(pipeline_logs(spark, sf_dir))


@query("daily_log_stats", f"""WITH {_SQL_LOGS} SELECT CAST(timestamp AS DATE) AS day, COUNT(*) AS total_operations,
  CAST(SUM(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
  ROUND(AVG(duration_ms), 6) AS avg_duration
FROM pipeline_logs GROUP BY 1""")
def daily_log_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.daily_log_stats(pipeline_logs(spark, sf_dir))


_SINCE = "2024-01-10 00:00:00"


@query("file_stats", f"""WITH {_SQL_FILES} SELECT table_name, COUNT(*) AS total_files,
  CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successful,
  CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  ROUND(AVG(processing_time_seconds), 6) AS avg_processing_time,
  CAST(SUM(records_processed) AS BIGINT) AS total_records
FROM processed_files WHERE processed_at >= TIMESTAMP '{_SINCE}' GROUP BY table_name""")
def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.file_stats(processed_files(spark, sf_dir), _SINCE)


@query("failed_files", f"""WITH {_SQL_FILES} SELECT file_path, table_name, error_message, processed_at
FROM processed_files WHERE status = 'FAILED' ORDER BY processed_at DESC, file_path LIMIT 20""")
def failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.failed_files(processed_files(spark, sf_dir))


@query("file_history", f"WITH {_SQL_FILES} SELECT * FROM processed_files WHERE file_path = 'in/f7.parquet'")
def file_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.file_history(processed_files(spark, sf_dir), "in/f7.parquet")


_SQL_RUNS = """SELECT run_id, MAX(processed_at) AS run_timestamp, COUNT(*) AS total_files,
  CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successful_files,
  CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_files,
  CAST(SUM(CASE WHEN status = 'SKIPPED' THEN 1 ELSE 0 END) AS BIGINT) AS skipped_files,
  ROUND(COALESCE(SUM(CASE WHEN status = 'SUCCESS' THEN processing_time_seconds END), 0), 6)
    AS total_processing_time_seconds,
  ROUND(COALESCE(AVG(CASE WHEN status = 'SUCCESS' THEN processing_time_seconds END), 0), 6)
    AS avg_processing_time_seconds
FROM processed_files GROUP BY run_id"""


@query("upload_run_stats", f"WITH {_SQL_FILES} {_SQL_RUNS}")
def upload_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.upload_run_stats(processed_files(spark, sf_dir))


@query("recent_runs", f"WITH {_SQL_FILES} {_SQL_RUNS} ORDER BY run_timestamp DESC, run_id LIMIT 5")
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.recent_runs(oplog.upload_run_stats(processed_files(spark, sf_dir)))


@query("latest_status", f"""WITH {_SQL_FILES} SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_path ORDER BY processed_at DESC, table_name) AS rn
  FROM processed_files) WHERE rn = 1""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(processed_files(spark, sf_dir), ["file_path"], ["processed_at"])


@query("load_summary", """SELECT 'user' || CAST(user_id AS VARCHAR) AS feature_name, 'COMPLETED' AS status,
  COUNT(*) AS files_processed, CAST(SUM(event_id % 1000) AS BIGINT) AS rows_loaded, MIN(ts) AS started_at,
  MAX(ts) AS completed_at, CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS DOUBLE) / 1000000 AS duration_seconds
FROM events GROUP BY user_id""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    operations = read_table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.sum(F.col("event_id") % 1000).alias("rows_loaded"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("completed_at"),
    )
    named = operations.withColumns({
        "feature_name": F.concat(F.lit("user"), F.col("user_id").cast("string")), "status": F.lit("COMPLETED"),
    })
    return oplog.load_summary(named)


@query("batch_distribution", f"""WITH {SQL_BRONZE_DETAILED} SELECT batch_id, COUNT(*) AS records,
  MIN(load_timestamp) AS first_load, MAX(load_timestamp) AS last_load FROM bronze_detailed GROUP BY batch_id""")
def batch_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.batch_distribution(bronze_detailed(spark, sf_dir))


def _overview_sql(table: str) -> str:
    names = f"(SELECT * FROM information_schema.columns WHERE table_name = '{table}')"
    return f"""SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {table}) AS row_count,
  (SELECT CAST(COUNT(*) AS INTEGER) FROM {names}) AS column_count,
  (SELECT string_agg(column_name, ', ' ORDER BY ordinal_position) FROM {names} WHERE ordinal_position <= 5)
    AS sample_columns"""


@query("table_overview", " UNION ALL ".join(_overview_sql(table) for table in TABLES))
def table_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.table_overview({name: read_table(spark, sf_dir, name) for name in TABLES})


# Silver process log and issue log: one entry per event.
_SQL_PROCESS = """process_log AS (
SELECT CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status, event_id % 1000 AS records_processed,
  event_id % 900 AS records_valid, event_id % 70 AS credit_notes_separated,
  event_id % 9 AS potential_duplicates_detected, event_id % 5 AS whitespace_issues_found FROM events)"""


@query("process_totals", f"""WITH {_SQL_PROCESS} SELECT COUNT(*) AS total_processes,
  CAST(SUM(records_processed) AS BIGINT) AS total_records_processed,
  CAST(SUM(records_valid) AS BIGINT) AS total_valid_records,
  CAST(SUM(credit_notes_separated) AS BIGINT) AS total_credit_notes,
  CAST(SUM(potential_duplicates_detected) AS BIGINT) AS total_potential_duplicates,
  CAST(SUM(whitespace_issues_found) AS BIGINT) AS total_whitespace_issues
FROM process_log WHERE status = 'COMPLETED'""")
def process_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    log = read_table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        (event % 1000).alias("records_processed"),
        (event % 900).alias("records_valid"),
        (event % 70).alias("credit_notes_separated"),
        (event % 9).alias("potential_duplicates_detected"),
        (event % 5).alias("whitespace_issues_found"),
    )
    return oplog.process_totals(log)


# Landing manifest: one document per source file.
_SQL_LANDING = """manifest AS (
SELECT doc_id, n_chars AS excel_row_count, n_chars - CAST(doc_id % 37 = 0 AS BIGINT) AS parquet_row_count,
  CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS sheets, CASE WHEN doc_id % 41 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM documents)"""
_SQL_RUN_STATS = """run_stats AS (
SELECT COUNT(*) AS total_files, CAST(SUM(sheets) AS BIGINT) AS total_sheets, CAST(SUM(sheets) AS BIGINT) AS total_outputs,
  CAST(SUM(excel_row_count) AS BIGINT) AS total_excel_rows, CAST(SUM(parquet_row_count) AS BIGINT) AS total_parquet_rows,
  COUNT(*) FILTER (status = 'SUCCESS') AS success_count, COUNT(*) FILTER (status = 'FAILED') AS failure_count,
  COUNT(*) FILTER (excel_row_count <> parquet_row_count) AS files_with_row_mismatch,
  CAST(SUM(excel_row_count - parquet_row_count) AS BIGINT) AS total_row_difference FROM manifest)"""


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    two, one = F.array(F.lit("Sheet1"), F.lit("Sheet2")), F.array(F.lit("Sheet1"))
    sheets = F.when(doc % 3 == 0, two).otherwise(one)
    return read_table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("file_path"),
        sheets.alias("sheets_processed"),
        F.transform(sheets, lambda s: F.concat(F.lit("out/"), doc.cast("string"), F.lit("_"), s)).alias("output_files"),
        F.col("n_chars").alias("excel_row_count"),
        (F.col("n_chars") - (doc % 37 == 0).cast("bigint")).alias("parquet_row_count"),
        F.when(doc % 41 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
    )


@query("run_stats", f"WITH {_SQL_LANDING}, {_SQL_RUN_STATS} SELECT * FROM run_stats")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.run_stats(landing_manifest(spark, sf_dir))


@query("run_invariants", f"""WITH {_SQL_LANDING}, {_SQL_RUN_STATS} SELECT *, counts_agree AND no_failures
  AND no_mismatches AND no_difference AND rows_agree AS run_passed FROM (SELECT
  total_files = total_sheets AND total_sheets = success_count AS counts_agree, failure_count = 0 AS no_failures,
  files_with_row_mismatch = 0 AS no_mismatches, total_row_difference = 0 AS no_difference,
  total_excel_rows = total_parquet_rows AS rows_agree FROM run_stats)""")
def run_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.run_invariants(oplog.run_stats(landing_manifest(spark, sf_dir)))


def silver_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.array(
        F.lit("missing_value_handling"),
        F.when(F.col("n_chars") > 500, "data_type_standardization"),
        F.when(F.col("lang") == "en", "column_name_standardization"),
    )
    return read_table(spark, sf_dir, "documents").select(
        F.array_compact(steps).alias("transformations_applied"),
        F.col("n_chars").alias("row_count"),
        F.lit(5).alias("column_count"),
    )


@query("transformation_counts", """SELECT transformation, COUNT(*) AS times_applied FROM (
  SELECT unnest(['missing_value_handling', CASE WHEN n_chars > 500 THEN 'data_type_standardization' END,
    CASE WHEN lang = 'en' THEN 'column_name_standardization' END]) AS transformation FROM documents)
WHERE transformation IS NOT NULL GROUP BY transformation""")
def transformation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.transformation_counts(silver_manifest(spark, sf_dir))


@query("silver_file_summary", """SELECT COUNT(*) AS total_files_processed,
  CAST(SUM(n_chars) AS BIGINT) AS total_rows_processed, CAST(5 * COUNT(*) AS BIGINT) AS total_columns_processed
FROM documents""")
def silver_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.silver_file_summary(silver_manifest(spark, sf_dir))
