"""Reports over run logs, load logs and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.operators.manifest import COMPLETED, FAILED, SUCCESS


def _rows() -> Column:
    return F.count(F.lit(1))


def _newest(*names: str) -> list[Column]:
    return [F.col(names[0]).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in names[1:]]]


def recent(df: DataFrame, order: str, n: int | None = None, where: Column | None = None, tie: str | None = None):
    """Newest rows first; ``n`` of them when given."""
    rows = df if where is None else df.filter(where)
    rows = rows.orderBy(*_newest(order, *([tie] if tie else [])))
    return rows if n is None else rows.limit(n)


def recent_logs(logs: DataFrame, n: int = 100, level: str | None = None) -> DataFrame:
    where = None if level is None else F.col("level") == level
    return recent(logs, "timestamp", n, where, tie="log_id")


def recent_errors(logs: DataFrame) -> DataFrame:
    return recent(logs, "timestamp", where=F.col("level") == "ERROR", tie="log_id")


def recent_runs(stats: DataFrame, n: int = 5) -> DataFrame:
    return recent(stats, "run_timestamp", n, tie="run_id")


def failed_files(files: DataFrame, n: int = 20) -> DataFrame:
    failed = recent(files, "processed_at", n, F.col("status") == FAILED, tie="file_path")
    return failed.select("file_path", "table_name", "error_message", "processed_at")


def file_history(files: DataFrame, file_path: str | None = None) -> DataFrame:
    where = None if file_path is None else F.col("file_path") == file_path
    return recent(files, "processed_at", where=where, tie="file_path")


def schema_change_history(changes: DataFrame) -> DataFrame:
    return recent(changes, "change_date", tie="column_name").select(
        "feature_name", "table_name", "change_type", "column_name", "change_date"
    )


def daily_log_stats(logs: DataFrame) -> DataFrame:
    """Operations, successes and mean duration per day."""
    daily = logs.groupBy(F.to_date("timestamp").alias("day")).agg(
        _rows().alias("total_operations"),
        F.count_if(F.col("success")).alias("success_count"),
        F.round(F.avg("duration_ms"), 6).alias("avg_duration"),
    )
    return daily.orderBy(F.col("day").desc())


def file_stats(files: DataFrame, since: str | None = None) -> DataFrame:
    """Files, outcomes, mean time and records per table since a cut-off."""
    if since is not None:
        files = files.filter(F.col("processed_at") >= F.lit(since).cast("timestamp_ntz"))
    stats = files.groupBy("table_name").agg(
        _rows().alias("total_files"),
        F.count_if(F.col("status") == SUCCESS).alias("successful"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.round(F.avg("processing_time_seconds"), 6).alias("avg_processing_time"),
        F.sum("records_processed").cast("bigint").alias("total_records"),
    )
    return stats.orderBy(F.col("total_files").desc(), "table_name")


def load_summary(operations: DataFrame) -> DataFrame:
    """Load operations, newest first, with their duration in seconds."""
    micros = F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(
        F.col("started_at").cast("timestamp")
    )
    return operations.select(
        "feature_name", "status", "files_processed", "rows_loaded", "started_at", "completed_at",
        (micros / F.lit(1_000_000.0)).alias("duration_seconds"),
    ).orderBy(*_newest("started_at", "feature_name"))


def batch_distribution(bronze: DataFrame) -> DataFrame:
    """Records and load times per batch."""
    return bronze.groupBy("batch_id").agg(
        _rows().alias("records"),
        F.min("load_timestamp").alias("first_load"),
        F.max("load_timestamp").alias("last_load"),
    ).orderBy("batch_id")


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and leading column names of each table. Only row counts touch the data."""
    overviews = [
        df.agg(_rows().alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(", ".join(df.columns[:5])).alias("sample_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, overviews)


def process_totals(process_log: DataFrame) -> DataFrame:
    """Totals over completed silver processes."""
    done = process_log.filter(F.col("status") == COMPLETED)
    totals = {
        "total_records_processed": "records_processed",
        "total_valid_records": "records_valid",
        "total_credit_notes": "credit_notes_separated",
        "total_potential_duplicates": "potential_duplicates_detected",
        "total_whitespace_issues": "whitespace_issues_found",
    }
    return done.agg(
        _rows().alias("total_processes"),
        *[F.sum(column).cast("bigint").alias(name) for name, column in totals.items()],
    )


def dq_issue_summary(issues: DataFrame) -> DataFrame:
    """Issues and affected rows per type, largest first."""
    summary = issues.groupBy("issue_type").agg(
        _rows().alias("issue_count"), F.sum("affected_rows").cast("bigint").alias("total_rows_affected")
    )
    return summary.orderBy(F.col("total_rows_affected").desc(), "issue_type")


def transformation_counts(manifest: DataFrame) -> DataFrame:
    """How often each transformation was applied."""
    steps = manifest.select(F.explode("transformations_applied").alias("transformation"))
    return steps.groupBy("transformation").agg(_rows().alias("times_applied"))


def silver_file_summary(manifest: DataFrame) -> DataFrame:
    """Files, rows and columns over the silver-file manifest."""
    return manifest.agg(
        _rows().alias("total_files_processed"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("total_rows_processed"),
        F.coalesce(F.sum("column_count"), F.lit(0)).cast("bigint").alias("total_columns_processed"),
    )


def run_stats(manifest: DataFrame) -> DataFrame:
    """Landing run figures from its manifest: one row per source file, arrays of sheets and outputs."""
    excel, parquet = F.col("excel_row_count"), F.col("parquet_row_count")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return manifest.agg(
        _rows().alias("total_files"),
        total(F.size("sheets_processed")).alias("total_sheets"),
        total(F.size("output_files")).alias("total_outputs"),
        total(excel).alias("total_excel_rows"),
        total(parquet).alias("total_parquet_rows"),
        F.count_if(F.col("status") == SUCCESS).alias("success_count"),
        F.count_if(F.col("status") == FAILED).alias("failure_count"),
        F.count_if(excel != parquet).alias("files_with_row_mismatch"),
        total(excel - parquet).alias("total_row_difference"),
    )


def run_invariants(stats: DataFrame) -> DataFrame:
    """The checks a clean landing run must pass."""
    c = F.col
    checks = {
        "counts_agree": (c("total_files") == c("total_sheets")) & (c("total_sheets") == c("success_count")),
        "no_failures": c("failure_count") == 0,
        "no_mismatches": c("files_with_row_mismatch") == 0,
        "no_difference": c("total_row_difference") == 0,
        "rows_agree": c("total_excel_rows") == c("total_parquet_rows"),
    }
    passed = reduce(Column.__and__, checks.values())
    return stats.select(*[check.alias(name) for name, check in checks.items()], passed.alias("run_passed"))


def upload_run_stats(files: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Upload figures per run; times cover successful files only, skipped files are marked SKIPPED."""
    succeeded = F.col("status") == SUCCESS
    seconds = F.when(succeeded, F.col("processing_time_seconds"))
    return files.groupBy(*by).agg(
        F.max("processed_at").alias("run_timestamp"),
        _rows().alias("total_files"),
        F.count_if(succeeded).alias("successful_files"),
        F.count_if(F.col("status") == FAILED).alias("failed_files"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped_files"),
        F.round(F.coalesce(F.sum(seconds), F.lit(0.0)), 6).alias("total_processing_time_seconds"),
        F.round(F.coalesce(F.avg(seconds), F.lit(0.0)), 6).alias("avg_processing_time_seconds"),
    )
