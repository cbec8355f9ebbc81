"""Landing run: changed workbooks into one Parquet folder per sheet, with manifest, reconciliation and figures.

Workbooks are decoded once, in tasks, into stored cells. Sheets that share a header are written in one
job. The manifest is written last, as events of the run; its view is the latest event of each workbook,
so a run that was cut off is done again. Outputs of workbooks that are gone are deleted in a step of
their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.naming import relative_path, safe_sheet_name, without_extension
from tillstone.operators.manifest import FAILED, SUCCESS, files_to_process, latest, orphaned_outputs
from tillstone.operators.oplog import run_stats
from tillstone.plans.bronze import write_batch
from tillstone.session import working_folder
from tillstone.sources import workbooks
from tillstone.sources.files import WORKBOOK_GLOB, delete_listed, fingerprints
from tillstone.sources.sinks import delete_paths, read_table_or_none

FOLDER, SHEET = "__workbook", "__sheet"
MANIFEST_SCHEMA = (
    "file_path string, file_hash string, last_modified timestamp, status string, error_message string, sheets_processed array<string>, "
    "output_files array<string>, excel_row_count bigint, parquet_row_count bigint, processed_at string, deleted boolean"
)


@dataclass(frozen=True)
class LandingStore:
    """Where landed sheets and the landing logs live."""

    tables: str
    logs: str


def manifest(spark: SparkSession, store: LandingStore) -> DataFrame:
    """Latest event of each workbook that still has outputs."""
    events = read_table_or_none(spark, f"{store.logs}/manifest")
    if events is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest(events.drop("run"), ["file_path"], ["processed_at"]).filter(~F.col("deleted"))


def _output(workbook: str, sheet: str) -> F.Column:
    return F.concat(F.lit(f"{FOLDER}="), F.col(workbook), F.lit(f"/{SHEET}="), F.col(sheet))


def run_landing(spark: SparkSession, root: str, store: LandingStore, processed_at: str) -> DataFrame:
    """Land new and changed workbooks; returns the run's figures."""
    listing = fingerprints(spark, root, WORKBOOK_GLOB)
    known = manifest(spark, store).filter(F.col("status") == SUCCESS)
    todo = files_to_process(listing, known, by=("file_hash",))
    staged = working_folder(spark, "landing")
    todo.write.parquet(f"{staged}/files")
    files = spark.read.parquet(f"{staged}/files")
    try:
        cells = workbooks.read_workbooks(spark, root)
        cells.join(files.select("file_path"), "file_path", "left_semi").write.parquet(f"{staged}/cells")
        cells = spark.read.parquet(f"{staged}/cells")
        stem = F.translate(without_extension(relative_path(F.col("file_path"), root)), "/ ", "__")
        rows = workbooks.sheet_rows(cells).withColumns({FOLDER: stem, SHEET: safe_sheet_name(F.col("sheet_name"))})
        rows.write.parquet(f"{staged}/rows")
        rows = spark.read.parquet(f"{staged}/rows")
        head = workbooks.headers(cells).groupBy("file_path", "sheet_name").agg(
            F.sort_array(F.collect_list(F.struct("column_number", "column_name"))).getField("column_name").alias("columns"))
        # one job for each distinct header, not for each sheet
        for found in head.select("columns").distinct().collect():
            sheets = rows.join(head.filter(F.col("columns") == F.lit(found.columns)).select("file_path", "sheet_name"), ["file_path", "sheet_name"], "left_semi")
            table = sheets.select(
                *[F.col("cells").getItem(name).alias(name) for name in found.columns], F.col("sheet_name").alias("_source_sheet"),
                F.lit(processed_at).alias("_processed_at"), FOLDER, SHEET)
            # a sheet is bounded by its format, so one task writes it whole, as one file
            write_batch(table.repartition(FOLDER, SHEET), store.tables, (FOLDER, SHEET))
        _log(spark, store, files, cells, rows, processed_at)
    finally:
        delete_paths(spark, [staged])
    return run_stats(run_events(spark, store, processed_at))


def run_events(spark: SparkSession, store: LandingStore, processed_at: str) -> DataFrame:
    events = read_table_or_none(spark, f"{store.logs}/manifest")
    if events is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return events.filter(F.col("processed_at") == processed_at)


def _log(spark: SparkSession, store: LandingStore, files: DataFrame, cells: DataFrame, rows: DataFrame, processed_at: str) -> None:
    """One event per workbook: its sheets and outputs, rows by both counts, and all its errors."""
    written = rows.groupBy("file_path", "sheet_name", FOLDER, SHEET).agg(F.count(F.lit(1)).alias("written"))
    counted = workbooks.landing_counts(cells).select("file_path", "sheet_name", "data_rows")
    sheets = counted.join(written, ["file_path", "sheet_name"], "left").withColumn("output", _output(FOLDER, SHEET))
    done = sheets.groupBy("file_path").agg(
        F.array_sort(F.collect_list("sheet_name")).alias("sheets_processed"), F.array_sort(F.collect_list("output")).alias("output_files"),
        F.sum("data_rows").alias("excel_row_count"), F.sum(F.coalesce("written", F.lit(0))).alias("parquet_row_count"))
    errors = workbooks.ingest_errors(cells).groupBy("file_path").agg(
        F.array_join(F.array_sort(F.collect_set(F.concat_ws(": ", "sheet_name", "error_message"))), "; ").alias("error_message"))
    none = F.array().cast("array<string>")
    events = files.join(done, "file_path", "left").join(errors, "file_path", "left").select(
        "file_path", "file_hash", "last_modified", F.when(F.col("error_message").isNull(), SUCCESS).otherwise(FAILED).alias("status"), "error_message",
        F.coalesce("sheets_processed", none).alias("sheets_processed"), F.coalesce("output_files", none).alias("output_files"),
        F.coalesce("excel_row_count", F.lit(0)).alias("excel_row_count"), F.coalesce("parquet_row_count", F.lit(0)).alias("parquet_row_count"),
        F.lit(processed_at).alias("processed_at"), F.lit(False).alias("deleted"))
    write_batch(events.withColumn("run", F.md5(F.lit(processed_at))), f"{store.logs}/manifest", ("run",))


def delete_orphans(spark: SparkSession, root: str, store: LandingStore, processed_at: str) -> DataFrame:
    """Delete, in tasks, the outputs of workbooks that are gone; returns a log row for each output.

    The log is written with the deletion. The workbooks leave the manifest after it, those with an output
    that could not be deleted stay for the next run.
    """
    held = manifest(spark, store)
    listing = fingerprints(spark, root, WORKBOOK_GLOB)
    run = F.md5(F.lit(f"orphans {processed_at}"))
    orphans = orphaned_outputs(held, listing).withColumn("uri", F.concat(F.lit(f"{store.tables}/"), "output_file"))
    log = delete_listed(orphans).drop("uri").withColumns({"processed_at": F.lit(processed_at), "run": run})
    write_batch(log, f"{store.logs}/orphans", ("run",))
    logged = read_table_or_none(spark, f"{store.logs}/orphans")
    if logged is None:
        logged = spark.createDataFrame([], "file_path string, output_file string, deleted boolean, error_message string, processed_at string")
    logged = logged.filter(F.col("processed_at") == processed_at)
    left = held.join(listing.select("file_path"), "file_path", "left_anti").join(logged.filter(~F.col("deleted")), "file_path", "left_anti")
    events = left.withColumns({"processed_at": F.lit(processed_at), "deleted": F.lit(True)})
    write_batch(events.withColumn("run", run), f"{store.logs}/manifest", ("run",))
    return logged.select("file_path", "output_file", "deleted", "error_message", "processed_at")


def clean_orphans(spark: SparkSession, root: str, store: LandingStore, processed_at: str) -> list[str]:
    """Paths of the outputs that ``delete_orphans`` deleted; for small landings."""
    log = delete_orphans(spark, root, store, processed_at)
    return [f"{store.tables}/{row.output_file}" for row in log.filter("deleted").collect()]


def read_landed(spark: SparkSession, store: LandingStore, output: str) -> DataFrame:
    """Rows of one landed sheet, by its name in the manifest."""
    return spark.read.parquet(f"{store.tables}/{output}")


def reconciliation(manifests: list[DataFrame]) -> DataFrame:
    """Workbooks whose rows and written rows differ."""
    both = reduce(DataFrame.unionByName, manifests)
    return both.select("file_path", "excel_row_count", "parquet_row_count").filter("excel_row_count <> parquet_row_count")
