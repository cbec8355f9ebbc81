"""Warehouse upload: new and changed files into one table each, with an upload log.

Every table is a folder of its own, and every group of files a load writes is a partition of it, named by
the load and the group's columns; a load that is run again replaces what it wrote. The log holds events,
and its view is the latest event of each file, so a cut-off run never loses it.
"""

from __future__ import annotations

import hashlib
import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.naming import source_path, warehouse_table_name
from tillstone.operators.manifest import FAILED, NEW, SUCCESS, UNCHANGED, classify_files, latest
from tillstone.plans.bronze import write_batch
from tillstone.session import working_folder
from tillstone.sources.files import damaged_files, file_schemas, fingerprints, group_schema, readable, schema_groups
from tillstone.sources.sinks import APPEND, EMPTY, TRUNCATE, delete_paths, read_table_or_none

SKIPPED = "SKIPPED"
TABLE, LOAD = "__table", "__load"
LOG_SCHEMA = (
    "file_path string, file_hash string, file_size bigint, table_name string, processed_at timestamp_ntz, "
    "status string, records_processed bigint, error_message string, processing_time_seconds double"
)


def table_path(warehouse: str, table: str) -> str:
    return f"{warehouse}/{TABLE}={table}"


def read_uploaded(spark: SparkSession, warehouse: str, table: str) -> DataFrame | None:
    """Rows of one warehouse table, columns by name over all its loads."""
    rows = read_table_or_none(spark, table_path(warehouse, table))
    return None if rows is None else rows.drop(LOAD)


def upload_log(spark: SparkSession, log_path: str) -> DataFrame | None:
    """Latest event of each file."""
    events = read_table_or_none(spark, log_path)
    if events is None:
        return None
    held = events.filter(F.col("status") != SKIPPED).drop("run")
    return latest(held, ["file_path"], ["processed_at"])


def upload_plan(
    spark: SparkSession, root: str, log: DataFrame | None, prefix: str | None = None, incremental: bool = True
) -> DataFrame:
    """Every file with its table and whether it is new, changed or unchanged since its last success."""
    listing = fingerprints(spark, root)
    listing = listing.withColumn("table_name", warehouse_table_name(F.col("file_path"), prefix))
    if log is None or not incremental:
        return listing.withColumn("state", F.lit(NEW))
    return classify_files(listing, log.filter(F.col("status") == SUCCESS), by=("file_hash", "file_size"))


def _failed(files: DataFrame, message: F.Column) -> DataFrame:
    return files.select("file_path", F.lit(0).cast("bigint").alias("records_processed"), message.alias("error_message"),
                        F.lit(0.0).alias("processing_time_seconds"))


def _write_group(spark: SparkSession, group, warehouse: str, prefix: str | None, load: str) -> DataFrame:
    started = time.time()
    frame = spark.read.option("recursiveFileLookup", True).schema(group_schema(group.columns)).parquet(*readable(group.uris))
    rows = frame.select("*", warehouse_table_name(source_path(), prefix).alias(TABLE), F.lit(load).alias(LOAD))
    write_batch(rows, warehouse, (TABLE, LOAD))
    counts = frame.groupBy(source_path().alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(
        "file_path", F.col("rows").alias("records_processed"), F.lit(None).cast("string").alias("error_message"),
        F.lit(time.time() - started).alias("processing_time_seconds"),
    )


def upload(
    spark: SparkSession, root: str, warehouse: str, log_path: str, processed_at: str,
    prefix: str | None = None, incremental: bool = True, disposition: str = APPEND,
) -> DataFrame:
    """Load the files that changed and return the upload log's latest events.

    Files that share a schema are read and written in one job. A file that cannot be read is logged as
    FAILED and does not stop the others; one that did not change is logged as SKIPPED for this run. The
    listing with its hashes is written once, so no file is read twice for it.
    """
    if disposition not in (APPEND, TRUNCATE, EMPTY):
        raise ValueError(f"unknown write disposition {disposition}")
    run = hashlib.md5(processed_at.encode()).hexdigest()
    staged = working_folder(spark, "upload-plan")
    events = read_table_or_none(spark, log_path)
    before = None if events is None else latest(events.filter((F.col("run") != run) & (F.col("status") != SKIPPED)).drop("run"), ["file_path"], ["processed_at"])
    upload_plan(spark, root, before, prefix, incremental).write.parquet(staged)
    try:
        plan = spark.read.parquet(staged)
        todo = plan.filter(F.col("state") != UNCHANGED).drop("state")
        file_schemas(todo).write.parquet(f"{staged}-schemas")
        schemas = spark.read.parquet(f"{staged}-schemas")
        outcomes = [_failed(schemas.filter(F.col("error_message").isNotNull()), F.col("error_message"))]
        usable = todo
        names = [r[0] for r in todo.select("table_name").distinct().collect()]
        if disposition == EMPTY:
            filled = [name for name in names if not _is_empty(spark, warehouse, name)]
            usable = todo.filter(~F.col("table_name").isin(filled)) if filled else todo
            outcomes.append(_failed(todo.filter(F.col("table_name").isin(filled)), F.lit("the table already holds rows")))
        elif disposition == TRUNCATE:
            # a table is emptied once, before any of its groups is written
            delete_paths(spark, [table_path(warehouse, name) for name in names])
        for group in schema_groups(schemas, usable).orderBy("first_path").collect():
            described = ",".join(f"{c.column_name} {c.data_type}" for c in group.columns) + str(group.part)
            load = f"{run}-{hashlib.md5(described.encode()).hexdigest()}"
            try:
                outcomes.append(_write_group(spark, group, warehouse, prefix, load))
            except Exception:
                files = usable.join(spark.createDataFrame([(u,) for u in group.uris], "uri string"), "uri", "left_semi")
                bad = {r.file_path: r for r in damaged_files(files).collect()}
                if not bad:
                    raise
                outcomes.append(_failed(spark.createDataFrame([tuple(r) for r in bad.values()], "file_path string, error_message string"), F.col("error_message")))
                sound = [r.uri for r in files.filter(~F.col("file_path").isin(list(bad))).select("uri").collect()]
                if sound:
                    outcomes.append(_write_group(spark, group.__class__(**{**group.asDict(), "uris": sound}), warehouse, prefix, load))
        outcome = reduce(DataFrame.unionByName, outcomes)
        stamp = F.lit(processed_at).cast("timestamp_ntz").alias("processed_at")
        rows = todo.join(outcome, "file_path", "left").select(
            "file_path", "file_hash", "file_size", "table_name", stamp,
            F.when(F.col("error_message").isNull(), SUCCESS).otherwise(FAILED).alias("status"),
            F.coalesce("records_processed", F.lit(0)).alias("records_processed"),
            "error_message",
            F.coalesce("processing_time_seconds", F.lit(0.0)).alias("processing_time_seconds"),
        )
        skipped = plan.filter(F.col("state") == UNCHANGED).select(
            "file_path", "file_hash", "file_size", "table_name", stamp, F.lit(SKIPPED).alias("status"), F.lit(0).cast("bigint").alias("records_processed"),
            F.lit(None).cast("string").alias("error_message"), F.lit(0.0).alias("processing_time_seconds"))
        write_batch(rows.unionByName(skipped).withColumn("run", F.lit(run)), log_path, ("run",))
    finally:
        delete_paths(spark, [staged, f"{staged}-schemas"])
    found = upload_log(spark, log_path)
    return spark.createDataFrame([], LOG_SCHEMA) if found is None else found


def _is_empty(spark: SparkSession, warehouse: str, table: str) -> bool:
    """Whether a table has no row; its loads are not merged for this, so their types may differ."""
    try:
        return spark.read.parquet(table_path(warehouse, table)).isEmpty()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return True
        raise


def run_events(spark: SparkSession, log_path: str, processed_at: str) -> DataFrame:
    """All events of one run, with files it skipped: the input of run statistics."""
    run = hashlib.md5(processed_at.encode()).hexdigest()
    return spark.read.parquet(log_path).filter(F.col("run") == run).drop("run")
