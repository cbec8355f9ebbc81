"""File-level silver run: each changed bronze file standardised into a zstd tree, with a manifest.

Files are standardised one by one, because types are judged by the values of a file. Each is a job of its
own; its output folder has the file's relative path, so a rerun replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.naming import relative_path
from tillstone.operators.manifest import FAILED, SUCCESS, files_to_process, latest
from tillstone.operators.standardize import STEPS_BASIC, standardize
from tillstone.plans.bronze import write_batch
from tillstone.sources.files import fingerprints, readable
from tillstone.sources.sinks import SILVER_CODEC, read_table_or_none, write_tree

MANIFEST_SCHEMA = (
    "file_path string, file_hash string, output_path string, status string, row_count bigint, column_count int, "
    "transformations_applied array<string>, error_message string, processed_at string"
)


def manifest(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest event of each file."""
    events = read_table_or_none(spark, log_path)
    if events is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest(events.drop("run"), ["file_path"], ["processed_at"])


def run_silver_files(
    spark: SparkSession, root: str, target: str, log_path: str, processed_at: str, steps: Sequence[str] = STEPS_BASIC
) -> DataFrame:
    """Standardise files that are new or changed since their last success; returns the run's events.

    A file that fails is logged as FAILED and does not stop the others.
    """
    done = manifest(spark, log_path).filter(F.col("status") == SUCCESS)
    todo = files_to_process(fingerprints(spark, root), done, by=("file_hash",))
    events = []
    for file in todo.select("file_path", "uri", "file_hash", relative_path(F.col("file_path"), root).alias("relative")).toLocalIterator():
        output = f"{target}/{file.relative}"
        row = [file.file_path, file.file_hash, output, FAILED, None, None, None, None, processed_at]
        try:
            rows, applied = standardize(spark.read.parquet(*readable([file.uri])), file.file_path, processed_at, steps)
            seen = Observation()
            write_tree(rows.observe(seen, F.count(F.lit(1)).alias("rows")), output, codec=SILVER_CODEC)
            row[3:7] = [SUCCESS, seen.get["rows"], len(rows.columns), applied]
        except Exception as error:
            row[7] = str(error)
        events.append(tuple(row))
    frame = spark.createDataFrame(events, MANIFEST_SCHEMA)
    write_batch(frame.withColumn("run", F.md5(F.lit(processed_at))), log_path, ("run",))
    return frame
