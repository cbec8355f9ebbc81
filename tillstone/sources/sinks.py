"""Writers: Parquet trees, warehouse loads, CSV exports, manifests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values.
LANDING_CODEC = "snappy"
SILVER_CODEC = "zstd"
SILVER_ZSTD_LEVEL = "3"
CORRUPT_LINE = "corrupt_line"
OPEN_FILES = 8
# Settings of a write: its shuffle files go when it ends, not when the driver next collects its garbage, and
# wide projections are made of methods that the JVM compiles.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}
APPEND, TRUNCATE, EMPTY = "WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"


def write_tree(
    df: DataFrame, path: str, codec: str = LANDING_CODEC, partitions: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet below ``path``, one folder per value of each partition column."""
    writer = df.write.mode(mode).option("compression", codec)
    if codec == SILVER_CODEC:
        writer = writer.option("parquet.compression.codec.zstd.level", SILVER_ZSTD_LEVEL)
    if partitions:
        writer = writer.partitionBy(*partitions)
    with tidy(df.sparkSession):
        writer.parquet(path)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str | int]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def unsorted_partitions(spark: SparkSession, files: int = OPEN_FILES):
    """Partitioned writes keep up to ``files`` files open in a task, and sort only rows of further partitions."""
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": files})


def tidy(spark: SparkSession):
    """Jobs run with ``WRITE_CONF``. Do not evaluate one DataFrame twice inside: its shuffles would be made again."""
    return _settings(spark, WRITE_CONF)


def read_table_or_none(spark: SparkSession, path: str, merge: bool = True) -> DataFrame | None:
    """A Parquet table, or None when it was never written. ``merge`` reads the columns of all files, else of one."""
    try:
        return spark.read.option("mergeSchema", merge).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def load_table(df: DataFrame, path: str, disposition: str = APPEND) -> None:
    """Append to, replace, or first-fill a table."""
    spark = df.sparkSession
    if disposition == EMPTY:
        existing = read_table_or_none(spark, path)
        if existing is not None and not existing.isEmpty():
            raise ValueError(f"{path} already holds rows")
    modes = {APPEND: "append", TRUNCATE: "overwrite", EMPTY: "overwrite"}
    if disposition not in modes:
        raise ValueError(f"unknown write disposition {disposition}")
    write_tree(df, path, mode=modes[disposition])


def delete_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Delete files or folders in whatever store they are; returns those that were there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    gone = []
    for path in paths:
        target = hadoop.fs.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True):
            gone.append(path)
    return gone


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to a path, in place of what is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    old, new = hadoop.fs.Path(source), hadoop.fs.Path(target)
    system = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    system.delete(new, False)
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def export_csv(df: DataFrame, path: str, n: int | None = None) -> None:
    """CSV with a header; the first ``n`` rows of an ordered frame when given."""
    rows = df if n is None else df.limit(n)
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_state_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Manifest rows from JSON lines; a missing file gives an empty manifest.

    A line that is not valid is kept whole in ``corrupt_line``, with NULL in the other columns.
    """
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = T.StructType([*columns.fields, T.StructField(CORRUPT_LINE, T.StringType())])
    try:
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_LINE).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def write_state_json(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)
