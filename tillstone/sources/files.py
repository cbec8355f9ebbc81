"""Scans of file trees: rows with their file, listings, fingerprints, row counts and schemas."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.naming import source_path, strip_scheme

PARQUET_GLOB = "*.parquet"
WORKBOOK_GLOB = "*.{xls,xlsx,xlsm,xlsb}"
# Spark puts a file up to this size in one row to hash it; a larger one is read by blocks in a task.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 8 * 1024 * 1024
FILES_PER_READ = 10_000

LISTING_SCHEMA = "file_path string, uri string, file_size bigint, last_modified timestamp"
SCHEMA_LISTING = "file_path string, position int, column_name string, data_type string, error_message string"


def _missing_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


def _listing_columns() -> list[Column]:
    return [
        strip_scheme(F.col("path")).alias("file_path"),
        F.col("path").alias("uri"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("last_modified"),
    ]


def scan_tree(
    spark: SparkSession,
    root: str | Sequence[str],
    glob: str = PARQUET_GLOB,
    schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame | None:
    """All Parquet rows below ``root`` with ``source_file_path``; None where there is nothing to read.

    Columns are the union over all files.
    """
    roots = [root] if isinstance(root, str) else list(root)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    reader = reader.option("ignoreCorruptFiles", skip_corrupt)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    try:
        rows = reader.parquet(*roots)
    except AnalysisException as error:
        if _missing_path(error):
            return None
        raise
    return rows.select("*", source_path().alias("source_file_path"))


def scan_sound(spark: SparkSession, root: str, glob: str = PARQUET_GLOB) -> tuple[DataFrame | None, DataFrame]:
    """Rows of all files below ``root`` whose footers can be read, and an error row for every other file."""
    listing = list_files(spark, root, glob)
    schemas = file_schemas(listing)
    errors = schemas.filter(F.col("error_message").isNotNull()).select("file_path", "error_message")
    # the paths of a read are on the driver anyway, in Spark's file index
    sound = [r.uri for r in listing.join(errors, "file_path", "left_anti").select("uri").collect()]
    if not sound:
        return None, errors
    rows = spark.read.option("mergeSchema", True).parquet(*readable(sound))
    return rows.select("*", source_path().alias("source_file_path")), errors


def list_files(spark: SparkSession, root: str | Sequence[str], glob: str = PARQUET_GLOB) -> DataFrame:
    """Path, size and modification time of each file; no file is opened."""
    roots = [root] if isinstance(root, str) else list(root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    try:
        files = reader.load(roots)
    except AnalysisException as error:
        if _missing_path(error):
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    return files.select(*_listing_columns())


def settled(listing: DataFrame, now: str | Column, delay_seconds: int = 30) -> DataFrame:
    """Files last written at least ``delay_seconds`` before ``now``; younger ones may be incomplete."""
    cutoff = (F.lit(now) if isinstance(now, str) else now).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_seconds))
    return listing.filter(F.col("last_modified") <= cutoff)


def store_of(uri: str):
    """The store of a listed file or folder and its path there, for use inside a task."""
    import pyarrow.fs as fs

    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, _, rest = re.sub("^s3[an]:", "s3:", uri).partition(":")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def open_file(uri: str):
    """A listed file for reading by blocks or at random, from inside a task."""
    system, inner = store_of(uri)
    return system.open_input_file(inner)


def create_file(uri: str):
    """A new file for writing from inside a task, in place of one that is there."""
    system, inner = store_of(uri)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner)


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs as fs

    for batch in batches:
        gone, errors = [], []
        for uri in batch["uri"].to_pylist():
            error = None
            try:
                system, inner = store_of(uri)
                kind = system.get_file_info(inner).type
                if kind == fs.FileType.Directory:
                    system.delete_dir(inner)
                elif kind == fs.FileType.File:
                    system.delete_file(inner)
            except Exception as failed:
                error = str(failed)
            gone.append(error is None)
            errors.append(error)
        yield batch.append_column("deleted", pa.array(gone, pa.bool_())).append_column("error_message", pa.array(errors, pa.string()))


def delete_listed(paths: DataFrame) -> DataFrame:
    """Delete the files and folders in column ``uri``, in tasks; adds whether they are gone and the error.

    What is not there counts as gone, so a task that is run again says the same.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in paths.schema.fields)
    return paths.mapInArrow(_delete, f"{schema}, deleted boolean, error_message string")


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for uri in batch["uri"].to_pylist():
            digest = hashlib.md5()
            with open_file(uri) as handle:
                while block := handle.read(BLOCK_BYTES):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield batch.append_column("file_hash", pa.array(found, pa.string()))


def fingerprints(spark: SparkSession, root: str, glob: str = PARQUET_GLOB, whole: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Listing with the MD5 of each file's bytes, whatever its size."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if _missing_path(error):
            return spark.createDataFrame([], LISTING_SCHEMA + ", file_hash string")
        raise
    columns = _listing_columns()
    hashed = files.filter(F.col("length") <= whole).select(*columns, F.md5("content").alias("file_hash"))
    large = files.filter(F.col("length") > whole).select(*columns).mapInArrow(_hash_blocks, LISTING_SCHEMA + ", file_hash string")
    return hashed.unionByName(large)


def readable(uris: Sequence[str]) -> list[str]:
    """Paths for a Parquet reader, with the characters it would take for a pattern escaped."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", uri) for uri in uris]


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for uri, path in zip(batch["uri"].to_pylist(), batch["file_path"].to_pylist()):
            try:
                with open_file(uri) as handle:
                    for _ in pq.ParquetFile(handle).iter_batches():
                        pass
            except Exception as error:
                rows.append((path, str(error)))
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["file_path", "error_message"])


def damaged_files(files: DataFrame) -> DataFrame:
    """Listed files whose rows cannot all be read, with the error; each is read by itself in a task."""
    return files.select("uri", "file_path").mapInArrow(_read_whole, "file_path string, error_message string")


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per source file of a scan; no data column is read."""
    if "source_file_path" in df.columns:
        path = F.col("source_file_path")
    else:
        path = source_path()
    return df.groupBy(path.alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))


def read_with_row_id(spark: SparkSession, path: str, row_id: tuple[str, str] = ("_row_file", "_row_index")) -> DataFrame:
    """A Parquet table with the file and position of every row, the same on every read."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.select(
        "*", F.col("_metadata.file_path").alias(row_id[0]), F.col("_metadata.row_index").alias(row_id[1])
    )


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Column names and types from Parquet footers; an unreadable file becomes one error row."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    for batch in batches:
        rows = []
        for uri, path in zip(batch["uri"].to_pylist(), batch["file_path"].to_pylist()):
            try:
                with open_file(uri) as handle:
                    schema = pq.read_schema(handle)
                for position, field in enumerate(schema):
                    kind = from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
                    rows.append((path, position, field.name, kind, None))
            except Exception as error:
                rows.append((path, None, None, None, str(error)))
        names = ["file_path", "position", "column_name", "data_type", "error_message"]
        types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
        columns = zip(*rows) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(values), kind) for values, kind in zip(columns, types)], names
        )


def file_schemas(files: DataFrame) -> DataFrame:
    """Columns of every listed Parquet file, read from footers on the executors."""
    listed = files.select("uri", "file_path")
    return listed.mapInArrow(_footers, SCHEMA_LISTING)


def schema_groups(schemas: DataFrame, files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Listed files that share a schema (and ``by``), with the first path of each group.

    Files of a schema are spread over groups of about ``FILES_PER_READ``, so no task gathers an
    unbounded list of paths and each group is one read.
    """
    spread = max(1, math.ceil(files.count() / FILES_PER_READ))
    column = F.struct("position", "column_name", "data_type")
    per_file = schemas.filter(F.col("error_message").isNull()).groupBy("file_path").agg(
        F.array_sort(F.collect_list(column)).alias("columns")
    )
    listed = per_file.join(files.select("file_path", "uri", *by), "file_path")
    part = F.pmod(F.xxhash64("file_path"), F.lit(spread))
    return listed.groupBy(*by, "columns", part.alias("part")).agg(
        F.min("file_path").alias("first_path"), F.collect_list("uri").alias("uris")
    )


def group_schema(columns: Sequence[T.Row]) -> T.StructType:
    """The schema of a group from its (position, name, type) rows."""
    return T.StructType.fromDDL(", ".join(f"`{c.column_name}` {c.data_type}" for c in columns))
