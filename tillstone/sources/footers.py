"""File pruning by the statistics in Parquet footers, before a file is given to a read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.sources.files import list_files, open_file, readable

STATISTICS = ("file_path string, uri string, row_group int, rows bigint, column_name string, nulls bigint, "
              "least string, largest string, error_message string")
_NAMES = [part.strip().split(" ")[0] for part in STATISTICS.split(",")]
_KINDS = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _text(value: object) -> str | None:
    """A bound as text that Spark casts back; a binary or odd one is left out, which prunes nothing."""
    return None if value is None or isinstance(value, bytes) or value != value else str(value)


def _footer_rows(uri: str, path: str) -> Iterator[tuple]:
    import pyarrow.parquet as pq

    try:
        with open_file(uri) as handle:
            footer = pq.read_metadata(handle)
        if not footer.num_row_groups:
            yield path, uri, None, 0, None, None, None, None, None
        for number in range(footer.num_row_groups):
            group = footer.row_group(number)
            for place in range(group.num_columns):
                column = group.column(place)
                held = column.statistics
                bounds = (held.min, held.max) if held is not None and held.has_min_max else (None, None)
                nulls = held.null_count if held is not None and held.has_null_count else None
                yield path, uri, number, group.num_rows, column.path_in_schema, nulls, *map(_text, bounds), None
    except Exception as error:
        yield path, uri, None, None, None, None, None, None, str(error)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row for uri, path in zip(batch["uri"].to_pylist(), batch["file_path"].to_pylist(), strict=True) for row in _footer_rows(uri, path)]
        columns = list(zip(*rows, strict=True)) or [()] * len(_KINDS)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def file_statistics(listing: DataFrame) -> DataFrame:
    """Rows, nulls and bounds of each column of each row group, read from footers in tasks."""
    return listing.select("uri", "file_path").mapInArrow(_read_footers, STATISTICS)


def files_that_may_hold(statistics: DataFrame, column: str, data_type: str, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """(file_path, uri) of the files with a row group that may hold a value from ``low`` to ``high``, both included.

    A row group without bounds may hold anything, one with nulls only holds nothing, and a file without
    the column has no such value. A file whose footer can't be read stays, so that the read says why.
    """
    own = F.col("column_name") == column
    least, largest = F.col("least").try_cast(data_type), F.col("largest").try_cast(data_type)
    inside = F.lit(True)
    if low is not None:
        inside = inside & F.coalesce(largest >= low, F.lit(True))
    if high is not None:
        inside = inside & F.coalesce(least <= high, F.lit(True))
    only_nulls = (F.col("rows") == 0) | F.coalesce(F.col("nulls") == F.col("rows"), F.lit(False))
    chosen = statistics.filter((own & ~only_nulls & inside) | F.col("error_message").isNotNull())
    return chosen.select("file_path", "uri").distinct()


def read_between(
    spark: SparkSession, root: str, column: str, low: str, high: str, data_type: str
) -> tuple[DataFrame | None, DataFrame]:
    """Rows with ``column`` from ``low`` to ``high``, and for each listed file whether it was read.

    The paths that are read are named on the driver, where Spark's file index holds them anyway.
    """
    listing = list_files(spark, root)
    bounds = [F.lit(v).cast(data_type) for v in (low, high)]
    chosen = files_that_may_hold(file_statistics(listing), column, data_type, *bounds)
    uris = [row.uri for row in chosen.select("uri").collect()]
    used = listing.select("file_path", "file_size", F.col("uri").isin(uris).alias("was_read")) if uris else listing.select(
        "file_path", "file_size", F.lit(False).alias("was_read"))
    if not uris:
        return None, used
    rows = spark.read.option("mergeSchema", True).parquet(*readable(uris))
    return rows.filter(F.col(column).between(*bounds)), used
