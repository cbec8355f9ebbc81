"""Data-quality monitors: whitespace, credit notes, and the issue log."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.naming import quoted

# Issue types and the two-character text the monitors look for as a "tab".
TRAILING_WHITESPACE = "TRAILING_WHITESPACE"
POTENTIAL_DUPLICATES = "POTENTIAL_DUPLICATES"
DUPLICATES_REMOVED = "DUPLICATES_REMOVED"
TAB_TEXT = r"\t"
SAMPLE_SIZE = 5

ISSUE_SCHEMA = (
    "process_id int, table_name string, column_name string, issue_type string, "
    "issue_description string, affected_rows bigint, sample_data string, logged_at timestamp_ntz"
)


def string_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]


def has_outer_whitespace(value: Column, real_tabs: bool = False) -> Column:
    marks = [" ", "\t" if real_tabs else TAB_TEXT]
    tests = [test for mark in marks for test in (value.startswith(mark), value.endswith(mark))]
    return tests[0] | tests[1] | tests[2] | tests[3]


def _outer_whitespace(batches: Iterator[pa.RecordBatch], marks: Sequence[str], n: int) -> Iterator[pa.RecordBatch]:
    """One row for each column of a task: name, offending cells, the ``n`` smallest different ones."""
    counts: dict[str, int] = {}
    smallest: dict[str, pa.Array] = {}
    for batch in batches:
        for name, values in zip(batch.schema.names, batch.columns, strict=True):
            tests = [test(values, pattern=mark) for mark in marks for test in (pc.starts_with, pc.ends_with)]
            dirty = values.filter(pc.fill_null(reduce(pc.or_, tests), False))
            if not len(dirty):
                continue
            counts[name] = counts.get(name, 0) + len(dirty)
            held = smallest.get(name)
            if held is not None and len(held) == n:
                dirty = dirty.filter(pc.less(dirty, held[n - 1]))
            if len(dirty):
                merged = dirty.unique() if held is None else pa.concat_arrays([held, dirty]).unique()
                smallest[name] = merged.take(pc.array_sort_indices(merged)[:n])
    names = list(counts)
    yield pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()), pa.array([counts[c] for c in names], pa.int64()),
        pa.array([smallest[c].to_pylist() for c in names], pa.list_(pa.string())),
    ], names=["column_name", "n", "smallest"])


def whitespace_profile(df: DataFrame, columns: Sequence[str] | None = None, real_tabs: bool = False) -> DataFrame:
    """Rows with leading or trailing whitespace per string column, with the first few such values.

    One pass: each task keeps a count and the smallest ``SAMPLE_SIZE`` different values of a column, so
    what is shuffled depends on tasks and columns and not on the number of offending cells. Columns
    without offending cells are left out.
    """
    names = list(columns) if columns is not None else string_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, affected_rows bigint, sample_data string")
    marks = [" ", "\t" if real_tabs else TAB_TEXT]
    # columns travel by number, because a name may hold any character and may differ from others by case only
    cells = df.select(*[F.col(quoted(name)).cast("string").alias(f"c{i}") for i, name in enumerate(names)])
    found = cells.mapInArrow(lambda batches: _outer_whitespace(batches, marks, SAMPLE_SIZE), "column_name string, n bigint, smallest array<string>")
    values = found.select("column_name", "n", F.posexplode("smallest").alias("place", "value"))
    # a task's count goes with its first value, so that one shuffle brings both
    counted = values.groupBy("column_name", "value").agg(F.sum(F.when(F.col("place") == 0, F.col("n")).otherwise(F.lit(0))).alias("n"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    profile = counted.withColumn("rank", rank).groupBy("column_name").agg(
        F.sum("n").alias("affected_rows"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("rank") <= SAMPLE_SIZE, F.col("value")))), ", ").alias("sample_data"))
    listed = F.element_at(F.array(*[F.lit(name) for name in names]), F.substring("column_name", 2, 10).cast("int") + 1)
    return profile.withColumn("column_name", listed)


def credit_note_counts(df: DataFrame, count_zero: bool = True) -> DataFrame:
    """All rows, and rows that look like credit notes (with zero amounts or without)."""
    amount = F.col("AMOUNT").try_cast("double")
    credit = F.col("DOCUMENT_NUMBER").startswith("CN") | (amount < 0)
    if count_zero:
        credit = credit | (amount == 0)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(credit).alias("credit_notes")
    )


def issue_rows(
    profile: DataFrame, process_id: int, table_name: str, logged_at: str
) -> DataFrame:
    """Issue-log rows for a whitespace profile."""
    rows = F.col("affected_rows")
    return profile.select(
        F.lit(process_id).cast("int").alias("process_id"),
        F.lit(table_name).alias("table_name"),
        "column_name",
        F.lit(TRAILING_WHITESPACE).alias("issue_type"),
        F.format_string("%d rows begin or end with white space", rows).alias("issue_description"),
        rows.cast("bigint").alias("affected_rows"),
        "sample_data",
        F.lit(logged_at).cast("timestamp_ntz").alias("logged_at"),
    )


def duplicate_issue(
    groups: DataFrame, process_id: int, table_name: str, logged_at: str, removed: bool = False
) -> DataFrame:
    """Issue-log row for a duplicate count; no row when nothing was found."""
    count = F.col(groups.columns[0])
    kind = DUPLICATES_REMOVED if removed else POTENTIAL_DUPLICATES
    text = "%d later rows of repeated keys left out" if removed else "%d keys occur more than once"
    return groups.filter(count > 0).select(
        F.lit(process_id).cast("int").alias("process_id"),
        F.lit(table_name).alias("table_name"),
        F.lit("ALL").alias("column_name"),
        F.lit(kind).alias("issue_type"),
        F.format_string(text, count).alias("issue_description"),
        count.cast("bigint").alias("affected_rows"),
        F.lit("").alias("sample_data"),
        F.lit(logged_at).cast("timestamp_ntz").alias("logged_at"),
    )
