"""Duplicate detection that holds when one key covers a large share of the rows.

A window partitioned by the key sorts each group in one task, so nothing here flags rows through a
plain window. Groups are reduced by partial aggregation before any shuffle, and rows are matched
to their group's first row on a row identity, which spreads evenly over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.session import working_folder
from tillstone.sources.sinks import write_tree

_COPIES = "__copies"
_IDENTITY = ("__identity_a", "__identity_b")
_FIRST = "__first"
# Copies of one row that come out of one array.
_PIECE = 1 << 16
# Rows that a bitmap of Spark covers, and how many bitmaps are broadcast.
_BITS, _BIT_PIECES = 1 << 15, 1 << 14
_PLACE = "__piece"


def _sortable(columns: Sequence[str]) -> list[Column]:
    """Struct members that order ascending with NULL last, as the invoice exports were ordered."""
    members = []
    for index, name in enumerate(columns):
        members.append(F.col(name).isNull().alias(f"n{index}"))
        members.append(F.col(name).alias(f"v{index}"))
    return members


def row_identity(columns: Sequence[str]) -> list[Column]:
    """128-bit digest of the named columns as two numbers.

    The two hashes start from different seeds. NULL marks are hashed as well, because the hash
    passes over NULL values.
    """
    marked = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *marked).alias(name) for seed, name in enumerate(_IDENTITY)]


def _flag_distinct_rows(
    df: DataFrame, keys: dict[str, Column], order: Sequence[str], identity: Sequence[str], flag: str
) -> DataFrame:
    marked = df.select("*", *row_identity(identity))
    rank = F.struct(*_sortable(order), *_IDENTITY)
    ranked = marked.select(*[key.alias(name) for name, key in keys.items()], rank.alias(_FIRST))
    firsts = ranked.groupBy(*keys).agg(F.min(_FIRST).alias(_FIRST))
    firsts = firsts.select(*[F.col(f"{_FIRST}.{name}").alias(name) for name in _IDENTITY], F.lit(0).alias(flag))
    flagged = marked.join(firsts, list(_IDENTITY), "left")
    return flagged.select(*df.columns, F.coalesce(F.col(flag), F.lit(1)).alias(flag))


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str] | dict[str, Column],
    order: Sequence[str],
    row_id: Sequence[str] | None = None,
    flag: str = "potential_duplicate_flag",
) -> DataFrame:
    """Add 0 to the first row of each key group and 1 to every later row. No row is dropped.

    ``keys`` are column names, or expressions by name when the key is derived; only the derived
    keys and the order are grouped, the rows themselves are shuffled once and as they are.
    ``row_id`` names columns that identify a row; ties in ``order`` fall to it. Without it, exact
    copies are first folded into one row and a count, so even a group of identical rows that makes
    up much of the table is never gathered in one task.
    """
    if row_id is not None:
        return _flag_distinct_rows(df, _by_name(keys), order, row_id, flag)
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    flagged = _flag_distinct_rows(folded, _by_name(keys), order, df.columns, flag)
    # copies come back in pieces of bounded size, so that no array grows with a group
    full = F.floor(F.col(_COPIES) / _PIECE)
    pieced = flagged.withColumn(_FIRST, F.explode(F.sequence(F.lit(0).cast("bigint"), full)))
    size = F.least(F.lit(_PIECE).cast("bigint"), F.col(_COPIES) - F.col(_FIRST) * _PIECE).cast("int")
    first = F.when(F.col(_FIRST) == 0, F.col(flag)).otherwise(F.lit(1))
    flags = F.when(size > 0, F.concat(F.array(first), F.array_repeat(F.lit(1), size - 1))).otherwise(F.array().cast("array<int>"))
    return pieced.withColumn(flag, F.explode(flags)).select(*df.columns, flag)


def flag_by_position(
    df: DataFrame, keys: Sequence[str] | dict[str, Column], order: Sequence[str], position: tuple[str, str],
    flag: str = "potential_duplicate_flag",
) -> DataFrame:
    """``flag_duplicates`` for rows that a file and an index tell apart; ties in ``order`` fall to these.

    Only keys, order and positions are shuffled. The first rows are written as one bit a row, and the rows
    meet their bits where they are read, so whole rows are neither shuffled nor sorted. Files are told by
    128 bits of their path.
    """
    file, index = position
    names = _by_name(keys)
    rank = F.struct(*_sortable(order), *row_identity([file]), F.col(index).alias(index))
    ranked = df.select(*[key.alias(name) for name, key in names.items()], rank.alias(_FIRST))
    firsts = ranked.groupBy(*names).agg(F.min(_FIRST).alias(_FIRST))
    firsts = firsts.select(*[F.col(f"{_FIRST}.{name}").alias(name) for name in (*_IDENTITY, index)])
    bits = _position_bits(df.sparkSession, firsts, _IDENTITY, index)
    marked = df.select("*", *row_identity([file]), _piece(index)).join(bits, [*_IDENTITY, _PLACE], "left")
    return marked.select(*df.columns, F.when(_has_bit(index), 0).otherwise(1).alias(flag))


def _by_name(keys: Sequence[str] | dict[str, Column]) -> dict[str, Column]:
    return keys if isinstance(keys, dict) else {name: F.col(name) for name in keys}


def dedup_keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], newest_first: bool = False
) -> DataFrame:
    """First row of each key group; ties fall to the remaining columns, so the survivor is fixed.

    The ``== 1`` filter lets Spark drop all but one row per key before the shuffle, which keeps a
    group that fills a third of the table down to one row per map task.
    """
    orderable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    tiebreak = [name for name in orderable if name not in set(keys) | set(order)]
    leading = [F.col(n).desc_nulls_last() if newest_first else F.col(n).asc_nulls_last() for n in order]
    window = Window.partitionBy(*keys).orderBy(*leading, *[F.col(n).asc_nulls_last() for n in tiebreak])
    ranked = df.withColumn(_FIRST, F.row_number().over(window))
    return ranked.filter(F.col(_FIRST) == 1).drop(_FIRST)


def dedup_by_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: tuple[str, str]
) -> DataFrame:
    """First row of each key group, for rows that a file and an index tell apart; ties fall to these.

    Only keys, order and positions are shuffled. The positions that stay are written as one bit a row, and
    the rows meet them where they are read. Up to ``_BIT_PIECES`` pieces are broadcast, 64 MB for 500
    million rows; beyond that Spark joins by shuffle.
    """
    file, index = position
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*_sortable([*order, file, index]))).alias(_FIRST))
    first_file, first_index = (F.col(f"{_FIRST}.v{len(order) + place}") for place in (0, 1))
    bits = _position_bits(df.sparkSession, firsts.select(first_file.alias(file), first_index.alias(index)), [file], index)
    marked = df.select("*", _piece(index)).join(bits, [file, _PLACE])
    return marked.filter(_has_bit(index)).select(*df.columns)


def _piece(index: str) -> Column:
    return F.floor(F.col(index) / _BITS).alias(_PLACE)


def _position_bits(spark: SparkSession, rows: DataFrame, file: Sequence[str], index: str) -> DataFrame:
    """One bit for each position in ``rows``, in pieces of a file; written, and marked for broadcast up to ``_BIT_PIECES``."""
    bits = rows.groupBy(*file, _piece(index)).agg(F.bitmap_construct_agg(F.pmod(F.col(index), F.lit(_BITS))).alias("__bits"))
    path = working_folder(spark, "positions")
    write_tree(bits, path)
    bits = spark.read.parquet(path)
    return F.broadcast(bits) if bits.count() <= _BIT_PIECES else bits


def _has_bit(index: str) -> Column:
    """Whether the piece of a row has the bit of its index; NULL where there is no piece."""
    place = F.pmod(F.col(index), F.lit(_BITS))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COPIES))
    repeated = groups.filter(F.col(_COPIES) > 1)
    return repeated.agg(F.count(F.lit(1)).alias("potential_duplicate_count"))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL counts as a key value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COPIES))
    return groups.agg(F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.distinct()


def distinct_row_counts(df: DataFrame) -> DataFrame:
    """Rows before and after a full-row distinct, from one aggregation."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    return groups.agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
