"""Column and row profiles. Per-column figures of a table come from one aggregation pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.casts import timestamp_from_text
from tillstone.functions.naming import quoted
from tillstone.operators.quality import string_columns

# Texts taken as true and false.
TRUE_TEXTS = ("true", "True", "1", "yes")
FALSE_TEXTS = ("false", "False", "0", "no")


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)]


def _per_column(
    df: DataFrame, columns: Sequence[str], measures: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """One row per column from a one-row aggregate: a struct per column, then exploded."""
    structs = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[measure(F.col(quoted(name))).alias(label) for label, measure in measures.items()],
        ).alias(f"c{index}")
        for index, name in enumerate(columns)
    ]
    one_row = df.agg(*structs)
    return one_row.select(F.inline(F.array(*[f"c{index}" for index in range(len(columns))])))


def null_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    return _per_column(df, names, {
        "null_rows": lambda c: F.count_if(c.isNull()),
        "null_percentage": lambda c: F.round(
            F.coalesce(F.count_if(c.isNull()).cast("double") / F.count(F.lit(1)), F.lit(0.0)) * 100, 6
        ),
    })


def drop_sparse(df: DataFrame, percent: float = 1.0) -> DataFrame:
    """Without the columns whose NULL share is above ``percent``."""
    sparse = null_percentages(df).filter(F.col("null_percentage") > percent)
    return df.drop(*[row.column_name for row in sparse.collect()])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    filled = df.agg(*[F.count(F.col(quoted(name))).alias(name) for name in df.columns]).first().asDict()
    return df.drop(*[name for name, rows in filled.items() if rows == 0])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.filter(reduce(Column.__or__, [F.col(quoted(name)).isNotNull() for name in df.columns]))


def all_zero_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whether every value is 0.0; a NULL makes it false."""
    names = list(columns or numeric_columns(df))
    return _per_column(df, names, {"all_zero": lambda c: F.bool_and(F.coalesce(c == 0, F.lit(False)))})


def drop_if_all_zero(df: DataFrame, columns: Sequence[str] = ("VAT", "DISC")) -> DataFrame:
    """Drop the columns when all of them hold nothing but zeros."""
    zeros = all_zero_columns(df, columns).agg(F.bool_and("all_zero")).first()[0]
    return df.drop(*columns) if zeros else df


def looks_like_date(df: DataFrame, columns: Sequence[str] | None = None, min_share: float = 1.0) -> DataFrame:
    """Text columns whose values read as dates; ``min_share`` of the values present must do so."""
    names = list(columns or string_columns(df))
    profile = _per_column(df, names, {
        "value_rows": lambda c: F.count(c),
        "date_rows": lambda c: F.count(timestamp_from_text(c)),
    })
    enough = (F.col("value_rows") > 0) & (F.col("date_rows") >= F.col("value_rows") * min_share)
    return profile.withColumn("is_date_like", enough)


def looks_like_boolean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or string_columns(df))
    known = [*TRUE_TEXTS, *FALSE_TEXTS]
    return _per_column(df, names, {
        "value_rows": lambda c: F.count(c),
        "is_boolean_like": lambda c: F.coalesce(F.bool_and(c.isin(known)), F.lit(False)),
    })


def boolean_from_text(value: Column) -> Column:
    return F.when(value.isin(*TRUE_TEXTS), True).when(value.isin(*FALSE_TEXTS), False)


def any_negative_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows where at least one number is negative."""
    names = list(columns or numeric_columns(df))
    return df.filter(reduce(Column.__or__, [F.coalesce(F.col(quoted(n)) < 0, F.lit(False)) for n in names]))


def any_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows where at least one text is missing."""
    names = list(columns or string_columns(df))
    return df.filter(reduce(Column.__or__, [F.col(quoted(n)).isNull() for n in names]))


def nonpositive_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose amount is zero or less, per named (frame, amount column)."""
    counts = [
        df.agg(F.count_if(F.col(column) <= 0).alias("nonpositive_rows")).withColumn("table_name", F.lit(name))
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, each with its rows."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("value_rows"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias("distinct_values"))


def columns_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    """Whether two columns hold the same values row by row, NULL matching NULL."""
    different = F.count_if(~F.col(left).eqNullSafe(F.col(right)))
    return df.agg(different.alias("different_rows")).withColumn("equal", F.col("different_rows") == 0)


def columns_only_in(left: DataFrame, right: DataFrame) -> list[str]:
    """Column names of ``left`` that ``right`` lacks."""
    known = set(right.columns)
    return [name for name in left.columns if name not in known]


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    groups = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__rows"))
    return groups.filter(F.col("__rows") > 1).agg(F.count(F.lit(1)).alias("failures"))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures"))


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in order]).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(n)
