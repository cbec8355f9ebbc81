"""Completeness and freshness of loads: missing days as intervals, branches without recent sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days of the week as Spark numbers them, Monday first.
MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = range(7)


def expected_days(spans: DataFrame, by: str, first: str, last: str, open_weekdays: Sequence[int] | None = None) -> DataFrame:
    """(by, day, number) of every day a branch is open between two dates, both included, numbered from 1."""
    days = spans.select(by, F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    if open_weekdays is not None:
        days = days.filter(F.weekday("day").isin(list(open_weekdays)))
    return days.withColumn("number", F.row_number().over(Window.partitionBy(by).orderBy("day")))


def missing_days(
    rows: DataFrame, by: str, day: str, open_weekdays: Sequence[int] | None = None, until: str | None = None
) -> DataFrame:
    """Runs of open days without a row: by, missing_from, missing_to, open_days.

    A branch is expected from its first day to its last, or to ``until``, if that is later. Rows without
    branch or day don't count. Rows are reduced to branch and day by partial aggregation; what is left is
    the calendar of each branch, so no window holds more than its days.
    """
    seen = rows.select(F.col(by), F.col(day).cast("date").alias("day")).filter(F.col(by).isNotNull() & F.col("day").isNotNull()).distinct()
    last = F.max("day") if until is None else F.greatest(F.max("day"), F.lit(until).cast("date"))
    spans = seen.groupBy(by).agg(F.min("day").alias("first"), last.alias("last"))
    missing = expected_days(spans, by, "first", "last", open_weekdays).join(seen, [by, "day"], "left_anti")
    run = F.col("number") - F.row_number().over(Window.partitionBy(by).orderBy("day"))
    return missing.withColumn("run", run).groupBy(by, "run").agg(
        F.min("day").alias("missing_from"), F.max("day").alias("missing_to"), F.count(F.lit(1)).alias("open_days")).drop("run")


def stale_branches(rows: DataFrame, by: str, day: str, as_of: str, max_age_days: int) -> DataFrame:
    """Branches whose latest day is more than ``max_age_days`` before ``as_of``: by, last_day, age_days."""
    age: Column = F.date_diff(F.lit(as_of).cast("date"), F.col("last_day"))
    latest = rows.filter(F.col(by).isNotNull()).groupBy(by).agg(F.max(F.col(day).cast("date")).alias("last_day"))
    return latest.withColumn("age_days", age).filter(F.col("age_days").isNull() | (F.col("age_days") > max_age_days))
