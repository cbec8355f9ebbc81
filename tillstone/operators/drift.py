"""Drift of a batch against the batches before it, from quantile sketches kept with the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sketch size: ranks are within about 1 percent of the true ones.
SIZE = 300
POINTS = tuple((i + 0.5) / 200 for i in range(200))
LEAST_DRIFT = 0.1
PAST_BATCHES = 30


def batch_sketches(df: DataFrame, batch: str, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """(batch, column_name, values, sketch): one small mergeable sketch for each numeric column of a batch.

    NULL and NaN are not values. Rows are sketched in map tasks; only sketches are shuffled.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]))
    values = df.select(F.col(batch).alias("batch"), each.alias("cell")).select("batch", "cell.*").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return values.groupBy("batch", "column_name").agg(F.count(F.lit(1)).alias("values"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = ("column_name",)) -> DataFrame:
    """Sketches of several batches as one."""
    return sketches.groupBy(*by).agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch").alias("sketch"))


def batch_drift(sketches: DataFrame, past_batches: int = PAST_BATCHES, least: float = LEAST_DRIFT) -> DataFrame:
    """(batch, column_name, drift, drifted) of every batch that has one before it.

    Drift is the largest difference, over 200 quantiles of the past, between the share of the past and of
    the batch up to that value; half a percent comes from the number of points, the rest from the sketches. The past of a batch are the ``past_batches`` before it.
    """
    recent = Window.partitionBy("column_name").orderBy("batch").rowsBetween(-past_batches, -1)
    # a few small sketches a row, bounded by past_batches
    past = sketches.withColumn("past", F.collect_list("sketch").over(recent)).filter(F.size("past") > 0)
    first = F.element_at("past", 1)
    rest = F.slice("past", 2, past_batches)
    joined = past.withColumn("past", F.aggregate(rest, first, lambda a, b: F.kll_sketch_merge_double(a, b)))
    points = F.array(*[F.lit(p) for p in POINTS])
    curves = joined.select("batch", "column_name", F.kll_sketch_get_quantile_double("past", points).alias("before"),
                           F.kll_sketch_get_quantile_double("sketch", points).alias("now"))
    share = lambda curve, value: F.size(F.filter(curve, lambda x: x <= value)) / len(POINTS)
    drift = F.array_max(F.transform("before", lambda v: F.abs(share("before", v) - share("now", v))))
    joined = curves
    return joined.select("batch", "column_name", drift.alias("drift"), (drift > least).alias("drifted"))
