"""Helpers of this subpackage: lineage cuts, checked broadcasts, connected groups, Arrow lists."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.session import working_folder

# A side is broadcast only after its rows were counted, up to this many narrow rows (about 16 MB).
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared checkpoint folder.

    What led to them is not needed any more, but Spark removes shuffle files only when the driver's JVM
    has collected what refers to them; so that is asked for, and disk holds one phase's files at a time.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(working_folder(df.sparkSession, "checkpoint"))
    written = df.checkpoint()
    del df
    gc.collect()
    context._jvm.System.gc()
    return written


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted and is small; Spark's own choice otherwise.

    ``df`` must be cheap to count, that is, just written by ``cut``.
    """
    return F.broadcast(df) if df.count() <= limit else df


def let_go() -> None:
    """Give memory that a task no longer uses back to the machine; Python workers live on with the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library, which has no such call


def letting_go(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, and then ``let_go``."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            let_go()

    return wrapped


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside sends at most so many rows to Python at once, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List array with values[bounds[i]:bounds[i + 1]] as its i-th item."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for every node that has an edge.

    Alternates the two star steps: larger neighbours, then all neighbours with the node itself, are
    linked to the smallest neighbour. Every step is a shuffle on nodes; hot nodes are only counted
    through a partial minimum and a join that Spark can split.
    """
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = large.distinct()
        # small star: a node's smaller neighbours and the node itself go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        now = cut(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
