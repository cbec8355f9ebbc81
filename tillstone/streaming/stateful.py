"""Streams that remember: duplicate flags over arriving lines, and daily totals as they grow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstone.operators.duplicates import flag_by_position, row_identity
from tillstone.plans.bronze import write_batch
from tillstone.sources.files import PARQUET_GLOB
from tillstone.sources.sinks import delete_paths, read_table_or_none

EPOCH, FLAG = "epoch", "potential_duplicate_flag"
POSITION = ("__file", "__index")
KEY = ("__identity_a", "__identity_b")
_SEEN, _LATEST = "__seen", "latest"


def read_lines(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream of Parquet rows with their position, which tells any two of them apart."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", PARQUET_GLOB)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select("*", F.col("_metadata.file_path").alias(POSITION[0]), F.col("_metadata.row_index").alias(POSITION[1]))


class SeenKeys:
    """Keys of lines seen by earlier micro-batches: a partition for each epoch, and a log of their latest times.

    A key is kept as 128 bits. Epochs whose latest event lies before the watermark (the latest event of all
    epochs less the delay) are not looked at any more and are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, delay_seconds: int):
        self.spark, self.path, self.delay = spark, path, delay_seconds

    def _log(self, before: int) -> list:
        """(epoch, latest event) of earlier epochs that are still kept: a few rows, as epochs expire."""
        log = read_table_or_none(self.spark, f"{self.path}/epochs", merge=False)
        return [] if log is None else log.filter(F.col(EPOCH) < before).select(EPOCH, _LATEST).collect()

    def live(self, epoch: int) -> tuple[list[int], list[int]]:
        """Earlier epochs that count for this one, and those that have expired."""
        log = self._log(epoch)
        known = [row[_LATEST] for row in log if row[_LATEST] is not None]
        watermark = max(known) - self.delay if known else None
        kept = [row[EPOCH] for row in log if row[_LATEST] is None or row[_LATEST] >= watermark]
        return kept, [row[EPOCH] for row in log if row[EPOCH] not in set(kept)]

    def keys(self, epochs: Sequence[int]) -> DataFrame:
        paths = [f"{self.path}/keys/{EPOCH}={epoch}" for epoch in epochs]
        schema = ", ".join(f"{name} bigint" for name in KEY)
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.distinct().withColumn(_SEEN, F.lit(True))

    def add(self, firsts: DataFrame, epoch: int, latest: int | None, expired: Sequence[int]) -> None:
        firsts.select(*KEY).write.mode("overwrite").parquet(f"{self.path}/keys/{EPOCH}={epoch}")
        # without an event time a batch's keys are kept for good
        write_batch(self.spark.createDataFrame([(latest, epoch)], f"{_LATEST} bigint, {EPOCH} int"), f"{self.path}/epochs", (EPOCH,))
        delete_paths(self.spark, [f"{self.path}/{part}/{EPOCH}={old}" for old in expired for part in ("epochs", "keys")])


def _flag(batch: DataFrame, epoch: int, keys: Sequence[str], order: Sequence[str], event_time: str, target: str, state: str, delay: int) -> None:
    spark = batch.sparkSession
    seen = SeenKeys(spark, state, delay)
    kept, expired = seen.live(epoch)
    flagged = flag_by_position(batch, keys, order, POSITION, FLAG).persist()
    try:
        # only the first row of a key in this batch can be the first of all, so one row a key meets the state
        firsts = flagged.filter(F.col(FLAG) == 0).select("*", *row_identity(keys)).join(seen.keys(kept), list(KEY), "left").persist()
        try:
            later = flagged.filter(F.col(FLAG) == 1)
            first_rows = firsts.withColumn(FLAG, F.coalesce(F.col(_SEEN), F.lit(False)).cast("int")).select(*flagged.columns)
            rows = first_rows.unionByName(later).drop(*POSITION).withColumn(EPOCH, F.lit(epoch))
            write_batch(rows, target, (EPOCH,))
            latest = flagged.agg(F.max(F.unix_seconds(F.col(event_time).cast("timestamp")))).first()[0]
            seen.add(firsts, epoch, latest, expired)
        finally:
            firsts.unpersist()
    finally:
        flagged.unpersist()


def flag_stream(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: str, target: str, state: str, checkpoint: str, delay_seconds: int,
) -> StreamingQuery:
    """Write arriving rows with 0 for the first of a key and 1 for later ones, as far back as the delay reaches.

    Within a micro-batch ``order`` decides, and between them the order of arrival. A key that came again
    after its last epoch expired counts as new. Every row is written, late ones too. A key that fills a
    batch is reduced by partial aggregation and meets the state as one row. A micro-batch that is run again
    looks at earlier epochs only and replaces what it wrote.
    """
    write = partial(_flag, keys=list(keys), order=list(order), event_time=event_time, target=target, state=state, delay=delay_seconds)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, epoch: write(batch, epoch)).start()


def daily_totals(rows: DataFrame, event_time: str, by: Sequence[str], sums: dict[str, str], delay: str) -> DataFrame:
    """Rows and sums per day and ``by``, updated as rows arrive; days before the watermark are closed.

    Rows without an event time are in no day.
    """
    timed = rows.withColumn("__time", F.col(event_time).cast("timestamp")).withWatermark("__time", delay)
    totals = timed.groupBy(F.window("__time", "1 day").alias("__day"), *by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(column).alias(name) for name, column in sums.items()])
    return totals.select(F.to_date("__day.start").alias("day"), *by, "rows", *sums)


def upsert_stream(totals: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the totals that a micro-batch changed, under its epoch; an epoch that is run again replaces itself."""
    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, epoch: write_batch(batch.withColumn(EPOCH, F.lit(epoch)), target, (EPOCH,))).start()


def read_totals(spark: SparkSession, target: str, by: Sequence[str]) -> DataFrame | None:
    """Latest totals of each day and ``by``."""
    rows = read_table_or_none(spark, target, merge=False)
    if rows is None:
        return None
    keys = ["day", *by]
    values = [name for name in rows.columns if name not in {*keys, EPOCH}]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), EPOCH).alias("newest"))
    return newest.select(*keys, "newest.*")


def compact_totals(spark: SparkSession, target: str, by: Sequence[str]) -> None:
    """Fold all finished epochs into the latest one, so that reads don't grow with the number of micro-batches."""
    rows = read_table_or_none(spark, target, merge=False)
    if rows is None:
        return
    epochs = sorted(r[0] for r in rows.select(EPOCH).distinct().collect())
    folded = read_totals(spark, target, by).withColumn(EPOCH, F.lit(epochs[-1]))
    staged = f"{target}-folded"
    folded.write.mode("overwrite").parquet(staged)
    write_batch(spark.read.parquet(staged), target, (EPOCH,))
    delete_paths(spark, [*[f"{target}/{EPOCH}={epoch}" for epoch in epochs[:-1]], staged])
