"""File manifests: what is new, changed, done, or left over."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.operators.duplicates import dedup_keep_first

# States of a file and of a listing entry.
STARTED, SUCCESS, FAILED, COMPLETED = "STARTED", "SUCCESS", "FAILED", "COMPLETED"
NEW, CHANGED, UNCHANGED = "NEW", "CHANGED", "UNCHANGED"

_INCOMING = "__incoming"


def new_files(listing: DataFrame, manifest: DataFrame, key: str = "file_path") -> DataFrame:
    """Listed files that were never loaded successfully. Failed files come up again."""
    done = manifest.filter(F.col("status") == SUCCESS).select(key)
    return listing.join(done, key, "left_anti")


def classify_files(
    listing: DataFrame, manifest: DataFrame, by: Sequence[str] = ("file_hash", "last_modified"), key: str = "file_path"
) -> DataFrame:
    """Each listed file as new, changed (any of ``by`` differs) or unchanged."""
    known = manifest.select(
        key, F.lit(True).alias("__known"), *[F.col(name).alias(f"__{name}") for name in by]
    )
    joined = listing.join(known, key, "left")
    differs = reduce(Column.__or__, [~F.col(name).eqNullSafe(F.col(f"__{name}")) for name in by])
    state = F.when(F.col("__known").isNull(), NEW).when(differs, CHANGED).otherwise(UNCHANGED)
    return joined.withColumn("state", state).select(*listing.columns, "state")


def files_to_process(
    listing: DataFrame, manifest: DataFrame, by: Sequence[str] = ("file_hash", "last_modified"), key: str = "file_path"
) -> DataFrame:
    return classify_files(listing, manifest, by, key).filter(F.col("state") != UNCHANGED).drop("state")


def orphaned_outputs(manifest: DataFrame, listing: DataFrame, key: str = "file_path") -> DataFrame:
    """Outputs whose source file is gone. Deleting them is a separate step for the caller."""
    gone = manifest.join(listing.select(key), key, "left_anti")
    return gone.select(key, F.explode("output_files").alias("output_file"))


def without_orphans(manifest: DataFrame, listing: DataFrame, key: str = "file_path") -> DataFrame:
    return manifest.join(listing.select(key), key, "left_semi")


def upsert_latest(manifest: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Latest row per key over the old manifest and the new rows; at equal stamps the new row wins."""
    both = manifest.withColumn(_INCOMING, F.lit(0)).unionByName(rows.withColumn(_INCOMING, F.lit(1)), allowMissingColumns=True)
    return latest(both, [key], [order, _INCOMING]).drop(_INCOMING)


def latest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest event per key. Events are only ever appended; this is the view over them."""
    return dedup_keep_first(events, keys, order, newest_first=True)


def reconcile(source_counts: DataFrame, target_counts: DataFrame, key: str = "file_path") -> DataFrame:
    """Row counts of both sides per file, with the difference; a missing side counts as zero."""
    source = source_counts.select(key, F.col("rows").alias("source_rows"))
    target = target_counts.select(key, F.col("rows").alias("target_rows"))
    joined = source.join(target, key, "full_outer").fillna(0, ["source_rows", "target_rows"])
    return joined.withColumn("row_difference", F.col("source_rows") - F.col("target_rows"))
