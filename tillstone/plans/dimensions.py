"""Dimensions with history: exports of a master table as versions with the time they held.

An export is a whole copy of the master table at a time. It holds from then until the next export that is
known, so the history needs no observation times of its own: an export that arrives late takes the time
up to the next known export, splits the versions that reach over it, and versions that turn out equal on
both sides of a border are one again. The same export merged twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.sources.versions import VersionedTable

VALID_FROM, VALID_TO, CURRENT, SURROGATE = "valid_from", "valid_to", "is_current", "version_key"
_HASH, _ISLAND, _NEW = "__hash", "__island", "__new"


def _stamp(at: str) -> Column:
    return F.lit(at).cast("timestamp_ntz")


def _fingerprint(names: Sequence[str]) -> Column:
    """Digest of the named columns; NULL and empty text differ, and so do values moved between columns."""
    return F.sha2(F.to_json(F.struct(*[F.col(n).cast("string").alias(n) for n in names]), {"ignoreNullFields": "false"}), 256)


def join_equal(pieces: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Versions of neighbouring pieces: a new one begins where a value changes or time is left out.

    A key has at most one piece for each export, so its window stays small.
    """
    along = Window.partitionBy(*keys).orderBy(VALID_FROM)
    hashed = pieces.withColumn(_HASH, _fingerprint(attributes))
    changed = ~(F.lag(_HASH).over(along).eqNullSafe(F.col(_HASH)) & F.lag(VALID_TO).over(along).eqNullSafe(F.col(VALID_FROM)))
    islands = hashed.withColumn(_NEW, changed.cast("int")).withColumn(_ISLAND, F.sum(_NEW).over(along))
    grouped = islands.groupBy(*keys, _ISLAND).agg(
        *[F.any_value(F.struct(F.col(n).alias("v"))).getField("v").alias(n) for n in attributes],
        F.min(VALID_FROM).alias(VALID_FROM),
        F.when(F.count(VALID_TO) == F.count(F.lit(1)), F.max(VALID_TO)).alias(VALID_TO))
    return grouped.drop(_ISLAND)


def described(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History with a surrogate key for each version and a mark on those that still hold."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return history.withColumns({
        SURROGATE: F.md5(F.concat_ws("|", *parts, F.col(VALID_FROM).cast("string"))), CURRENT: F.col(VALID_TO).isNull()})


def first_of_key(export: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One row a key: an export that repeats a key counts by its smallest row. Rows without a key are left out."""
    rows = export.select(*keys, *attributes)
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    order = F.struct(*[part for n in attributes for part in (F.col(n).isNull(), F.col(n))])
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*attributes), order).alias("row")).select(*keys, "row.*")


def merge_export(
    history: DataFrame | None, export: DataFrame, at: str, known: Sequence[str], keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """History (keys, attributes, valid_from, valid_to) with the export of time ``at`` put in its place.

    ``known`` are the times of the exports merged so far. A key that the export lacks does not hold while
    the export does.
    """
    later = sorted(t for t in known if t > at)
    until = _stamp(later[0]) if later else F.lit(None).cast("timestamp_ntz")
    placed = first_of_key(export, keys, attributes).withColumns({VALID_FROM: _stamp(at), VALID_TO: until})
    if history is None:
        return placed
    columns = [*keys, *attributes, VALID_FROM, VALID_TO]
    before = history.filter(F.col(VALID_FROM) < _stamp(at)).withColumn(
        VALID_TO, F.least(F.coalesce(F.col(VALID_TO), _stamp(at)), _stamp(at)))
    pieces = before.select(*columns).unionByName(placed.select(*columns))
    if later:
        after = history.filter(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > until)).withColumn(VALID_FROM, F.greatest(VALID_FROM, until))
        pieces = pieces.unionByName(after.select(*columns))
    return join_equal(pieces, keys, attributes)


class Dimension:
    """A dimension's history as a versioned table, with the log of the exports merged into it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], attributes: Sequence[str]):
        self.keys, self.attributes = list(keys), list(attributes)
        self.table = VersionedTable(spark, path)
        self.exports = VersionedTable(spark, f"{path}/exports")

    def times(self) -> list[str]:
        """Times of the merged exports: one row each, whatever the dimension's size."""
        rows = self.exports.read()
        return [] if rows is None else [r[0] for r in rows.collect()]

    def merge(self, export: DataFrame, at: str) -> DataFrame:
        """Merge an export in any order of arrival; returns the new history.

        The times of a merge are logged under the version they belong to, and read back by it, so a job
        that died between the two writes is simply run again.
        """
        spark, known = self.table.spark, self.times()
        version = (self.table.latest() or 0) + 1
        merged = merge_export(self.table.read(), export, at, known, self.keys, self.attributes)
        self.table.write(merged, version, at)
        self.exports.write(spark.createDataFrame([(t,) for t in sorted({*known, at})], "at string"), version, at)
        return self.history()

    def history(self) -> DataFrame:
        return described(self.table.read(), self.keys)
