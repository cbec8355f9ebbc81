"""Temporal joins: facts with the version of a dimension row that held at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FACT, _HELD, _TIME, _KIND, _PART, _PARTS, _UNTIL = "__fact", "__held", "__time", "__kind", "__part", "__parts", "__until"
# A key with more facts than this is dealt out over several partitions.
FACTS_PER_PART = 1_000_000


def as_of_join(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], fact_time: str, attributes: Sequence[str],
    valid_from: str = "valid_from", valid_to: str = "valid_to", facts_per_part: int = FACTS_PER_PART,
) -> DataFrame:
    """Facts with ``attributes`` of the version valid at ``fact_time`` (from inclusive, to exclusive, NULL open).

    Facts and versions are put in one order by key and time, and each fact takes the last version before
    it, so there is no join on a range. Every fact stays, once; without a key, time or valid version its
    attributes are NULL. A key with many facts is dealt over parts by their hash, and its versions, one a
    change, go to each of its parts. Versions of a key must not overlap.
    """
    counts = facts.filter(F.col(on[0]).isNotNull()).groupBy(*on).agg(F.count(F.lit(1)).alias(_PARTS))
    # at most rows / facts_per_part keys, so this side stays small
    crowded = counts.filter(F.col(_PARTS) > facts_per_part).select(*on, F.ceil(F.col(_PARTS) / facts_per_part).cast("int").alias(_PARTS))
    spread = F.coalesce(F.col(_PARTS), F.lit(1))
    sides = facts.select(*on, F.struct(*facts.columns).alias(_FACT)).join(crowded, list(on), "left")
    moments = sides.select(
        *on, F.pmod(F.xxhash64(_FACT), spread).cast("int").alias(_PART), F.col(_FACT)[fact_time].cast("timestamp_ntz").alias(_TIME),
        F.lit(1).alias(_KIND), _FACT, F.lit(None).cast(dimension.select(*attributes).schema).alias(_HELD), F.lit(None).cast("timestamp_ntz").alias(_UNTIL))
    versions = dimension.filter(F.col(on[0]).isNotNull()).join(crowded, list(on), "left").select(
        *on, F.explode(F.sequence(F.lit(0), spread - 1)).alias(_PART), F.col(valid_from).cast("timestamp_ntz").alias(_TIME), F.lit(0).alias(_KIND),
        F.lit(None).cast(sides.schema[_FACT].dataType).alias(_FACT), F.struct(*attributes).alias(_HELD), F.col(valid_to).cast("timestamp_ntz").alias(_UNTIL))
    # the last version is carried whole, so that an attribute that is NULL in it stays NULL
    carried = F.struct(F.col(_HELD).alias("row"), F.col(_UNTIL).alias("until"))
    along = Window.partitionBy(*on, _PART).orderBy(F.col(_TIME).asc_nulls_first(), _KIND).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col(_KIND) == 0, carried), ignorenulls=True).over(along)
    usable = F.col(on[0]).isNotNull() & F.col(_TIME).isNotNull()
    joined = moments.unionByName(versions).withColumn(_HELD, last).filter(F.col(_KIND) == 1)
    valid = usable & (F.col(f"{_HELD}.until").isNull() | (F.col(_TIME) < F.col(f"{_HELD}.until")))
    return joined.select(f"{_FACT}.*", *[F.when(valid, F.col(f"{_HELD}.row")[name]).alias(name) for name in attributes])
