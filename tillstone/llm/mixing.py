"""Mixing of sources to target weights by Poisson replication, in DataFrame functions only.

A source's target is its share of the mix; its mean repetition rate is the target size over the size it
has. Each document takes as many copies as a Poisson distribution with that mean gives at a uniform
number made from a hash of seed and id: the distribution is inverted by counting the steps of its
cumulative sum that lie at or below the number, whatever the mean. Copies are exploded and shuffled globally by another hash,
of seed, id and copy. So the mix is the same on every run and for any partitioning.

Sizes are aggregated in the tasks first, and a row per source is joined back; a large source is never
gathered. The per-source rows are broadcast only after they were counted.

Results: one row per copy, with all columns of the input, the copy's number from 1 and ``mix_key``, by
whose order the mix is shuffled. A null source is a source like any other. Null and empty texts have the
size of one character. Rows that repeat an id take the same number of copies each; so do rows without
id. A source without a weight in ``weights`` takes no part. Columns named like the two new ones are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut, small

SEED = "mix-1"
# Hexadecimal digits of the hash that make the uniform number; all are exact in a double.
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """Number from 0 to 1 (excluded) from a hash of the parts, the same in every engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, DIGITS), 16, 10).cast("long")


def poisson_steps(rate: Column) -> Column:
    """Struct of the first number of copies that matters, and the cumulative probabilities from it on.

    Twelve deviations and 20 to both sides hold all but 1e-16. Where they do not reach down to 0, exp(-rate)
    may be too small for a double; there the terms are taken relative to the first and divided by their sum.
    """
    width = 12 * F.sqrt(rate) + 20
    first = F.greatest(F.floor(rate - width), F.lit(0)).cast("int")
    start = F.when(first == 0, F.exp(-rate)).otherwise(F.lit(1.0))
    terms = F.aggregate(
        F.sequence(first + 1, F.ceil(rate + width).cast("int")),
        F.struct(start.alias("p"), F.array(start).alias("sums")),
        lambda s, k: F.struct((s["p"] * rate / k).alias("p"), F.concat(s["sums"], F.array(F.element_at(s["sums"], -1) + s["p"] * rate / k)).alias("sums")),
        lambda s: F.when(first == 0, s["sums"]).otherwise(F.transform(s["sums"], lambda x: x / F.element_at(s["sums"], -1))),
    )
    return F.struct(first.alias("first"), terms.alias("sums"))


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, source_column: str = "source",
                 text_column: str = "text") -> DataFrame:
    """Per source: mean repetitions that keep the total size and bring the source to its weight.

    Without ``weights`` a source weighs its size to the given power.
    """
    sizes = docs.groupBy(F.col(source_column).alias("mix_source")).agg(
        F.sum(F.greatest(F.coalesce(F.char_length(F.col(text_column)), F.lit(0)), F.lit(1)).cast("long")).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(power))))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), "name string, weight double")
        weighed = sizes.join(given, F.col("mix_source").eqNullSafe(F.col("name"))).drop("name")
    weighed = cut(weighed)
    all_size, all_weight = weighed.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(float(all_weight or 1)) * F.lit(float(all_size or 1)) / F.col("size")
    return weighed.select("mix_source", "size", "weight", rate.alias("rate"))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, seed: str = SEED,
                id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """Copies of the documents in the target mix, shuffled globally."""
    rates = source_rates(docs, weights, power, source_column, text_column)
    rates = small(cut(rates.select("mix_source", poisson_steps(F.col("rate")).alias("mix_steps"))))
    columns = [c for c in docs.columns if c not in ("copy", "mix_key")]
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    drawn = docs.join(rates, F.col(source_column).eqNullSafe(F.col("mix_source"))).withColumn(
        "mix_copies", F.col("mix_steps.first") + F.size(F.filter("mix_steps.sums", lambda step: step * float(16 ** DIGITS) <= uniform(F.lit(seed), name))))
    copies = drawn.filter("mix_copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy"))
    keyed = copies.withColumn("mix_key", uniform(F.lit(seed), name, F.col("copy").cast("string")))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")
