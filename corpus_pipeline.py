"""Corpus pipeline over ``documents``: language, near copies, repeated passages, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All stages but the last
return the columns of documents; the last adds the number of the copy and the key of the global shuffle.

1. ``language``: documents without a letter, or whose language is not decided at 0.5, go. The model learns
   from the labelled documents of four folds.
2. ``near_copies``: of each group linked by sets of five words at a similarity of 0.8, one row stays: the
   one with the smallest id, also where rows repeat an id or have none.
3. ``repeats``: spans of 50 words that also start in a document with a smaller id are cut out; a document
   left without words goes.
4. ``benchmark``: documents that overlap with a benchmark item go; other texts of the same id, or without
   id, stay.
5. ``mix``: sources are repeated or thinned towards the square root of their sizes and shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstone.llm.common import table
from tillstone.llm.decontaminate import without_contaminated
from tillstone.llm.language_id import with_language
from tillstone.llm.mixing import mix_sources
from tillstone.llm.ngram_join import without_near_copies
from tillstone.llm.substring_dedup import without_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words have no copies and stay."""
    return without_near_copies(docs, width=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("repeats", repeats), ("benchmark", benchmark), ("mix", mix)]

# The stages hash, sort and train; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
