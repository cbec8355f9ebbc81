"""License scan by diagonal voting, in DataFrame functions only.

Each pair of neighbouring words of a text is hashed, and all pairs are joined with the pairs of a fixed,
small set of templates. A match at text place p and template place t votes for the diagonal p - t, on which
the template would start. Votes are aggregated by diagonal before they are shuffled; neighbouring
diagonals (a word put in or left out moves the rest by one) are merged; and a merged span is verified by
the share of the template's pairs that it holds.

Base phrases count only where a single diagonal holds all pairs of the phrase, that is, where its words
stand consecutively. Their labels always stay. Other templates add a label where a merged span holds at
least ``LEAST_SHARE`` of the template.

Results: one row per input row, also for repeated rows and ids. A null or empty text has no words. The
score is the largest verified share of any template, 0 without one. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAST_SHARE = 0.85
MERGED_DISTANCE = 2

# Phrases that are counted, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Public notices and names that add labels.
MORE = (
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc by nd 4 0", "cc-by-nd-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def words(text: Column) -> Column:
    """Words of a text in lower case: runs of digits, letters a-z and non-ASCII characters."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def pairs(found: Column) -> Column:
    """Hashes of neighbouring words."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda a, b: F.xxhash64(a, b))


def templates(spark: SparkSession) -> DataFrame:
    """Fixed table of template, label, base, pairs."""
    listed = [(p, label, True) for p, label in BASE] + [(p, label, False) for p, label in MORE]
    values = ", ".join(f"({i}, '{p}', '{label}', {str(base).lower()})" for i, (p, label, base) in enumerate(listed))
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, phrase, label, base)")
    return table.withColumn("pairs", pairs(words(F.col("phrase")))).drop("phrase")


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    known = templates(docs.sparkSession)
    places = F.broadcast(known.select("template", F.posexplode("pairs").alias("t", "h")))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), words(F.col(text_column)).alias("words"))
    found = texts.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(pairs(F.col("words"))).alias("p", "h"))
    voted = found.join(places, "h", "left")
    doc = ["row", "doc_id", "n_words"]
    diagonals = voted.withColumn("diagonal", F.col("p") - F.col("t")).withColumn("bit", F.expr("shiftleft(1L, t)")).groupBy(
        *doc, "template", "diagonal").agg(F.bit_or("bit").alias("held"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along) > MERGED_DISTANCE
    info = F.broadcast(known.select("template", "label", "base", F.size("pairs").alias("m")))
    merged = diagonals.withColumn("new", F.coalesce(gap.cast("int"), F.lit(0))).withColumn("span", F.sum("new").over(along)).join(info, "template", "left")
    whole = F.when(F.col("base") & (F.bit_count("held") == F.col("m")), F.col("diagonal").cast("long"))
    spans = merged.groupBy(*doc, "template", "label", "base", "m", "span").agg(
        F.bit_or("held").alias("held"), F.count(whole).alias("places"), F.min(whole).alias("first"), F.max(whole).alias("last"))
    share = F.bit_count("held") / F.col("m")
    valid = F.when(F.col("base"), F.col("places") > 0).otherwise(share >= LEAST_SHARE)
    joined = lambda column: F.array_join(F.array_sort(F.collect_set(column)), ",")
    return spans.groupBy(*doc).agg(
        F.coalesce(F.sum("places"), F.lit(0)).alias("n_base"), F.min("first").alias("first_word"), F.max("last").alias("last_word"),
        joined(F.when(F.col("places") > 0, F.col("label"))).alias("base_labels"), joined(F.when(valid, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(valid, F.least(share, F.lit(1.0)))), F.lit(0.0)).alias("score"),
    ).drop("row").withColumnRenamed("doc_id", id_column)
