"""Language identification: held-out accuracy, back-off, edge cases."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillstone.llm import language_id

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    found = language_id.identify(docs, sample_rows=500).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, total = found.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert total > 150
    assert right / total > 0.97


def _made(spark):
    rng = random.Random(1)
    vocab = {"aa": ["kata", "kito", "kuku", "kakato"], "bb": ["zemil", "zoril", "zuvil", "zamelil"]}
    rows = [(i, " ".join(rng.choice(vocab[lang]) for _ in range(30)), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    return rows


def test_unseen_words_back_off(spark):
    model = language_id.fit(spark.createDataFrame(_made(spark), "id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]
    predict = language_id.predictor(spark, model)
    texts = spark.createDataFrame([("Kakuku!",), ("zomil 99",), ("123 ?!",), (None,), ("",), ("ξ",)], "text string")
    got = [(r.lang, round(r.score, 2)) for r in texts.select(predict("text").alias("p")).select("p.*").collect()]
    assert [g[0] for g in got] == ["aa", "bb", "und", "und", "und", "aa"]
    assert got[0][1] > 0.9 and got[2:5] == [("und", 0.0)] * 3 and got[5][1] == 0.5


def test_rare_languages_are_learned(spark):
    rows = [(i, "kata kito" if i % 2 else "zemil zoril", "aa" if i % 2 else "bb") for i in range(20_000)]
    rows += [(i, "ξυλο παλι", "cc") for i in range(20_000, 20_006)]
    model = language_id.fit(spark.createDataFrame(rows, "id long, text string, lang string"), sample_rows=200)
    assert model.languages == ["aa", "bb", "cc"]
    assert language_id.quota([6, 10_000, 10_000], 200) == 97 and language_id.quota([1, 2], 8) == language_id.math.inf


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame(_made(spark), "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(language_id.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    assert "xx" not in language_id.fitted(wrong).languages


def test_stage_keeps_columns_and_rejects(spark):
    rows = [(*r, 0.5, "s") for r in _made(spark)] + [(None, "kata kito", None, 1.0, "n"), (901, "!!! 12", "aa", 1.0, "n"), (902, None, "aa", 1.0, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    kept = language_id.with_language(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 81
    assert kept.filter("doc_id is null").count() == 1
    assert language_id.identify(docs.limit(0)).collect() == []
