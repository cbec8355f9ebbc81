"""The pipeline's stages on a made corpus, each against a plain account of what it has to do."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    vocab = {"aa": [f"ka{x}{y}" for x in "aeiou" for y in "lmnpt"], "bb": [f"zo{x}{y}" for x in "aeiou" for y in "rstvz"]}
    text = lambda lang, n: [rng.choice(vocab[lang]) + rng.choice(["", "", rng.choice("xyz")]) for _ in range(n)]
    docs = {i: (text("aa" if i % 3 else "bb", 150), "aa" if i % 3 else "bb", f"s{i % 4}") for i in range(120)}
    near = list(docs[10][0])
    near[75] = "changed"
    docs[200] = (near, "aa", "s0")
    docs[201] = (docs[12][0], "bb", "s1")
    passage = docs[20][0][:70]
    docs[202] = (text("aa", 60) + passage + text("aa", 40), "aa", "s2")
    item = text("aa", 40)
    leaked = list(item)
    leaked[20] = "other"
    docs[203] = (text("aa", 50) + leaked + text("aa", 50), "aa", "s3")
    rows = [(i, " ".join(w), lang, source, 0) for i, (w, lang, source) in docs.items()] + [(300, "123 456", "aa", "s0", 0), (301, None, "aa", "s0", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, passage


def test_stages_one_by_one(spark, corpus, tmp_path):
    folder, docs, passage = corpus
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, folder).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r.text for r in now.collect()}
        if name != "mix":
            assert now.columns == columns
    everything = set(docs)
    assert set(kept["language"]) == everything
    assert set(kept["near_copies"]) == everything - {200, 201}
    assert set(kept["repeats"]) == everything - {200, 201}
    words = docs[202][0]
    assert kept["repeats"][202].split() == words[:60] + words[60 + len(passage):]
    assert {i: t for i, t in kept["repeats"].items() if i != 202} == {i: t for i, t in kept["near_copies"].items() if i != 202}
    assert set(kept["benchmark"]) == everything - {200, 201, 203}
    assert set(kept["mix"]) <= set(kept["benchmark"])


def test_run_equals_the_stages_and_empty_documents(spark, corpus, tmp_path):
    folder, _, _ = corpus
    ids = [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()]
    assert len(ids) > 80 and not {200, 201, 203, 300, 301} & set(ids)
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeated_and_missing_ids(spark, tmp_path):
    rng = random.Random(12)
    text = lambda n: [f"k{rng.randrange(10 ** 6)}" for _ in range(n)]
    near = lambda words: " ".join([*words[:40], "changed", *words[41:]])
    a, b, c, d, e, f, item = (text(80) for _ in range(7))
    rows = [(1, a), (1, a), (2, near(a).split()), (2, b), (3, c), (3, near(c).split()), (None, d), (None, d), (None, near(d).split()),
            (None, e), (9, near(e).split()), (None, f), (None, ["x", *item]), (4, ["y", *item[:50]]), (4, text(60)), (5, []), (5, [])]
    rows = [(i, " ".join(w), "aa", "s", k) for k, (i, w) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = {r.n_chars for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert len(kept & {0, 1}) == len(kept & {4, 5}) == len(kept & {6, 7, 8}) == 1
    assert kept - {0, 1, 4, 5, 6, 7, 8} == {3, 10, 11, 12, 13, 14, 15, 16}
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.n_chars for r in corpus_pipeline.benchmark(spark, docs, str(tmp_path)).collect()} == set(range(17)) - {12, 13}
