"""Pairs of blocks reach Python a few at a time."""

from __future__ import annotations

from tillstone.llm import ngram_join


def test_pairs_of_blocks_come_in_small_batches(spark, monkeypatch):
    name, seen, connected = "spark.sql.execution.arrow.maxRecordsPerBatch", [], ngram_join.connected
    monkeypatch.setattr(ngram_join, "connected", lambda links: (seen.append(spark.conf.get(name)), connected(links))[1])
    before = spark.conf.get(name)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " end"), (3, "other text of five words")], "doc_id long, text string")
    found = {r.id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert [int(n) for n in seen] == [ngram_join.PAIRS_A_BATCH] and spark.conf.get(name) == before
