"""Pairs of blocks of the n-gram join grow with a family of near copies, not with its square."""

from __future__ import annotations

import random

import pytest
from test_ngram_join import brute, run

from tillstone.llm import ngram_join


def family(size, changes, seed):
    rng = random.Random(seed)
    base = [f"v{rng.randrange(900)}" for _ in range(160)]
    docs = []
    for i in range(size):
        copy = list(base)
        for _ in range(changes(rng)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(copy)))
    return docs


def test_pairs_of_blocks_of_a_linked_family(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 1000)
    plain, counts = ngram_join._verify, []
    for size in (100, 300):
        rows = spark.sparkContext.accumulator(0)

        def counted(percent, rows=rows):
            verify = plain(percent)

            def over(batches):
                for batch in batches:
                    rows.add(batch.num_rows)
                    yield from verify(iter([batch]))

            return over

        monkeypatch.setattr(ngram_join, "_verify", counted)
        docs = family(size, lambda rng: 1, seed=5)
        assert {c for _, c in run(spark, docs, 3, 90).values()} == {0}
        counts.append(rows.value)
    assert 0 < counts[1] <= 4 * counts[0]


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_families_of_different_sizes_and_short_sets(spark, monkeypatch, width, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 1500)
    rng = random.Random(11)
    texts = [text for seed in range(3) for _, text in family(50, lambda r: r.choice([0, 1, 2, 4, 7, 12]), seed)]
    texts = [" ".join(text.split()[rng.choice([0, 0, 5, 12]):rng.choice([160, 160, 155, 145])]) for text in texts]
    texts += [" ".join(f"s{rng.randrange(3)}" for _ in range(rng.randrange(1, 30))) for _ in range(80)]
    docs = list(enumerate(texts))
    assert run(spark, docs, width, percent) == brute(docs, width, percent)
