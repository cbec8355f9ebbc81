"""The n-gram join against all pairs of sets."""

from __future__ import annotations

import random
import re

import pytest

from tillstone.llm import ngram_join


def brute(docs, width, percent):
    sets = {}
    for key, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = [k for k in sets if sets[k]]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    least = {}
    for k in sets:
        least[root(k)] = min(k, least.get(root(k), k))
    return {k: (len(sets[k]), least[root(k)]) for k in sets}


def run(spark, docs, width, percent):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame, width, percent).collect()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_against_all_pairs(spark, sample_docs, width, percent):
    assert run(spark, sample_docs, width, percent) == brute(sample_docs, width, percent)


def test_family_of_near_copies(spark, monkeypatch):
    """Every token is held by many: prefixes go through pairs of tokens, then into high tokens."""
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 2000)
    rng = random.Random(3)
    bases = [[f"{b}v{rng.randrange(50)}" for _ in range(160)] for b in range(2)]
    docs = []
    for i in range(150):
        copy = list(bases[i % 2])
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(copy)))
    assert run(spark, docs, 3, 90) == brute(docs, 3, 90)


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (None, "a b c d", "z"), (5, None, "q"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (5, 0, 5), (None, 0, None)], key=str)
    assert ngram_join.jaccard_components(frame.limit(0)).collect() == []


def test_long_words_that_collide_in_polynomials(spark):
    words = ["".join(letters[bin(i).count("1") % 2] for i in range(n)) for n in (1024, 4096) for letters in ("ab", "ba")]
    docs = list(enumerate([*words, words[0], f"{words[0]} {words[1]} x y z", f"{words[1]} {words[0]} x y z", "q " * 600_000 + "end", "q " * 600_000 + "end."]))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame, 3, 90).collect()}
    assert got == brute(docs, 3, 90)
