"""Substring dedup against a walk over all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tillstone.llm import substring_dedup


def brute(docs, window):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in docs}
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - window + 1):
            first.setdefault(tuple(words[k][i:i + window]), k)
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < k:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("window", "gram"), [(50, 12), (8, 3)])
def test_against_all_windows(spark, sample_docs, window, gram):
    frame = spark.createDataFrame(sample_docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame, window, gram).collect()}
    assert got == brute(sample_docs, window)


def test_straddling_matches(spark):
    """Documents that share pieces with different others, and periodic texts."""
    rng = random.Random(9)
    base = [f"t{rng.randrange(60)}" for _ in range(400)]
    docs = []
    for i in range(60):
        a = rng.randrange(300)
        piece = base[a:a + rng.randrange(100)] + [f"u{rng.randrange(9)}"] + base[a // 2:a // 2 + rng.randrange(60)]
        docs.append((i, " ".join(piece * rng.choice([1, 1, 2, 3]))))
    docs += [(100 + i, "a b " * (20 + i)) for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame, 20, 6).collect()}
    assert got == brute(docs, 20)


def test_texts_nulls_and_clashing_columns(spark):
    long_text = " ".join(f"v{i}" for i in range(60))
    rows = [(1, f"x {long_text}\n y", "k", 1), (2, f"start {long_text}\nend", "k", 2), (3, long_text, "k", 3), (None, long_text, "k", 4), (4, None, "k", 5), (4, "", "k", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id string, spans int")
    kept = {r.spans: r.text for r in substring_dedup.without_repeats(frame).collect()}
    assert kept == {1: f"x {long_text}\n y", 2: "start end", 5: None, 6: ""}
    counts = sorted((r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame).collect())
    assert counts == [(0, 0), (0, 0), (60, 60), (60, 60), (62, 0), (62, 60)]
    assert substring_dedup.substring_dedup(frame.limit(0)).collect() == []


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_long_words_that_collide_in_polynomials_and_long_texts(spark):
    """Words of a Thue-Morse order and its complement, in texts of more than a slice."""
    rng = random.Random(2)
    docs = []
    for i, n in enumerate((1024, 2048, 4096)):
        docs += [(2 * i, " ".join([thue_morse(n, "ab")] * 61)), (2 * i + 1, " ".join([thue_morse(n, "ba")] * 61))]
    passage = " ".join(f"p{i}" for i in range(70))
    long_text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(180_000))
    docs += [(10, long_text), (11, f"{long_text[:900_000]} {passage} {long_text[900_000:]}"), (12, f"x {passage} y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame).collect()}
    assert got == brute(docs, 50)
