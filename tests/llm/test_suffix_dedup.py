"""Suffix-array dedup against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from tillstone.llm import suffix_dedup


def brute(docs, window):
    data = [(k, (t or "").encode()) for k, t in docs]
    times = Counter(d[i:i + window] for _, d in data for i in range(len(d) - window + 1))
    out = []
    for k, d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - window + 1):
            if times[d[i:i + window]] > 1:
                gone[i:i + window] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((k, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, window=400):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(frame, window).collect()), key=str)


def test_against_all_windows(spark, sample_docs):
    assert run(spark, sample_docs) == brute(sample_docs, 400)


def test_pieces_shared_with_several_texts(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdé \n") for _ in range(6000))
    docs = []
    for i in range(60):
        a, b = rng.randrange(5000), rng.randrange(200)
        docs.append((i, base[a:a + rng.randrange(900)] + "x" * rng.choice([0, 3, 900]) + base[a + b:a + b + rng.randrange(800)] * rng.choice([1, 2])))
    docs += [(90, docs[3][1]), (None, docs[5][1]), (90, docs[3][1]), (91, None), (91, "")]
    assert run(spark, docs) == brute(docs, 400)


def test_common_line_in_many_contexts(spark):
    rng = random.Random(6)
    line = "".join(rng.choice("pqrst ") for _ in range(390))
    docs = [(i, f"{rng.randrange(10 ** 9)} " * rng.randrange(40) + line + "".join(rng.choice("uvwxyz") for _ in range(rng.randrange(600)))) for i in range(80)]
    assert run(spark, docs) == brute(docs, 400)


def test_cover_and_block_order():
    residues = suffix_dedup.cover(64)
    assert {(a - b) % 64 for a in residues.tolist() for b in residues.tolist()} == set(range(64))
    rng = np.random.default_rng(2)
    text = np.tile(rng.integers(97, 99, 640, dtype=np.uint8), 3)
    starts = np.arange(0, 1280, 64)
    ranks = suffix_dedup.block_ranks(text, starts)
    keys = [text[s:s + 400].tobytes() for s in starts]
    for i in range(len(keys)):
        for j in range(len(keys)):
            assert (keys[i] == keys[j]) == (ranks[i] == ranks[j])


def test_empty_table(spark):
    frame = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, bucket int").limit(0)
    assert suffix_dedup.suffix_dedup(frame).collect() == []
