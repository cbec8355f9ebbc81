from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tillstone.llm.spelling_variants import common_prefix, one_edit, spelling_variants

SCHEMA = "doc_id bigint, text string, word string, n int, form string, key string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and distance(v, w) == 1] for w in n}
    form = {}
    for w, found in near.items():
        best = min(((-n[v], v) for v in found), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "a", 1, "b", "c") for i, t in rows], SCHEMA).repartition(3)
    found = spelling_variants(df, **options).select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(tuple(r) for r in found.collect())


def corpus(seed, documents=120, letters="abé×Ü"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    rows = []
    for i in range(documents):
        words = []
        for _ in range(rng.choice([0, 1, 20, 60])):
            word = rng.choice(base[:rng.choice([3, 60])])
            if rng.random() < 0.3:
                place = rng.randrange(len(word) + 1)
                word = rng.choice([word[:place] + word[place + 1:], word[:place] + rng.choice(letters) + word[place:], word[:place] + rng.choice(letters) + word[place + 1:]])
            words.append(word.upper() if rng.random() < 0.1 and word.isascii() else word)
        rows.append((i, rng.choice([" ", "\n", "1", "-", "Ā"]).join(words)))
    return rows


@pytest.mark.parametrize("crowded", [32, 3])
def test_equals_brute_force(spark, crowded):
    rows = corpus(4)
    rows += [rows[3], rows[3], (7, rows[9][1]), (None, rows[5][1]), (500, None), (501, ""), (502, "12 .")]
    assert run(spark, rows, crowded_above=crowded) == brute(rows)


def test_deleted_points(spark):
    rows = corpus(9, 60)
    assert run(spark, rows, every=2) == brute(rows, every=2)


def test_chains_ties_and_long_texts(spark):
    words = ["chain"] * 96 + ["chein"] * 40 + ["chei"] * 3 + ["cheon"] * 16 + ["pheon"] * 7 + ["pheons"] * 3 + ["gamma"] * 8 + ["lamma"] * 8 + ["mamma"] * 4
    rows = [(1, " ".join(words)), (2, "x" * 1_200_000), (3, " ".join(["chain", "y" * 70_000] * 30))]
    found = run(spark, rows, every=10**9 + 7)
    assert found == brute(rows, every=10**9 + 7)
    by = {r[0]: r for r in found}
    assert by["pheon"][5] == "chain" and by["mamma"][3] == "gamma"


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (None, None)]) == []


def test_scan_of_a_sorted_list():
    rng = random.Random(2)
    for letters in ("ab", "abcdefgh"):
        listed = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(400)})
        shared = [0] + [common_prefix(a, b) for a, b in zip(listed, listed[1:], strict=False)]
        for word in [*listed, "", "zz", "abab" * 3]:
            assert [listed[i] for i in one_edit(word, listed, shared)] == [v for v in listed if distance(v, word) == 1]
