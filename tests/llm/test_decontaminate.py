"""Spaced-seed decontamination against a comparison of every alignment."""

from __future__ import annotations

import random
import re

from tillstone.llm import decontaminate as dc


def words_of(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def made():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)] + ["É", "naïve"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([40, 25, 18, 12, 8, 5, 60, 40])]
    items.append((20, list(items[0][1])))
    docs = []
    for d in range(60):
        body = text(rng.choice([0, 10, 60]))
        if d % 2:
            piece = list(rng.choice(items)[1])
            a = rng.randrange(max(1, len(piece) - 18))
            piece = piece[a:] if d % 3 else piece
            for _ in range(rng.randrange(4)):
                piece[rng.randrange(len(piece))] = "changed"
            body[len(body) // 2:len(body) // 2] = piece
        docs.append((d, ", ".join(body).upper() if d % 5 == 0 else "\n".join(body)))
    return docs + [(100, ""), (101, None), (3, docs[3][1])], [(i, " ".join(w) + ".") for i, w in items] + [(30, None)]


def plain(docs, items):
    """Document, item and alignment of which a window has four fifths equal, or a short item all; no seeds."""
    out = set()
    for d, text in docs:
        a = words_of(text)
        for i, item in items:
            b = words_of(item)
            n = min(len(b), 18)
            for shift in range(-len(b), len(a)) if n >= 4 or (n and len(a) == n) else ():
                equal = [0 <= p + shift < len(a) and a[p + shift] == b[p] for p in range(len(b))]
                if any(sum(equal[p:p + n]) >= (n if n < 8 else 0.8 * n) and p + shift >= 0 and p + n + shift <= len(a) for p in range(len(b) - n + 1)):
                    out.add((d, i, shift))
    return out


def test_against_every_alignment(spark, monkeypatch):
    rng = random.Random(4)
    items = [(n, [f"k{n}x{i}" for i in range(n)]) for n in [*range(1, 26), 40]]
    docs, d = [], 0
    for n, item in items:
        may = 0 if n < 8 else n - -(-4 * n // 5) if n < 18 else 3
        places = [[p] for p in range(n)] + [rng.sample(range(n), k) for k in (may, may, may, may + 1) for _ in range(4)] + [[]]
        for changed in places:
            piece = ["changed" if p in changed else w for p, w in enumerate(item)]
            docs.append((d := d + 1, " ".join(["before"] * (d % 3) + piece + ["after"] * (d % 2))))
    more, given = made()
    docs += [(i + 10_000, x) for i, x in more if i != 3]
    items = [(n, " ".join(w)) for n, w in items] + [(i + 1000, x) for i, x in given]
    want = plain(docs, items)
    assert len(want) > 500
    for limit in (dc.SEED_LIMIT, 0):
        monkeypatch.setattr(dc, "SEED_LIMIT", limit)
        rows = dc.contaminated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
        assert len(rows) == len(want) and {(r.id, r.item_id, r.doc_start - r.item_start) for r in rows} == want
        assert all(r.doc_end - r.doc_start == r.item_end - r.item_start and 5 * r.n_equal >= 4 * (r.item_end - r.item_start) for r in rows)


def test_one_substitution_in_a_short_item_leaks(spark):
    item = [f"k{i}" for i in range(8)]
    docs = spark.createDataFrame([(p, " ".join(["a", *item[:p], "other", *item[p + 1:], "b"])) for p in range(8)], "doc_id long, text string")
    assert dc.without_contaminated(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).count() == 0


def test_short_items_are_matched_whole(spark):
    items = spark.createDataFrame([(7, "one two three four five six seven"), (3, "yes it is"), (1, "no")], "item_id long, text string")
    docs = [(1, "x one two three four five six seven y"), (2, "x one two three four five six other y"), (3, "Yes, it is!"), (4, "and yes it is so"), (5, "no"), (6, "no no")]
    got = dc.contaminated_spans(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert {(r.id, r.item_id, r.doc_start, r.doc_end) for r in got.collect()} == {(1, 7, 1, 8), (3, 3, 0, 3), (5, 1, 0, 1)}


def test_stage_and_edge_cases(spark):
    item = " ".join(f"k{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"before {item} after", "a"), (2, "clean text", "b"), (None, item, "c"), (3, None, "d")], "doc_id long, text string, id string")
    bench = spark.createDataFrame([(1, item, "x")], "item_id long, text string, seed string")
    kept = dc.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.id for r in kept.collect()} == {"b", "d"}
    assert dc.without_contaminated(docs, bench.limit(0)).count() == 4
    assert dc.contaminated_spans(docs.limit(0), bench).collect() == []
