"""License scan against plain Python."""

from __future__ import annotations

import random
import re

from tillstone.llm import license_scan as ls


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in ls.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_and_words(spark):
    rng = random.Random(3)
    pieces = ["GNU General Public License", "gnu general", "public license", "Apache-License", "CC BY", "cc, by 4.0", "MIT\nLICENSE", "mit", "É", "x1", "...", "apache", "license", "İ K"]
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randrange(25)))) for i in range(300)] + [(400, None), (401, ""), (402, "!!"), (7, "cc by"), (None, "mit license")]
    frame = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, n_words string")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in ls.license_scan(frame).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t in docs), key=str)
    assert ls.license_scan(frame.limit(0)).collect() == []


def test_own_labels(spark):
    mit = ls.MORE[11][0].split()
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", 1.0),
        (2, "under the GNU General Public License, version 3.", "gpl,gpl-3.0", 1.0),
        (3, "Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc-4.0", 1.0),
        (4, "so " + " ".join(mit[:9] + ["really"] + mit[9:]) + " end", "mit", None),
        (5, " ".join(mit[:6]), "", 0.0),
        (6, "of the license", "", 0.0),
    ]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in ls.license_scan(frame).collect()}
    for key, _, labels, score in rows:
        assert got[key].labels == labels
        assert score is None or got[key].score == score
    assert 0.85 <= got[4].score < 1


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "cc by")], "doc_id long, text string")
    plan = ls.license_scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
