from __future__ import annotations

import hashlib
import random
import re

from tillstone.llm.personal_data import estimate, personal_data

SCHEMA = "doc_id bigint, text string, kind string, found string, base int, votes string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, word):
    digits = re.sub("[^0-9]", "", word)
    if kind == "ip":
        return all(int(part) <= 255 for part in word.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(rows):
    out = []
    for doc_id, text in rows:
        spans = [(m.start(), i, m.end(), kind) for i, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(kind, m.group())]
        joined = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))
        out.append((doc_id, *[sum(x[3] == kind for x in spans) for kind in PATTERNS], hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "a", "b", 1, "c") for i, t in rows], SCHEMA).repartition(3)
    return personal_data(df).collect()


def base_of(found):
    return sorted((tuple(r)[:6] for r in found), key=repr)


def test_base_equals_brute_force(spark):
    rng = random.Random(8)
    bits = ["a@b.c", "_d@e.f", "x.y@", "@", ".", "-", "+", "(", ")", " ", "  ", "1", "12", "255", "256", "0", "é", "𝒳", "4111 1111 1111 1111",
            "378282246310005", "+1 (377) 555-0271", "10.0.0.1", "1.2.3", "\n", "%", "007", "abc", "a-b.co", "+49 30 1234567", "😀", "192.168.000.255", "5105-1051-0510-5100"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.choice([1, 5, 30, 120])))) for i in range(400)]
    rows += [rows[3], rows[3], (5, rows[7][1]), (None, rows[9][1]), (None, None), (600, None), (601, ""), (602, "+1"), (603, "a@b.c" * 3000)]
    assert base_of(run(spark, rows)) == brute(rows)


def runs(n):
    return ["9" * n, "a" * n, "a." * n, "a@" + "b." * n + "c", "1." * n, "+1" + " " * n, "0" * n + "1.2.3.4", "1 " * n]


def test_long_runs_and_many_matches(spark):
    rows = list(enumerate([*runs(4_000), "4111111111111111 a@b.co 10.0.0.1 " * 3000]))
    assert base_of(run(spark, rows)) == brute(rows)


def test_very_long_runs(spark):
    """A plain search would take hours and a recursive one all of the stack."""
    rows = list(enumerate(runs(400_000)))
    found = {r.doc_id: tuple(r)[1:5] for r in run(spark, rows)}
    none = (0, 0, 0, 0)
    assert found == {0: none, 1: none, 2: none, 3: (1, 0, 0, 0), 4: (0, 100_000, 0, 0), 5: none, 6: (0, 1, 0, 0), 7: none}


def test_spans_are_added_and_decoys_are_not(spark):
    rng = random.Random(1)
    rows, want, without = [], {}, set()
    for i in range(200):
        word = rng.choice(["alpha", "beta", "gamma", "delta"])
        text, kind = rng.choice([
            (f"please write to {word}{i} [at] mail{i % 7} [dot] com today", "email"), (f"you can call (212) 555-{1000 + i} today", "phone"),
            (f"ssn 219-09-{1000 + i} on file", "ssn"), (f"version 000-00-0000x build {i} of {word}", None), (f"seen {word} at noon.{word} went on", None), (f"order 4111 {word}", None),
        ])
        rows.append((i, text))
        if kind:
            want[i] = kind
        else:
            without.add(i)
    found = {r.doc_id: r for r in run(spark, rows)}
    caught = sum(found[i].spans.startswith(kind) for i, kind in want.items())
    assert caught == len(want) and all(found[i].spans == "" for i in without)
    i, kind = next(iter((i, k) for i, k in want.items() if k == "ssn"))
    start = rows[i][1].index("219")
    assert found[i].spans == f"ssn:{start}:{start + 11}" and found[i].n_added == 1


def test_empty(spark):
    assert run(spark, []) == []
    row = run(spark, [(1, None)])[0]
    assert row.spans == "" and row.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_reliabilities_are_found():
    rng = random.Random(3)
    right = [0.95, 0.9, 0.6, 0.8, 0.7]
    counts, truth = {}, {}
    for _ in range(20_000):
        true = rng.random() < 0.3
        votes = "".join("0" if rng.random() < 0.1 else "+-"[(rng.random() < r) != true] for r in right)
        counts["k", votes] = counts.get(("k", votes), 0) + 1
        truth[votes] = truth.get(votes, 0) + true
    believed = estimate(counts)
    error = sum(n * abs(believed[key] - truth[key[1]] / n) for key, n in counts.items()) / 20_000
    assert error < 0.03
