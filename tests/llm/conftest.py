from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def sample_docs():
    """Documents with exact and near copies, a hot passage, odd white space, empty and null texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["The", "the", "É", "über", "a-b", "x" * 60]
    passage = [rng.choice(words) for _ in range(70)]
    docs = []
    for _ in range(60):
        docs.append([rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 30, 120, 300]))])
    for _ in range(40):
        copy = list(rng.choice(docs[:60]))
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        docs.append(copy)
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.choice([0, 10, 80]))]
        docs.append(own[:5] + passage + own[5:])
    texts = [rng.choice([" ", "\n", "\t ", "  "]).join(d) for d in docs] + ["", None, "   ", " ", "one", "ONE", "one two"]
    texts += ["ab " * 300, "ab " * 301, ("cd ef " * 200) + "end"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))
