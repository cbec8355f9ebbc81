"""Token counts against the vocabulary's own library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillstone.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def made(n):
    rng = random.Random(3)
    letters = "aab  e\n\t'sth12!?é漢🙂  \x1c"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(n)]
    return [t[:7] + "<|endoftext|>" + t[7:] if i % 5 == 0 else t for i, t in enumerate(out)]


def test_whole_texts(library):
    counter = tc.Counter(PATH)
    for text in [*made(3000), "a" * 4000, "the" * 900, " " * 500 + "x", "!" * 700, "\n\n a", "we'll they're I'd 'S"]:
        assert counter.count(text) == library(text)


def test_every_character_class(library):
    counter = tc.Counter(PATH)
    for code in [*range(0x3000), *range(0xA000, 0xD7FF, 37), *range(0xE000, 0x11000, 11), *range(0x1F000, 0x1FB00, 7)]:
        text = f"a{chr(code)}1 {chr(code)}{chr(code)} b"
        assert counter.count(text) == library(text), hex(code)


def test_chunks_compose(library):
    counter = tc.Counter(PATH)
    rng = random.Random(8)
    for text in made(400):
        size = rng.randrange(1, 9)
        chunks = [text[i:i + size] for i in range(0, len(text), size)] or [""]
        maps = [counter.state_map(c, i == 0, i == len(chunks) - 1) for i, c in enumerate(chunks)]
        assert counter.total(maps) == library(text)


def test_states_are_rebuilt_when_full(library, monkeypatch):
    monkeypatch.setattr(tc, "KEPT_STATES", 50)
    monkeypatch.setattr(tc, "KEPT_PRETOKENS", 20)
    counter = tc.Counter(PATH)
    for text in made(200):
        assert counter.count(text) == library(text)


def test_operator(spark, library):
    texts = [*made(40), None, "", "word " * 700, "x" * 300]
    rows = [(i % 30 if i < 43 else None, t, "a", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_tokens int")
    for chunk in (1 << 20, 50):
        got = sorted((tuple(r) for r in tc.token_counts(docs, PATH, chunk_chars=chunk).collect()), key=str)
        want = [(d, len((t or "").encode()), library(t or ""), library(t or "") > 512) for d, t, _, _ in rows]
        assert got == sorted(want, key=str)
    assert tc.token_counts(docs.limit(0), PATH).collect() == []
