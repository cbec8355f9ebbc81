"""Language identification by words first, with back-off to shorter character n-grams.

A known word scores by its log frequency in each language. A word that training did not keep scores by
its known character n-grams of the longest length of which it has any, at a fixed discount for each
step down, so that a new word is still judged by its parts. Word boundaries count as characters. Words
are runs of letters in lower case, so digits, signs and markup play no part.

The model is fitted on a bounded sample of labelled rows: at most ``sample_rows`` of them in expectation,
taken by a hash of the id over the whole table. Each language has the same quota of it, and what small
languages leave of theirs goes to the others, so a rare language is learned from all its rows. Words and n-grams are counted in the tasks before they are
shuffled. What the model keeps is bounded by the sample. Prediction reads every whole text.

Results: a null text, a text without a letter and a model without languages give ``und`` and score 0.
The score is the share of the predicted language in the total likelihood. Ties go to the language that
comes first in the alphabet. Rows are predicted one by one, repeated or not; a null id counts as the
empty text for the fold. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import let_go, letting_go, small

SAMPLE_ROWS = 8000
LEAST_COUNT = 3  # of a word or n-gram that the model keeps
LONGEST = 4
BACK_OFF = math.log(0.4)
KEPT_WORDS = 150_000
UNDECIDED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, size: int) -> list[str]:
    marked = f"^{word}$" if size > 1 else word
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (size 0) and n-grams of the rows of a task, by language."""
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            words.setdefault(lang, Counter()).update(_LETTERS.findall(text.as_py().lower()))
    for lang, counts in words.items():
        parts: dict[int, Counter] = {size: Counter() for size in range(1, LONGEST + 1)}
        for word, n in counts.items():
            for size, counter in parts.items():
                for gram in grams(word, size):
                    counter[gram] += n
        for size, counter in ((0, counts), *parts.items()):
            yield pa.record_batch([pa.array([lang] * len(counter)), pa.array([size] * len(counter), pa.int32()), pa.array(list(counter), pa.string()),
                                   pa.array(list(counter.values()), pa.int64())], names=["lang", "size", "item", "n"])


class Model:
    """Log frequencies by language: for each length the row of every item, and the rows of all items as one array."""

    def __init__(self, languages: list[str], tables: list[tuple[dict[str, int], np.ndarray]]):
        self.languages, self.tables = languages, tables

    def word(self, word: str) -> list[float]:
        rows, scores = self.tables[0]
        known = rows.get(word)
        if known is not None:
            return scores[known].tolist()
        for size in range(LONGEST, 0, -1):
            rows, scores = self.tables[size]
            found = [rows[g] for g in grams(word, size) if g in rows]
            if found:
                step = BACK_OFF * (LONGEST + 1 - size)
                return [sum(column) / len(found) + step for column in zip(*scores[found].tolist(), strict=True)]
        return [0.0] * len(self.languages)


def quota(sizes: list[int], total: int) -> float:
    """Most rows of one language, with which all languages together have ``total`` rows."""
    left = float(total)
    for k, n in enumerate(sorted(sizes)):
        share = left / (len(sizes) - k)
        if n >= share:
            return share
        left -= n
    return math.inf


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from the columns id, text and lang; rows without text or lang are left out."""
    rows = labelled.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = quota(list(sizes.values()), sample_rows)
    bounds = labelled.sparkSession.createDataFrame([(lang, int(min(1.0, most / n) * (1 << 30))) for lang, n in sizes.items()], "lang string, bound long")
    chosen = rows.join(small(bounds), "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("bound")).select("lang", "text")
    counts = (chosen.mapInArrow(letting_go(_count), "lang string, size int, item string, n long")
              .groupBy("lang", "size", "item").agg(F.sum("n").alias("n")))
    # a total over all languages decides whether an item is kept
    kept = counts.groupBy("size", "item").agg(F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("all"))
    found = kept.filter(F.col("all") >= LEAST_COUNT).select("size", "item", "by").toArrow()
    return _model(found)


def _model(found: pa.Table) -> Model:
    by = found.column("by").combine_chunks()
    if len(by) == 0:
        return Model([], [({}, np.zeros((0, 0), dtype=np.float32)) for _ in range(LONGEST + 1)])
    inner = by.flatten()
    lang_of = inner.field("lang").to_pylist()
    languages = sorted(set(lang_of))
    column = {name: i for i, name in enumerate(languages)}
    row = np.repeat(np.arange(len(by)), np.diff(by.offsets.to_numpy()))
    seen = np.zeros((len(by), len(languages)), dtype=np.float64)
    seen[row, [column[x] for x in lang_of]] = inner.field("n").to_numpy()
    sizes = found.column("size").to_numpy()
    items = found.column("item").to_pylist()
    tables: list[tuple[dict[str, int], np.ndarray]] = []
    for size in range(LONGEST + 1):
        at = np.flatnonzero(sizes == size)
        part = seen[at]
        scores = np.log((part + 0.5) / (part.sum(axis=0) + 0.5 * max(len(at), 1))).astype(np.float32)
        tables.append(({items[i]: k for k, i in enumerate(at)}, scores))
    return Model(languages, tables)


class _Scores(dict):
    """Row of a word in a growing table of scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.table = np.zeros((1024, len(model.languages)), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.model.word(word)
        self[word] = at
        return at


def predictor(spark, model: Model):
    """Column function text -> (lang, score).

    The model travels as arrays; its tables and the scores of words seen live for one task only, so that
    they take no memory from what the worker does next. Texts stay Arrow buffers and are taken one by one, since
    the strings of a batch are as large as the rest of a task.
    """
    packed = [(pa.array(list(rows), pa.string()), scores) for rows, scores in model.tables]
    shared = spark.sparkContext.broadcast((model.languages, packed))

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        languages, tables = shared.value
        scores = _Scores(Model(languages, [({item.as_py(): k for k, item in enumerate(items)}, rows) for items, rows in tables]))
        try:
            for texts in batches:
                yield judged(texts, scores)
        finally:
            del scores
            let_go()

    return predict


def judged(texts: pa.Array, scores: _Scores) -> pa.Array:
    """Language and score of each text."""
    languages = scores.model.languages
    names, shares = [], []
    for item in texts:
        text = item.as_py()
        words = _LETTERS.findall(text.lower()) if text else []
        if not languages or not any(c.isalpha() for w in words for c in w):
            names.append(UNDECIDED)
            shares.append(0.0)
            continue
        if len(scores) > KEPT_WORDS:
            scores.clear()
        at = np.fromiter(map(scores.__getitem__, words), dtype=np.int64, count=len(words))
        total = scores.table[at].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        names.append(languages[best])
        shares.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=["lang", "score"])


def held_out(id_column: str):
    """One fold of five, by a checksum of the id, is never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fitted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    return fit(docs.filter(~held_out(id_column)).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")), sample_rows)


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    predict = predictor(docs.sparkSession, fitted(docs, id_column, text_column, lang_column, sample_rows))
    return docs.select(F.col(id_column).cast("long").alias(id_column), held_out(id_column).alias("held_out"), predict(F.col(text_column)).alias("p")).select(
        id_column, "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def with_language(docs: DataFrame, least_score: float = 0.5, id_column: str = "doc_id", text_column: str = "text",
                  lang_column: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents, all columns, that have a language the model decides on with at least this score."""
    predict = predictor(docs.sparkSession, fitted(docs, id_column, text_column, lang_column, sample_rows))
    found = predict(F.col(text_column))
    return docs.filter(F.when(found["lang"] != UNDECIDED, found["score"]).otherwise(0.0) >= least_score)
