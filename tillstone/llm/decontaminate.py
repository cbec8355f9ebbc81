"""Benchmark decontamination by spaced-seed hashing.

A mask is laid on every place of a text; the words under its set positions are hashed and those under
the others are ignored, so a substituted word spoils only the seeds that look at it. Seeds of documents
and of benchmark items are joined in Spark on their hash. Around each hit, document and item are then
compared along the hit's alignment: some window of 18 words (or the whole item, if that is shorter) must
have at least four fifths of its words equal, wherever the others are.

``EVERY`` has the masks with which no such alignment goes without a hit. A window of 18 words may lack 3,
so of its six runs of three words three are equal, and two of these are at most two runs apart. Of an item
of 12 to 17 words at least two runs of three are equal, of one of 8 to 11 at least three runs of two. So
each of these masks looks at two runs of three words or three runs of two.

An item of four to seven words has no room for a substitution: it matches where all its words stand one
after the other. One of fewer words cannot be told from ordinary phrases and matches only a document that
has no other words.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case, so marks and line breaks do
not matter. An item without words matches nothing.

The distinct seed hashes of the benchmark, if they were counted as at most ``SEED_LIMIT``, go to the tasks,
which then send only seeds that can meet; beyond that all seeds are sent and the join alone decides.

Results: one row per document, item and alignment with a verified stretch. Null and empty texts match
nothing. Repeated rows of a document give one result, as rows with the same id (null included) are one
document. Repeated items each match under their own id. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut, letting_go, lists, signed, small
from tillstone.llm.kernels import BASE, U64, Words, inside_rows, mix, slices

# Words of a window.
WINDOW = 18
# 1: looked at, 0: ignored. Two runs of three words, up to 12 apart, and three runs of two; the first is both.
EVERY = ("111111", "111000111", "111000000111", "111000000000111", "11110011", "11001111", "1111000011", "1100001111", "1100110011")
# Items from so many words on may lack some; shorter ones are matched whole.
LEAST_WORDS = 8
# Items from so many words on are looked for within documents; shorter ones are compared with whole documents.
LEAST_INSIDE = 4
SUBSTITUTION = 4
LEAST_SHARE = 0.8
SEED_LIMIT = 2_000_000

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask at every place where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    total = np.full(n, U64(len(mask)), dtype=U64)
    for at, bit in enumerate(mask):
        if bit == "1":
            total += words[at:at + n] * U64(pow(BASE, at + 1, 1 << 64))
    return mix(total)


SEEDS = "row long, id long, at int, seed long"


def needed(mask: str, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a mask is needed at a place of an item of so many words."""
    pairs, triples = mask in EVERY[:4], mask in (EVERY[0], *EVERY[4:])
    long = (length >= WINDOW) & (mask in EVERY[:2])
    middle = (length >= 12) & (length < WINDOW) & pairs & (at % 3 == 0)
    short = (length >= LEAST_WORDS) & (length < 12) & triples & (at % 2 == 0)
    whole = (length < LEAST_WORDS) & (length == len(mask)) & ("0" not in mask)
    return long | middle | short | whole


def _seeds(masks: tuple[str, ...], of_item: bool, known: np.ndarray | None):
    """Seeds of every text; of documents, only those in ``known`` where it is given."""
    table = None
    if known is not None:
        table = np.zeros(1 << 20, dtype=bool)
        table[(known >> U64(44)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                words = Words(raw, offsets, _BREAK)
                hashes = words.hashes(fold_case=True)
                sizes = np.diff(words.rows)
                owner = np.repeat(np.arange(end - first), sizes)
                rows, places, seeds = [], [], []
                for mask in masks:
                    found = seed_hashes(hashes, mask)
                    fits = inside_rows(words.rows, len(mask))[:len(found)]
                    length = sizes[owner[:len(found)]]
                    if of_item:
                        fits &= needed(mask, length, np.arange(len(found)) - words.rows[owner[:len(found)]])
                    elif len(mask) < LEAST_INSIDE:
                        fits &= length == len(mask)
                    if table is not None:
                        fits &= table[(found >> U64(44)).astype(np.int64)]
                    at = np.flatnonzero(fits)
                    if known is not None and len(at):
                        slot = np.minimum(np.searchsorted(known, found[at]), len(known) - 1)
                        at = at[known[slot] == found[at]]
                    rows.append(owner[at])
                    places.append(at - words.rows[owner[at]])
                    seeds.append(found[at])
                row = np.concatenate(rows)
                if len(row):
                    take = pa.array(row + first)
                    yield pa.record_batch([batch.column("row").take(take), batch.column("id").take(take),
                                           pa.array(np.concatenate(places).astype(np.int32)), pa.array(signed(np.concatenate(seeds)))],
                                          names=["row", "id", "at", "seed"])

    return run


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, offsets in slices(batch.column("text")):
            words = Words(raw, offsets, _BREAK)
            yield pa.record_batch([batch.column("row").slice(first, end - first), lists(signed(words.hashes(fold_case=True)), words.rows, pa.int64())],
                                  names=["row", "words"])


def best_stretch(document: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Item places from and to of the best stretch on an alignment, and its equal words."""
    low, high = max(0, -shift), min(len(item), len(document) - shift)
    if high <= low:
        return 0, 0, 0
    equal = item[low:high] == document[low + shift:high + shift]
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -SUBSTITUTION))])
    least = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - least))
    start = int(np.flatnonzero(sums[:end + 1] == least[end])[-1])
    return low + start, low + end, int(equal[start:end].sum())


def best_window(document: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """As ``best_stretch``, of the alignment as it is: the best stretch if it holds a window, else the
    window with most equal words, the first of such; nothing if that has too few."""
    low, high = max(0, -shift), min(len(item), len(document) - shift)
    width = min(len(item), WINDOW)
    if high - low < width:
        return 0, 0, 0
    sums = np.concatenate([[0], np.cumsum(item[low:high] == document[low + shift:high + shift])])
    equal = sums[width:] - sums[:-width]
    at = int(np.argmax(equal))
    if equal[at] < LEAST_SHARE * width:
        return 0, 0, 0
    a, b, n = best_stretch(document, item, shift)
    return (a, b, n) if b - a >= width else (low + at, low + at + width, int(equal[at]))


FOUND = "id long, k long, item_id long, doc_start int, doc_end int, item_start int, item_end int, n_equal int"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            document = batch.column("words")[i].values.to_numpy()
            item = batch.column("item_words")[i].values.to_numpy()
            for shift in batch.column("shifts")[i].as_py():
                a, b, equal = best_window(document, item, shift)
                if b - a >= min(len(item), WINDOW) and equal >= LEAST_SHARE * (b - a):
                    out.append((batch.column("id")[i].as_py(), batch.column("k")[i].as_py(), batch.column("item_id")[i].as_py(), a + shift, b + shift, a, b, equal))
        columns = list(zip(*out, strict=True)) if out else [()] * 8
        kinds = (*[pa.int64()] * 3, *[pa.int32()] * 5)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                              names=["id", "k", "item_id", "doc_start", "doc_end", "item_start", "item_end", "n_equal"])


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """id, item_id and the word places of every verified overlap."""
    return _spans(docs, benchmark, id_column, text_column, item_column, item_text_column).drop("k").distinct()


def _spans(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """``contaminated_spans`` with k, the hash of the text that was found."""
    items = cut(benchmark.select(F.monotonically_increasing_id().alias("row"), F.col(item_column).cast("long").alias("id"),
                                 F.coalesce(F.col(item_text_column), F.lit("")).alias("text")))
    item_words = cut(items.mapInArrow(letting_go(_word_lists), "row long, words array<long>"))
    lengths = item_words.select(F.size("words").alias("n")).filter(F.col("n").between(1, LEAST_WORDS - 1)).distinct()
    # at most seven lengths; the first mask is that of a whole item of six words already
    masks = EVERY + tuple("1" * n for n in sorted(r["n"] for r in lengths.collect()) if "1" * n not in EVERY)
    item_seeds = cut(items.mapInArrow(letting_go(_seeds(masks, True, None)), SEEDS).select(
        F.col("row").alias("item_row"), F.col("id").alias("item_id"), F.col("at").alias("item_at"), "seed"))
    distinct = item_seeds.select("seed").distinct()
    known = None
    if item_seeds.count() <= SEED_LIMIT:
        known = np.sort(distinct.toArrow().column("seed").to_numpy().astype(np.int64).view(U64))
        if not len(known):
            return docs.sparkSession.createDataFrame([], FOUND)

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                        F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("k"))
    seeds = texts.select("id", F.col("k").alias("row"), "text").mapInArrow(letting_go(_seeds(masks, False, known)), SEEDS)
    hits = seeds.join(small(item_seeds), "seed").select("id", F.col("row").alias("k"), "item_row", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    shifts = cut(hits.groupBy("id", "k", "item_row", "item_id").agg(F.collect_set("shift").alias("shifts")))

    # words of the documents that were hit; told by id and a hash of the text
    ids = small(cut(shifts.select(F.col("id").alias("hit_id")).distinct()))
    hit_texts = texts.join(ids, F.col("id").eqNullSafe(F.col("hit_id")), "left_semi").select("row", "id", "k", "text")
    words = hit_texts.mapInArrow(letting_go(_hit_words), "id long, k long, words array<long>").dropDuplicates(["id", "k"])
    joined = (shifts.join(words, shifts.id.eqNullSafe(words.id) & (shifts.k == words.k)).select(shifts.id, shifts.k, "item_row", "item_id", "shifts", "words")
              .join(small(item_words.select(F.col("row").alias("item_row"), F.col("words").alias("item_words"))), "item_row"))
    return joined.mapInArrow(letting_go(_verify), FOUND)


def _hit_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, offsets in slices(batch.column("text")):
            words = Words(raw, offsets, _BREAK)
            yield pa.record_batch([batch.column("id").slice(first, end - first), batch.column("k").slice(first, end - first),
                                   lists(signed(words.hashes(fold_case=True)), words.rows, pa.int64())], names=["id", "k", "words"])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents, all columns, that overlap with no benchmark item; told by id and a hash of the text."""
    found = _spans(docs, benchmark, id_column)
    leaked = small(cut(found.select(F.col("id").alias("__leaked"), F.col("k").alias("__k")).distinct()))
    same = docs[id_column].cast("long").eqNullSafe(leaked["__leaked"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == leaked["__k"])
    return docs.join(leaked, same, "left_anti")
