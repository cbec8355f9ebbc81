"""Removal of long repeated word spans, by compaction of the De Bruijn graph of word windows.

Every window of ``window`` words is an edge of the graph. Neighbouring windows that have the same anchor
(their leftmost least gram of a few words) are taken as one path, a run; equal windows have equal
anchors at equal places, so two documents can share windows only in runs with the same anchor. The runs
are grouped by anchor and content in Spark. An anchor with a single content is a nonbranching path: all
its windows occur in the same documents, and the path compacts to one item with its smallest document.
Where contents of an anchor differ, the path branches inside the runs; only one run for each content,
that of its smallest document, is opened, and its windows are compared one by one at their source
coordinates. All other occurrences follow from the smallest document of their content.

Decided on the input as it is: a window is a repeat if its words also start in a document with a
smaller id, and every word that a repeated window covers is removed. A path of runs needs no walk from
document to document, so there is no iteration.

Results: one row per input row. A null text has no words. Rows with the same id are one document, none
of them smaller than another; a row without an id comes after all others. Texts shorter than a window
keep all words. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut, letting_go, lists, signed, small
from tillstone.llm.kernels import SECOND_BASE, Prefix, Words, anchor_runs, mix, slices

WINDOW = 50
GRAM = 12
LAST_ID = (1 << 63) - 1
KEY = ("id", "k1", "k2")

# Runs are kept as parallel arrays, which take less than half the room of an array of structs.
SCANNED = ("row long, id long, k1 long, k2 int, n_words long, sha string, "
           "anchor array<bigint>, content array<bigint>, start array<int>, count array<int>")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id and text of every row, with two hashes that tell texts of the same id apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("k1"),
                       F.hash(text).alias("k2"), text.alias("text"))


def _scan(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                words = Words(raw, offsets)
                row, start, count, anchor, content, _ = anchor_runs(words.hashes(), words.rows, window, gram)
                bounds = np.searchsorted(row, np.arange(end - first + 1))
                data = raw.tobytes()
                shas = [hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                start = start - words.rows[row]
                yield pa.record_batch([
                    *(batch.column(c).slice(first, end - first) for c in ("row", "id", "k1", "k2")),
                    pa.array(np.diff(words.rows), pa.int64()), pa.array(shas, pa.string()),
                    lists(signed(anchor), bounds, pa.int64()), lists(signed(content), bounds, pa.int64()),
                    lists(start.astype(np.int32), bounds, pa.int32()), lists(count.astype(np.int32), bounds, pa.int32()),
                ], names=["row", "id", "k1", "k2", "n_words", "sha", "anchor", "content", "start", "count"])

    return run


def _open_windows(window: int):
    """Two hashes, document and place of every window of the runs that are to be opened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                words = Words(raw, offsets)
                hashes = words.hashes()
                places, rows = [], []
                for i in range(first, end):
                    base = words.rows[i - first]
                    for span in batch.column("spans")[i].as_py():
                        if span["opened"]:
                            places.append(np.arange(span["start"], span["start"] + span["count"]) + base)
                            rows.append(np.full(span["count"], i))
                if not places:
                    continue
                at, row = np.concatenate(places), np.concatenate(rows)
                one, two = (Prefix(v, b).span(at, at + window) for v, b in ((hashes, SECOND_BASE), (mix(hashes), SECOND_BASE)))
                take = pa.array(row)
                yield pa.record_batch([
                    pa.array(signed(one)), pa.array(signed(two)), batch.column("id").take(take), batch.column("x").take(take),
                    pa.array((at - words.rows[row - first]).astype(np.int32)),
                ], names=["h1", "h2", "id", "x", "at"])

    return run


def removed_words(n: int, spans: list[dict], marks: list[int] | None, window: int) -> np.ndarray:
    """Which of n words a repeated window covers."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for span in spans:
        if not span["opened"]:
            edges[span["start"]] += 1
            edges[span["start"] + span["count"] + window - 1] -= 1
    if marks:
        at = np.asarray(marks, dtype=np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:n] > 0


CLEANED = "id long, k1 long, k2 int, n_removed long, kept_sha string, kept_text string"


def _clean(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                words = Words(raw, offsets)
                data = raw.tobytes()
                counts, shas, kept_texts = [], [], []
                for i in range(first, end):
                    low, high = words.rows[i - first], words.rows[i - first + 1]
                    gone = removed_words(high - low, batch.column("spans")[i].as_py(), batch.column("marks")[i].as_py(), window)
                    text = data[offsets[i - first]:offsets[i - first + 1]]
                    kept = [w for w, g in zip(text.split(), gone.tolist(), strict=True) if not g]
                    counts.append(int(gone.sum()))
                    shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                    kept_texts.append(without(data, words.start[low:high], words.end[low:high], gone, int(offsets[i - first]), int(offsets[i - first + 1])) if texts else None)
                yield pa.record_batch([
                    *(batch.column(c).slice(first, end - first) for c in KEY), pa.array(counts, pa.int64()),
                    pa.array(shas, pa.string()), pa.array(kept_texts, pa.string()),
                ], names=[*KEY, "n_removed", "kept_sha", "kept_text"])

    return run


def without(data: bytes, start: np.ndarray, end: np.ndarray, gone: np.ndarray, first: int, last: int) -> str:
    """The text without its removed words and the white space after each of them."""
    pieces, at = [], first
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        pieces.append(data[at:start[a]])
        at = int(start[b]) if b < len(start) else int(end[b - 1])
    pieces.append(data[at:last])
    return b"".join(pieces).decode("utf-8")


def repeated_spans(scanned: DataFrame) -> DataFrame:
    """(id, k1, k2, spans) of documents with runs that are repeats as a whole or have to be opened."""
    runs = scanned.select(*KEY, F.inline(F.arrays_zip("anchor", "content", "start", "count")))
    contents = runs.groupBy("anchor", "content").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    anchors = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.min("least").alias("first"), F.max("most").alias("last"))
    anchors = anchors.filter("first < last")
    paths = contents.join(anchors, "anchor").filter("least < most or contents > 1").select("anchor", "content", "least", "contents")
    found = runs.join(paths, ["anchor", "content"]).withColumn("opened", F.col("id") == F.col("least")).filter("not opened or contents > 1")
    return found.groupBy(*KEY).agg(F.collect_set(F.struct("start", "count", "opened")).alias("spans"))


def _cleaned(texts: DataFrame, scanned: DataFrame, window: int, with_texts: bool) -> DataFrame:
    spans = cut(repeated_spans(scanned))
    ids = small(cut(spans.select("id").distinct()))
    found = cut(texts.join(ids, "id", "left_semi").join(spans, list(KEY)).withColumn("x", F.monotonically_increasing_id()))
    windows = found.filter(F.exists("spans", lambda s: s["opened"])).mapInArrow(
        _open_windows(window), "h1 long, h2 long, id long, x long, at int")
    windows = cut(windows)
    least = windows.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    marks = windows.join(least, ["h1", "h2"]).filter("least < id").groupBy("x").agg(F.collect_set("at").alias("marks"))
    marked = found.join(marks, "x", "left").filter(F.col("marks").isNotNull() | F.exists("spans", lambda s: ~s["opened"]))
    return marked.mapInArrow(letting_go(_clean(window, with_texts)), CLEANED).dropDuplicates(list(KEY))


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of every row."""
    texts = keyed(docs, id_column, text_column)
    scanned = cut(texts.select(F.monotonically_increasing_id().alias("row"), *KEY, "text").mapInArrow(letting_go(_scan(window, gram)), SCANNED))
    cleaned = _cleaned(texts, scanned, window, with_texts=False).select(*KEY, "n_removed", "kept_sha")
    return scanned.select(*KEY, "n_words", "sha").join(cleaned, list(KEY), "left").select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_column), "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, with repeated spans cut out of their texts; those left without a
    word by this are dropped."""
    texts = keyed(docs, id_column, text_column)
    scanned = cut(texts.select(F.monotonically_increasing_id().alias("row"), *KEY, "text").mapInArrow(letting_go(_scan(window, gram)), SCANNED))
    cleaned = cut(_cleaned(texts, scanned, window, with_texts=True).filter("n_removed > 0").select(
        *(F.col(c).alias(f"__{c}") for c in KEY), F.col("kept_text").alias("__kept")))
    ids = small(cut(cleaned.select("__id").distinct()))
    names = docs.columns
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID))
    same = docs.join(ids, key == ids["__id"], "left_anti")
    text = F.coalesce(F.col(text_column), F.lit(""))
    changed = docs.join(ids, key == ids["__id"], "left_semi").join(
        cleaned, (key == F.col("__id")) & (F.xxhash64(text) == F.col("__k1")) & (F.hash(text) == F.col("__k2")), "left")
    changed = changed.filter("__kept is null or trim(__kept) <> ''")
    return same.unionByName(changed.select(*(F.coalesce("__kept", text_column).alias(c) if c == text_column else F.col(c) for c in names)))
