"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Two suffixes that agree on ``window`` bytes have the same anchor (leftmost least gram) in those bytes, at
the same distance. So suffixes are dealt into buckets by their anchor (where it is crowded, also by the
bytes on the side of it that reaches further), and only suffixes of one bucket can agree. A run of suffixes of one text with one
anchor travels as one piece of text, not suffix by suffix. Runs whose whole bytes occur again are
repeats as they stand and are folded by Spark; of a bucket, only pieces with different bytes are sorted.

Buckets are sorted a block at a time. A block holds its pieces, each placed so that its anchor falls on
a multiple of the cover's period. Ranks of the cover sample (positions whose residue is in the
difference cover) are computed first, to the depth that is needed; then the block's suffixes are sorted
by their first 64 bytes, and ties are resolved by the ranks of the next cover positions, which equal
suffixes reach after equally many bytes. No text is compared beyond 64 bytes, and memory is bounded by
the block, apart from a bucket that is larger than a block by itself. Suffixes whose hash occurs once in
the block are settled without being sorted.

Results: one row per input row, decided on the input as it is. A null text is empty. A repeated row is
text that occurs again. Rows without id are kept as rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut, lists, signed, small
from tillstone.llm.kernels import U64, Prefix, anchor_runs, byte_values, mix, slices
from tillstone.llm.substring_dedup import KEY, LAST_ID, keyed

WINDOW = 400
GRAM = 48
PERIOD = 64
SHORT = 64
DEPTH = 256
BLOCK_BYTES = 4 << 20

# Different contents of an anchor beyond which its bucket is parted by the bytes beside the anchor.
CROWDED = 64
SCANNED = ("row long, id long, k1 long, k2 int, n_bytes long, sha string, "
           "anchor array<bigint>, content array<bigint>, start array<int>, count array<int>, at array<int>")


def cover(period: int = PERIOD) -> np.ndarray:
    """Residues whose differences give every residue: the first few, and the multiples of that many."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(step), np.arange(0, period, step)]))


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the key tuples, equal ones alike, in order."""
    rank = np.unique(keys[0], return_inverse=True)[1]
    for key in keys[1:]:
        rank = np.unique(rank.astype(U64) * U64(int(key.max(initial=0)) + 1) + key.astype(U64), return_inverse=True)[1]
    return rank


def _spelled(text: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Ranks of the ``width`` bytes at each place, in order of the bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(text, width)[places]
    return np.unique(np.ascontiguousarray(rows).view(f"S{width}").ravel(), return_inverse=True)[1]


def block_ranks(text: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rank of each suffix by its first ``window`` bytes; starts that can agree have equal residues."""
    if window < DEPTH + 2 * SHORT:
        raise ValueError("the window is too short for the cover's depth")
    in_cover = np.zeros(PERIOD, dtype=bool)
    in_cover[cover()] = True
    # distance from a residue forward, and back, to the cover
    ahead = np.array([next(d for d in range(PERIOD) if in_cover[(r + d) % PERIOD]) for r in range(PERIOD)])
    back = np.array([next(d for d in range(PERIOD) if in_cover[(r - d) % PERIOD]) for r in range(PERIOD)])
    near = starts + ahead[starts % PERIOD]
    far = starts + window - DEPTH
    far = far - back[far % PERIOD]
    # ranks of the cover sample, as far as suffixes lead to it
    sample, slot = np.unique(np.concatenate([near, far]), return_inverse=True)
    deep = _spelled(text, sample, DEPTH)[slot]
    # a suffix is placed by its first bytes; ties go by the cover, then by the last bytes beyond it
    short = _spelled(text, np.concatenate([starts, starts + window - SHORT]), SHORT)
    n = len(starts)
    return _dense(short[:n], deep[:n], deep[n:], short[n:])


def _scan(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                row, start, count, anchor, content, at = anchor_runs(byte_values(raw), offsets, window, gram)
                bounds = np.searchsorted(row, np.arange(end - first + 1))
                data = raw.tobytes()
                shas = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                base = offsets[row]
                yield pa.record_batch([
                    *(batch.column(c).slice(first, end - first) for c in ("row", "id", "k1", "k2")),
                    pa.array(np.diff(offsets), pa.int64()), pa.array(shas, pa.string()),
                    lists(signed(anchor), bounds, pa.int64()), lists(signed(content), bounds, pa.int64()),
                    *(lists(x.astype(np.int32), bounds, pa.int32()) for x in (start - base, count, at - base)),
                ], names=["row", "id", "k1", "k2", "n_bytes", "sha", "anchor", "content", "start", "count", "at"])

    return run


PIECES = "bucket long, x long, start int, count int, lead int, piece binary"


def _pieces(window: int, gram: int):
    """Texts of the opened runs, one bucket for each anchor.

    Where an anchor has many contents, as in a line that many texts hold, a run is halved by the side on
    which its windows reach further from the anchor, and the bytes there are part of the bucket.
    """
    half = (window - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, end, raw, offsets in slices(batch.column("text")):
                data, parts = raw.tobytes(), []
                for i in range(first, end):
                    base, x = int(offsets[i - first]), batch.column("x")[i].as_py()
                    for s in batch.column("spans")[i].as_py():
                        if not s["opened"]:
                            continue
                        start, at = s["start"], s["at"]
                        stop = start + s["count"]
                        if not s["crowded"]:
                            parts.append((base, x, start, stop, at, at, at + gram))
                            continue
                        middle = min(max(at - half, start), stop)
                        for a, b, low, high in ((start, middle, at - half - 1, at + gram), (middle, stop, at, at - half + window)):
                            if b > a:
                                parts.append((base, x, a, b, at, low, high))
                if parts:
                    first_byte, low, high = (np.array([p[k] for p in parts]) for k in (0, 5, 6))
                    side = Prefix(byte_values(raw)).span(first_byte + low, first_byte + high)
                    buckets = mix(side ^ (high - low).astype(U64)).view(np.int64).tolist()
                    out += [(bucket, x, a, b - a, at - a, data[base + a:base + b + window - 1])
                            for bucket, (base, x, a, b, at, _, _) in zip(buckets, parts, strict=True)]
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["bucket", "x", "start", "count", "lead", "piece"])

    return run


def sort_block(pieces: list[bytes], counts: np.ndarray, leads: np.ndarray, window: int) -> list[np.ndarray]:
    """For each piece, which of its windows equal another window of the block."""
    places, texts, at = [], [], 0
    for piece, lead in zip(pieces, leads.tolist(), strict=True):
        gap = -(at + lead) % PERIOD
        texts.append(b"\0" * gap + piece)
        places.append(at + gap)
        at += gap + len(piece)
    starts = np.repeat(np.array(places) - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    # a suffix whose hash is alone has no equal and need not be sorted
    hashes = Prefix(byte_values(text)).span(starts, starts + window)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    tied = np.zeros(len(starts), dtype=bool)
    tied[order[1:][same]] = tied[order[:-1][same]] = True
    again = np.zeros(len(starts), dtype=bool)
    if tied.any():
        ranks = block_ranks(text, starts[tied], window)
        again[tied] = np.bincount(ranks)[ranks] > 1
    return np.split(again, np.cumsum(counts)[:-1])


def _sort_blocks(window: int):
    """Buckets come sorted; whole buckets are gathered into a block until it is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, open_from = 0, 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            marks = sort_block([r[5] for r in rows], np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), window)
            x, start, count = [], [], []
            for row, again in zip(rows, marks, strict=True):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
                x += [row[1]] * (len(edge) // 2)
                start += (edge[::2] + row[2]).tolist()
                count += (edge[1::2] - edge[::2]).tolist()
            return pa.record_batch([pa.array(x, pa.int64()), pa.array(start, pa.int32()), pa.array(count, pa.int32())],
                                   names=["x", "start", "count"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "x", "start", "count", "lead", "piece")), strict=True):
                if held and held[-1][0] != row[0]:
                    # a bucket of one piece has nothing to be compared with
                    if len(held) - open_from == 1:
                        size -= len(held.pop()[5])
                    open_from = len(held)
                    if size >= BLOCK_BYTES:
                        yield flush(held)
                        held, size, open_from = [], 0, 0
                held.append(row)
                size += len(row[5])
        if len(held) - open_from == 1:
            held.pop()
        if held:
            yield flush(held)

    return run


CLEANED = "id long, k1 long, k2 int, n_removed long, n_spans long, kept_sha string"


def _clean(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, shas = [], [], []
            for text, runs, marks in zip(batch.column("text"), batch.column("spans").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                data = text.as_py().encode("utf-8")
                found = [(r["start"], r["start"] + r["count"] + window - 1) for r in runs if r["whole"]]
                found += [(m["start"], m["start"] + m["count"] + window - 1) for m in marks or []]
                removed, pieces, n, at = 0, [], 0, 0
                last = -1
                for a, b in sorted(found):
                    if a > last:
                        n += 1
                        pieces.append(data[at:a])
                    removed += max(0, b - max(a, last))
                    last = max(last, b)
                    at = last
                pieces.append(data[at:])
                counts.append(removed)
                spans.append(n)
                shas.append(hashlib.sha256(b"".join(pieces)).hexdigest())
            yield pa.record_batch([*(batch.column(c) for c in KEY), pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string())],
                                  names=[*KEY, "n_removed", "n_spans", "kept_sha"])

    return run


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts = keyed(docs, id_column, text_column)
    scanned = cut(texts.select(F.monotonically_increasing_id().alias("row"), *KEY, "text").mapInArrow(_scan(window, gram), SCANNED))
    runs = scanned.select("row", *KEY, F.inline(F.arrays_zip("anchor", "content", "start", "count", "at")))
    contents = runs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("times"), F.min("row").alias("first_row"))
    anchors = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.sum("times").alias("all")).filter("all > 1")
    repeated = contents.join(anchors, "anchor").select("anchor", "content", "times", "contents", "first_row")
    found = runs.join(repeated, ["anchor", "content"]).withColumn("whole", F.col("times") > 1).withColumn(
        "opened", (F.col("contents") > 1) & (F.col("row") == F.col("first_row"))).withColumn("crowded", F.col("contents") > CROWDED).filter("whole or opened")
    spans = cut(found.groupBy(*KEY).agg(F.collect_set(F.struct("start", "count", "at", "whole", "opened", "crowded")).alias("spans")))

    ids = small(cut(spans.select("id").distinct()))
    opened = cut(texts.join(ids, "id", "left_semi").join(spans, list(KEY)).withColumn("x", F.monotonically_increasing_id()))
    pieces = opened.filter(F.exists("spans", lambda s: s["opened"])).mapInArrow(_pieces(window, gram), PIECES)
    marks = pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sort_blocks(window), "x long, start int, count int")
    marks = marks.groupBy("x").agg(F.collect_list(F.struct("start", "count")).alias("marks"))
    cleaned = (opened.join(marks, "x", "left").filter(F.col("marks").isNotNull() | F.exists("spans", lambda s: s["whole"]))
               .mapInArrow(_clean(window), CLEANED).dropDuplicates(list(KEY)))
    return scanned.select(*KEY, "n_bytes", "sha").join(cleaned, list(KEY), "left").select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_column), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))
