"""Spelling variants: words of one edit are found by dynamic programming over sorted lists.

Words are counted task by task and document by document; only distinct words travel. Two words one edit
apart agree outside the place of the edit. So the shorter word is cut into ``PIECES`` pieces, and for each
piece a word joins the group of words with the same text before and after that piece: every near pair meets
in the group of the piece that holds its edit. A group of more than ``CROWDED`` words is parted once more,
by each place within its piece; such a group differs in one code point, or two in the longer words, so its
size is bounded by the letters and not by the vocabulary. Spark deals the groups out by key and sorts them.

Within a group the words are a sorted list. For each word the edit matrix against the list is filled row by
row, a row for each code point of the list's words and three cells wide (words one edit apart never leave
that band). Neighbours in the list share the rows of their common prefix. Where every cell of a row is
beyond one edit, all words that share the prefix are skipped.

A pair is told by the first of its groups only, so counts need no second look. Forms are followed to roots
by doubling: each round a word's root becomes its root's root.

Results: one row for each word of at least ``least_length`` code points that occurs ``least_count`` times.
Null and empty texts have no words; a repeated row counts again; a null id is read as an empty one. Of near
words with equal counts the smallest in code-point order is the form. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut, small

LETTERS = "[A-Za-zÀ-ÿ]"
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
PIECES = 3
CROWDED = 32
# Distinct words a task holds before it passes their counts on to the shuffle.
HELD_WORDS = 200_000
LAST = "\U0010ffff"


def noisy(doc_id, run: str, every: int) -> str:
    """The run, or the run without one code point where the hash of id and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1:]


def _counts(batches: Iterator[pa.RecordBatch], every: int, least_length: int) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    # a shorter run can only lose a code point; a run that is long enough is matched whole from its start
    runs = re.compile(f"{LETTERS}{{{least_length},}}")
    for batch in batches:
        for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
            text = text.as_py()
            if not text:
                continue
            doc_id = doc_id.as_py()
            lowered: Counter[str] = Counter()
            for run, n in Counter(runs.findall(text)).items():
                lowered[run.lower() if run.isascii() else run.translate(LOWER)] += n
            for run, n in lowered.items():
                word = noisy(doc_id, run, every)
                if len(word) >= least_length:
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield _counted(held)
                held.clear()
    yield _counted(held)


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of every word that is long and frequent enough."""
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    counts = texts.mapInArrow(lambda batches: _counts(batches, every, least_length), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def cuts(length: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a word of ``length`` code points."""
    pieces = min(PIECES, length)
    return [(i * length // pieces, (i + 1) * length // pieces) for i in range(pieces)]


def around(word: str, length: int, start: int, end: int) -> tuple[str, str]:
    """What stands before and after a piece, for words of ``length`` code points and of one more."""
    return word[:start], word[len(word) - (length - end):]


def group_key(length: int, start: int, end: int, parts: tuple[str, str]) -> str:
    return f"{length},{start},{end},{parts[0]},{parts[1]}"


def _read_key(key: str) -> tuple[int, int, int]:
    length, start, end, _ = key.split(",", 3)
    return int(length), int(start), int(end)


def coarse_keys(word: str) -> Iterator[str]:
    """Groups of a word: a pair is looked up by the length of its shorter word, so there are two lengths."""
    for length in {len(word), max(len(word) - 1, 1)}:
        for start, end in cuts(length):
            yield group_key(length, start, end, around(word, length, start, end))


def fine_keys(word: str, key: str) -> Iterator[str]:
    """Groups of a word within a crowded group, one for each place of its piece."""
    length, start, end = _read_key(key)
    for place in range(start, end):
        yield group_key(length, place, place + 1, around(word, length, place, place + 1)) + f",{start},{end}"


def told_before(a: str, b: str, length: int, start: int, end: int, within: tuple[int, int] | None) -> bool:
    """Whether an earlier group holds the pair too: an earlier piece, or an earlier place of the same piece."""
    lead = within or (start, end)
    if any(around(a, length, *piece) == around(b, length, *piece) for piece in cuts(length) if piece[0] < lead[0]):
        return True
    return within is not None and any(
        around(a, length, place, place + 1) == around(b, length, place, place + 1) for place in range(within[0], start))


def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def one_edit(word: str, listed: list[str], shared: list[int]) -> Iterator[int]:
    """Places in the sorted list of the words exactly one edit from ``word``.

    ``shared[i]`` is the length of the common prefix of listed[i - 1] and listed[i].
    """
    size = len(word)
    # rows[d]: edits between the list word's first d code points and the word's first d - 1, d and d + 1,
    # where 2 stands for more than one and for columns outside the word
    rows = [(2, 0, 1)]
    i, keep = 0, 0
    while i < len(listed):
        other = listed[i]
        del rows[keep + 1:]
        low, same, high = rows[-1]
        for d in range(len(rows), len(other) + 1):
            c = other[d - 1]
            left = min(low + (d < 2 or word[d - 2] != c), same + 1) if d <= size + 1 else 2
            middle = min(same + (word[d - 1] != c), left + 1, high + 1) if d <= size else 2
            right = min(high + (word[d] != c), middle + 1) if d < size else 2
            low, same, high = min(left, 2), min(middle, 2), min(right, 2)
            if low + same + high == 6:
                # all words with these d code points are beyond one edit
                prefix = other[:d]
                i = bisect_left(listed, prefix + LAST, i + 1)
                keep = common_prefix(prefix, listed[i]) if i < len(listed) else 0
                break
            rows.append((low, same, high))
        else:
            if abs(size - len(other)) <= 1 and (low, same, high)[1 + size - len(other)] == 1:
                yield i
            i += 1
            keep = shared[i] if i < len(listed) else 0


def near_in_group(key: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words told here, n of the most frequent, that word) of the members of a sorted group."""
    length, start, end = _read_key(key)
    parts = key.split(",")
    within = (int(parts[5]), int(parts[6])) if len(parts) > 5 else None
    listed = [word for word, _ in members]
    if len(listed) < 2 or all(len(word) > length for word in listed):
        return
    shared = [0] + [common_prefix(a, b) for a, b in zip(listed, listed[1:], strict=False)]
    for word in listed:
        found, best = 0, (0, "")
        for place in one_edit(word, listed, shared):
            near, n = members[place]
            if min(len(word), len(near)) != length or told_before(word, near, length, start, end, within):
                continue
            found += 1
            best = min(best, (-n, near))
        if found:
            yield word, found, -best[0], best[1]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, word, n) for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True) for key in coarse_keys(word)]
        yield _key_rows(rows)


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("key", "word", "n", "crowded"))
        rows = [(k, word, n) for key, word, n, crowded in zip(*columns, strict=True) for k in (fine_keys(word, key) if crowded else (key,))]
        yield _key_rows(rows)


def _key_rows(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["key", "word", "n"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and word; a group may go on in the next batch."""
    def rows():
        for batch in batches:
            yield from zip(batch.column("key").to_pylist(), batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True)

    out: list[tuple] = []
    for key, members in groupby(rows(), key=lambda row: row[0]):
        out.extend(near_in_group(key, [(word, n) for _, word, n in members]))
        if len(out) >= 10_000:
            yield _near_rows(out)
            out = []
    yield _near_rows(out)


def _near_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, crowded_above: int = CROWDED) -> DataFrame:
    """(word, n_near, best) of the words that have near ones; best holds the negative n and the word."""
    keyed = words.select("word", "n").mapInArrow(_keyed, "key string, word string, n bigint")
    # a hash that two keys share can only part a group that need not be parted
    sizes = keyed.groupBy(F.xxhash64("key").alias("hash")).count()
    crowded = small(cut(sizes.filter(F.col("count") > crowded_above).select("hash", F.lit(True).alias("crowded"))))
    marked = keyed.withColumn("hash", F.xxhash64("key")).join(crowded, "hash", "left").select("key", "word", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    parted = marked.mapInArrow(_parted, "key string, word string, n bigint")
    found = parted.repartition("key").sortWithinPartitions("key", "word").mapInArrow(_scan, "word string, n_near bigint, near_n bigint, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form has twice its word's count, so chains are short and end."""
    now = cut(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = cut(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97,
                      id_column: str = "doc_id", text_column: str = "text", crowded_above: int = CROWDED) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    words = cut(vocabulary(docs, least_length, least_count, every, id_column, text_column))
    near = near_words(words, crowded_above)
    far = F.coalesce(-F.col("best.less") >= 2 * F.col("n"), F.lit(False))
    forms = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n")))
    return forms.join(with_roots(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))
