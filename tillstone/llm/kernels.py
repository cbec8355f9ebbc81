"""Array kernels that run inside tasks over the raw UTF-8 buffers of an Arrow column.

Hashes of spans are polynomials modulo 2**64 over random byte or word values, taken from prefix sums and
mixed, so any span's hash costs a subtraction; they are used for spans well below 1,024 items only, where
no two spans collide by construction. Words, which may be longer, mix each byte with its place. All constants come from one fixed rule, so every executor
computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; rows are never split, so one longer row makes one longer slice.
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD1342543DE82EF95
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _byte_values(seed: int, fold_case: bool) -> np.ndarray:
    values = mix((np.arange(256, dtype=U64) + U64(seed)) * U64(BASE)) | U64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


_VALUES = {(seed, fold): _byte_values(seed, fold) for seed in (1, 1001) for fold in (False, True)}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for slices of the usual size."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, U64(base)), np.full(size, U64(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        known = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = known
    return known[0][:n], known[1][:n]


class Prefix:
    """Prefix sums of a sequence, from which the hash of any span follows."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        up, self.down = _powers(len(values) + 1, base)
        self.sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, dtype=U64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()) if pa.types.is_string(column.type) else column.cast(pa.large_binary()), b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Words:
    """Words of a slice: maximal runs of bytes other than space and the five ASCII line and tab bytes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE):
        inside = ~space[raw]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        start[cuts] = inside[cuts]
        end[cuts - 1] = inside[cuts - 1]
        self.raw = raw
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.rows = np.searchsorted(self.start, offsets)  # word range of each row

    def hashes(self, fold_case: bool = False, seed: int = 1, base: int = BASE) -> np.ndarray:
        """A word's bytes are mixed each with its place before they are added.

        A polynomial modulo 2**64 would not do: words of 1,024 bytes in a Thue-Morse order collide in it for
        every base and every byte value.
        """
        length = self.end - self.start
        if not len(length):
            return np.empty(0, dtype=U64)
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
        at = np.repeat(self.start, length) + place
        mixed = mix(_VALUES[seed, fold_case][self.raw[at]] + place.astype(U64) * U64(base))
        return mix(np.add.reduceat(mixed, first) + length.astype(U64) * U64(SECOND_BASE))


def byte_values(raw: np.ndarray, seed: int = 1) -> np.ndarray:
    return _VALUES[seed, False][raw]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring words of a slice (rows are not told apart)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    total = np.zeros(n, dtype=U64)
    factor = 1
    for k in range(width):
        total += words[k:k + n] * U64(factor)
        factor = factor * BASE % (1 << 64)
    return mix(total)


def row_of(rows: np.ndarray, n: int) -> np.ndarray:
    """Row index of each of n items, where rows[i]:rows[i + 1] are the items of row i."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:n]


def inside_rows(rows: np.ndarray, width: int) -> np.ndarray:
    """True where a window of ``width`` items that starts at an item ends in the same row."""
    n = int(rows[-1])
    last = np.repeat(rows[1:] - width, np.diff(rows))
    return np.arange(n) <= last


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` neighbouring values, the leftmost of equal ones.

    Values are compared by their upper 32 bits; position and value travel in one word.
    """
    packed = (values & U64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=U64)
    reach = 1
    while 2 * reach <= width:
        packed = np.minimum(packed[:-reach], packed[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        packed = np.minimum(packed[:-rest], packed[rest:])
    return (packed & U64(0xFFFFFFFF)).astype(np.int64)


def anchor_runs(values: np.ndarray, rows: np.ndarray, window: int, gram: int, base: int = BASE):
    """Runs of consecutive windows of a row that share their anchor.

    A window's anchor is its leftmost least gram, so equal windows have equal anchors at equal places.
    Returns, per run: row, first window, number of windows, hash of the anchor, hash of all its items,
    place of the anchor.
    """
    empty = np.empty(0, dtype=np.int64)
    if len(values) < window:
        return empty, empty, empty, np.empty(0, dtype=U64), np.empty(0, dtype=U64), empty
    grams = Prefix(values, base).windows(gram)
    place = sliding_least(grams, window - gram + 1)
    ok = inside_rows(rows, window)[:len(place)]
    first = ok.copy()
    # a new run where the anchor moves, or where the window before belongs to another row
    first[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return empty, empty, empty, np.empty(0, dtype=U64), np.empty(0, dtype=U64), empty
    # windows of a run: up to the next run or the row's end
    row = np.searchsorted(rows, start, side="right") - 1
    row_end = rows[row + 1] - window + 1
    nxt = np.append(start[1:], len(place))
    count = np.minimum(nxt, row_end) - start
    content = Prefix(mix(values), SECOND_BASE).span(start, start + count + window - 1)
    return row, start, count, grams[place[start]], content ^ mix(count.astype(U64)), place[start]
