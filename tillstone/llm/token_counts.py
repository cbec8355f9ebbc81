"""Token counts of a byte-level BPE vocabulary by compiled finite-state transducers.

A pre-token (a word with its leading space, a number, a run of signs or of white space) is counted by a
deterministic transducer over bytes. Its state holds, for every place where a token may still be
growing, the trie node reached, the token that ends at that place and the tokens up to it relative to
now; so equal states have equal futures. Each transition carries the change of the token count that it
emits. Transitions are compiled when first taken and kept for the life of the worker, and the total
output of a pre-token is kept with its text.

Between a character other than white space and white space every pre-token ends, whatever came before:
from there on the state map of a chunk of text is constant. A chunk's state map is therefore held as
(head, count, tail): the text up to its first such place, the tokens emitted between the first and
the last, and the text after the last. Maps compose associatively (tail and head join and are
counted), and the maps of a document's chunks are composed by a scan that halves them each round.

Results: a null text counts as empty (0 bytes, 0 tokens). Rows are counted one by one, so repeated
rows and repeated or null ids come out as often as they went in. Other columns of the input are not
looked at, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 20
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Totals of pre-tokens and transitions kept by a worker; when full they are dropped and compiled anew.
KEPT_PRETOKENS = 1_000_000
KEPT_STATES = 400_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Deterministic transducer whose output over a pre-token's bytes is its number of tokens."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = _byte_letters()
        spell = {piece: bytes(letters[c] for c in piece) for piece in vocabulary if all(c in letters for c in piece)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        # tokens are numbered by the order in which merges make them, single bytes first
        number = {piece: b for piece, b in letters.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for left, right in pairs:
            token = number.setdefault(left + right, 256 + len(self.parts))
            pair = number[left], number[right]
            self.parts.setdefault(token, pair)
            self.made.setdefault(pair, token)
        # trie: node -> {byte: node}; token_at: node -> token
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: dict[int, int] = {}
        for piece, token in number.items():
            node = 0
            for byte in spell.get(piece, bytes(letters[c] for c in piece)):
                node = self.trie[node].setdefault(byte, len(self.trie))
                if node == len(self.trie):
                    self.trie.append({})
            self.token_at[node] = token
        self.apart: dict[tuple[int, int], bool] = {}
        self._reset_states()

    def _reset_states(self) -> None:
        start = ((0, -1, 0),)
        self.number_of = {start: 0}
        self.states = [start]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' joined bytes is just these two tokens.

        Merges run in the order of their numbers. Undoing the latest merge on either side of the seam
        walks back through time; the tokens join if the two that face each other then have a merge
        that comes before the one that was undone.
        """
        known = self.apart.get((left, right))
        if known is None:
            self.apart[left, right] = known = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            if self.made.get((left, right), before) < before:
                return False
            undo_left = left in self.parts and (left > right or right not in self.parts)
            if undo_left:
                before, left = left, self.parts[left][1]
            elif right in self.parts:
                # an equal merge on the right of the seam would come after the one at the seam
                before, right = right + 1, self.parts[right][0]
            else:
                return True

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        live, ended, emitted = [], None, None
        for node, last, count in self.states[state]:
            following = self.trie[node].get(byte)
            if following is None:
                continue
            live.append((following, last, count))
            token = self.token_at.get(following)
            if token is not None and (last < 0 or self.stay_apart(last, token)):
                ended, emitted = token, count + 1
        if ended is None:
            raise ValueError("the vocabulary has no token for a byte")
        after = (*((node, last, count - emitted) for node, last, count in live), (0, ended, 0))
        number = self.number_of.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
            self.steps.append({})
        step = number, emitted
        self.steps[state][byte] = step
        return step

    def run(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        if len(self.states) > KEPT_STATES:
            self._reset_states()
        state = total = 0
        for byte in data:
            step = self.steps[state].get(byte)
            if step is None:
                step = self._compile(state, byte)
            state = step[0]
            total += step[1]
        return total


class Totals(dict):
    """Output of the transducer by pre-token; a missing one is run and, unless long, kept."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.run = transducer.run

    def __missing__(self, piece: str) -> int:
        total = self.run(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 64:
            if len(self) >= KEPT_PRETOKENS:
                self.clear()
            self[piece] = total
        return total


class Counter:
    """Counts tokens of whole texts and state maps of chunks for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            described = json.load(source)
        self.transducer = Transducer(described["model"]["vocab"], described["model"]["merges"])
        special = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        self.pretokens = regex.compile(PRETOKENS)
        self.seam = regex.compile(r"(?<=\S)(?=\s)")
        self.totals = Totals(self.transducer)

    def count(self, text: str) -> int:
        if self.special is not None and self.special.search(text):
            pieces = self.special.split(text)
            return len(pieces) - 1 + sum(map(self._count_plain, pieces))
        return self._count_plain(text)

    def _count_plain(self, text: str) -> int:
        return sum(map(self.totals.__getitem__, self.pretokens.findall(text)))

    def state_map(self, text: str, first: bool, last: bool) -> tuple[bool, str, int, str]:
        """(has a seam, head, count, tail) of a chunk; at a document's ends nothing is left open."""
        if first and last:
            return True, "", self.count(text), ""
        start = 0 if first else next((m.start() for m in self.seam.finditer(text)), None)
        if start is None:
            return (True, text, 0, "") if last else (False, text, 0, "")
        end = len(text)
        if not last:
            end = start
            for m in self.seam.finditer(text, start):
                end = m.start()
        return True, text[:start], self.count(text[start:end]), text[end:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if not a[0] and not b[0]:
            return False, a[1] + b[1], 0, ""
        if not a[0]:
            return True, a[1] + b[1], b[2], b[3]
        if not b[0]:
            return True, a[1], a[2], a[3] + b[1]
        return True, a[1], a[2] + self.count(a[3] + b[1]) + b[2], b[3]

    def total(self, maps: list[tuple]) -> int:
        """Composition of all maps, pairs of neighbours at a time."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        _, head, count, tail = maps[0]
        return self.count(head) + count + self.count(tail)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary file, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


MAPS = "row long, id long, n_bytes long, part int, seam boolean, head string, n long, tail string"


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``vocabulary`` is a tokenizer file that
    every executor has at this path."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    last = F.greatest(F.ceil(F.char_length(text) / chunk_chars).cast("int") - 1, F.lit(0))
    chunks = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), text.alias("text"),
                    F.octet_length(text).cast("long").alias("n_bytes"), last.alias("last"))
        .select("row", "id", "n_bytes", "last", F.explode(F.when(F.col("last") == 0, F.array(F.struct(F.lit(0).alias("part"), F.col("text").alias("chunk")))).otherwise(
            F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.struct(
                i.alias("part"), F.substring(F.col("text"), i * chunk_chars + 1, F.lit(chunk_chars)).alias("chunk"))))).alias("c"))
        .select("row", "id", "n_bytes", "last", "c.part", "c.chunk")
    )

    def count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state_map = counter(vocabulary).state_map
        for batch in batches:
            part, last_part = batch.column("part").to_pylist(), batch.column("last").to_pylist()
            maps = [state_map(t.as_py(), p == 0, p == e) for t, p, e in zip(batch.column("chunk"), part, last_part, strict=True)]
            seam, head, n, tail = zip(*maps, strict=True) if maps else ((), (), (), ())
            yield pa.record_batch([
                batch.column("row"), batch.column("id"), batch.column("n_bytes"), batch.column("part"),
                pa.array(seam, pa.bool_()), pa.array(head, pa.string()), pa.array(n, pa.int64()), pa.array(tail, pa.string()),
            ], names=["row", "id", "n_bytes", "part", "seam", "head", "n", "tail"])

    @F.pandas_udf("long")
    def composed(parts: pd.Series) -> pd.Series:
        total = counter(vocabulary).total
        return parts.map(lambda maps: int(maps[0]["n"]) if len(maps) == 1 and not maps[0]["head"] and not maps[0]["tail"]
                         else total([(m["seam"], m["head"], m["n"], m["tail"]) for m in maps]))

    maps = chunks.mapInArrow(count_chunks, MAPS)
    per_row = maps.groupBy("row", "id", "n_bytes").agg(
        F.sort_array(F.collect_list(F.struct("part", "seam", "head", "n", "tail"))).alias("parts"))
    return per_row.select(F.col("id").alias(id_column), "n_bytes", composed("parts").alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit)
