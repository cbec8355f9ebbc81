"""Jaccard self-join of documents on sets of word n-grams, through token-combination prefixes.

A token is a shingle of ``width`` words (its 64-bit hash). Tokens have one global order: first the low
tokens (hash under a fixed share of the range) that one set holds, then those that few hold, then the
low ones that many hold, then all others, each by hash. A set's prefix runs along this order until any set within the threshold
must still share a signature with it: a rare token, or any high one, is a signature by itself and is
worth one missing token; frequent low tokens are dealt into small parts by hash, and each pair in a
part is a signature, so that a part of m tokens is worth m - 1. With at most t tokens missing, prefixes
worth t + 1 must share a signature. Frequent tokens therefore extend the prefix instead of making
large groups of unlike sets.

Sets with equal tokens are folded before, whatever their number. Of sets with a common signature all
tokens are read, and ordered by the number of these sets that hold each. A set's prefix along this order
is shorter where the other set is not smaller, and near copies that are not linked seldom share a token
of it, since it begins with what tells them apart.

Sets with a common prefix token are not paired off: they are dealt into blocks, by the largest group that
each belongs to. Each block is verified by itself and with the largest block of each token, by one product
of their token matrices, which gives at most as many links as joins the sets at hand. All other pairs of
blocks follow only for tokens whose sets are then of more than one component. So no link between
different components is lost, and a family of linked sets costs rows and pairs in proportion to it.

Results: one row per input row, also for repeated rows and ids. A null or empty text has no shingle
and no link; a null id keeps its row, and the component takes the smallest id that is not null.
Columns besides id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import arrow_rows, connected, cut, letting_go, lists, signed, small
from tillstone.llm.kernels import BASE, U64, Words, mix, shingle_hashes, slices

# Sets that hold a low token, up to which it counts as rare.
RARE = 24
# Tokens in a block that is verified at once (a larger set is a block by itself).
BLOCK_TOKENS = 1 << 15
PAIRS_A_BATCH = 32  # pairs of blocks that a task holds at once in Python
HIGH, PAIR, SINGLE = 1, 2, 0
# A document is its id and 96 bits of its text.
KEY = ("id", "k1", "k2")


def missing(n, percent: int):
    """Tokens of a set of n that a set at the threshold may lack."""
    return (100 - percent) * n // 100


def low_bound(percent: int) -> np.uint64:
    """Hashes below this are low: somewhat more than the share of tokens that may be missing."""
    return U64(int(((100 - percent) / 100 + 0.06) * (1 << 64)))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than ``width`` make one shingle."""
    words = Words(raw, offsets)
    hashes = words.hashes(fold_case=True)
    shingles = shingle_hashes(hashes, width)
    for start, end in zip(words.rows[:-1], words.rows[1:], strict=True):
        if end - start >= width:
            yield np.unique(shingles[start:end - width + 1])
        elif end > start:
            few = hashes[start:end]
            yield mix(np.array([sum(int(h) * pow(BASE, k, 1 << 64) for k, h in enumerate(few)) % (1 << 64) ^ len(few)], dtype=U64))
        else:
            yield hashes[:0]


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    return int(tokens.sum().view(np.int64)), int(mix(tokens).sum().view(np.int64))


PREFIXES = "row long, id long, k1 long, k2 int, n long, s1 long, s2 long, low int, tokens array<long>"


def _prefixes(width: int, percent: int):
    bound = low_bound(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                digests, sizes, lows, kept = [], [], [], []
                for tokens in shingle_sets(raw, offsets, width):
                    n = len(tokens)
                    low = int(np.searchsorted(tokens, bound))
                    digests.append(_digest(tokens))
                    sizes.append(n)
                    lows.append(low)
                    # some high ones follow, for sets with too few low or rare ones
                    need = missing(n, percent) + 1
                    kept.append(tokens[:max(low, need) + need // 16 + 2])
                bounds = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
                s = np.array(digests, dtype=np.int64).reshape(-1, 2)
                yield pa.record_batch([
                    *(batch.column(c).slice(first, end - first) for c in ("row", *KEY)),
                    pa.array(sizes, pa.int64()), pa.array(s[:, 0]), pa.array(s[:, 1]), pa.array(lows, pa.int32()),
                    lists(signed(np.concatenate(kept)), bounds, pa.int64()),
                ], names=["row", *KEY, "n", "s1", "s2", "low", "tokens"])

    return run


def level(n: int, percent: int) -> int:
    """Size class: sizes of two linked sets are in the same or in neighbouring classes."""
    return int(np.floor(np.log(n) / np.log(100 / percent) + 1e-9))


def signatures(n: int, low: int, tokens: np.ndarray, held: np.ndarray, percent: int):
    """(key, kind, level) of a set, and whether tokens beyond the given ones are needed.

    ``held`` gives the sets that hold each of the first ``low`` tokens.
    """
    need = missing(n, percent) + 1
    # a token that no other set holds is worth its place in the prefix but leads nowhere
    alone = int((held == 1).sum())
    if alone >= need:
        return [], 0
    rare = tokens[:low][(held > 1) & (held <= RARE)][:need - alone]
    out = [(int(h), SINGLE, -1) for h in rare.view(np.int64)]
    if alone + len(rare) >= need:
        return out, 0
    frequent = tokens[:low][held > RARE]
    own = level(n, percent)
    short = 0
    for lv in (own, own + 1):
        worth, parts = alone + len(rare), {}
        count = max(1, int((100 / percent) ** lv * (100 - percent) / 100 * 0.6))
        where = (mix(frequent ^ U64(0x5851F42D4C957F2D)) % U64(count)).astype(np.int64)
        for h, part in zip(frequent.tolist(), where.tolist(), strict=True):
            if worth >= need:
                break
            held_before = parts.setdefault(part, [])
            worth += 1 if held_before else 0
            held_before.append(h)
        for members in parts.values():
            for a, b in combinations(members, 2):
                key = (a * BASE + b) % (1 << 64)
                out.append((key - (1 << 64) if key >> 63 else key, PAIR, lv))
        short = max(short, need - worth)
    return out, short


SIGNATURES = "key long, kind int, level int, rep long, n long, short int"


def _sign(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, sizes, lows = (batch.column(c).to_pylist() for c in ("rep", "n", "low"))
            for i, (rep, n, low) in enumerate(zip(ids, sizes, lows, strict=True)):
                tokens = batch.column("tokens")[i].values.to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
                held = np.ones(low, dtype=np.int64)
                known = batch.column("held")[i].values
                if known is not None and len(known):
                    shared = known.field("h").to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
                    held[np.searchsorted(tokens[:low], shared)] = known.field("held").to_numpy(zero_copy_only=False)
                found, short = signatures(n, low, tokens, held, percent)
                rows += [(key, kind, lv, rep, n, 0) for key, kind, lv in found]
                high = tokens[low:].view(np.int64).tolist() if short else []
                rows += [(h, HIGH, -1, rep, n, 0) for h in high[:short]]
                if short > len(high) and n > len(tokens):
                    rows.append((0, HIGH, -1, rep, n, short))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["key", "kind", "level", "rep", "n", "short"])

    return run


SETS = "id long, n long, s1 long, s2 long, tokens array<long>"


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                found = list(shingle_sets(raw, offsets, width))
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in found])])
                s = np.array([_digest(t) for t in found], dtype=np.int64).reshape(-1, 2)
                yield pa.record_batch([
                    batch.column("id").slice(first, end - first), pa.array(np.diff(bounds)), pa.array(s[:, 0]), pa.array(s[:, 1]),
                    lists(signed(np.concatenate(found)), bounds, pa.int64()),
                ], names=["id", "n", "s1", "s2", "tokens"])

    return run


def block_links(left: list[np.ndarray], right: list[np.ndarray], same: bool, percent: int) -> list[tuple[int, int]]:
    """A forest of links between two lists of sorted sets: positions in left and right."""
    a, b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    near = (100 * np.minimum.outer(a, b) >= percent * np.maximum.outer(a, b))
    if same:
        near = np.triu(near, 1)
    if not near.any():
        return []
    if near.sum() <= 4:
        pairs = [(i, j, len(np.intersect1d(left[i], right[j], assume_unique=True))) for i, j in np.argwhere(near)]
        return [(int(i), int(j)) for i, j, both in pairs if 100 * both >= percent * (a[i] + b[j] - both)]
    vocabulary = np.intersect1d(np.concatenate(left), np.concatenate(right))
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    step = max(1, (1 << 20) // max(len(left), len(right)))
    for start in range(0, len(vocabulary), step):
        chosen = vocabulary[start:start + step]
        tables = []
        for sets in (left, right):
            table = np.zeros((len(sets), len(chosen)), dtype=np.float32)
            for i, tokens in enumerate(sets):
                table[i, np.isin(chosen, tokens, assume_unique=True)] = 1
            tables.append(table)
        common += tables[0] @ tables[1].T
    hit = near & (100 * common >= percent * (np.add.outer(a, b) - common))
    parent = list(range(len(left) + len(right)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in np.argwhere(hit):
        x, y = root(int(i)), root(int(j) if same else len(left) + int(j))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(i), int(j)))
    return out


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                sides, names = [], []
                for side in ("x", "y"):
                    members = batch.column(side)[i].values
                    names.append(members.field("rep").to_pylist())
                    sides.append([members.field("tokens")[k].values.to_numpy().view(U64) for k in range(len(members))])
                for p, q in block_links(*sides, batch.column("bx")[i].as_py() == batch.column("by")[i].as_py(), percent):
                    a.append(names[0][p])
                    b.append(names[1][q])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def document_key(id_column: str, text_column: str) -> dict[str, Column]:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return dict(zip(KEY, (F.col(id_column).cast("long"), F.xxhash64(text), F.hash(text)), strict=True))


def _members(docs: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """row, id, k1, k2, n and component of every input row."""
    key = document_key(id_column, text_column)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), *(c.alias(name) for name, c in key.items()), F.col(text_column).alias("text"))
    rows = cut(keyed.mapInArrow(letting_go(_prefixes(width, percent)), PREFIXES))
    # one row stands for all that have the same set; sets themselves stay where they were written
    sets = cut(rows.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("row").alias("rep"), F.min_by("id", "row").alias("id")))
    own = rows.join(small(sets.select(F.col("rep").alias("row"))), "row", "left_semi").select(F.col("row").alias("rep"), "n", "low", "tokens")

    low = own.select("rep", F.explode(F.slice("tokens", 1, F.col("low"))).alias("h"))
    held = low.groupBy("h").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = low.join(held, "h").groupBy("rep").agg(F.collect_list(F.struct("h", "held")).alias("held"))
    # sets without any shared low token can only link through high ones, which very small sets have
    signed_sets = (own.join(shared, "rep", "left")
                   .filter(F.col("held").isNotNull() | (F.col("low") < F.floor((100 - percent) * F.col("n") / 100) + 1)))
    signs = cut(signed_sets.mapInArrow(letting_go(_sign(percent)), SIGNATURES))

    # sets whose low tokens are nearly all frequent go on into the high ones, read from their texts
    far = signs.filter("short > 0").select("rep", "short")
    far = cut(far.join(sets.select("rep", "id", "n", "s1", "s2"), "rep"))
    signs = signs.filter("short = 0").select("key", "kind", "level", "rep", "n")
    if far.limit(1).count():
        full = _texts_of(texts, far, width)
        high = F.slice(F.filter("tokens", _is_high(percent)), 1, F.col("short"))
        signs = cut(signs.unionByName(full.select(F.explode(high).alias("key"), F.lit(HIGH).alias("kind"), F.lit(-1).alias("level"), "rep", "n")))

    groups = signs.groupBy("key", "kind", "level").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    near = signs.join(groups, ["key", "kind", "level"], "left_semi").select("rep").distinct()
    full = cut(_texts_of(texts, near.join(sets, "rep"), width).select("rep", "n", "tokens"))
    met = cut(_prefix_tokens(full, percent))
    home = met.groupBy("rep", "n").agg(F.max(F.struct("group_tokens", "h")).alias("home"))
    placed = cut(home.select("rep", "n", F.xxhash64("home.h", F.pmod(
        F.xxhash64("rep"), F.ceil(F.col("home.group_tokens") / BLOCK_TOKENS))).alias("block")))
    blocks = cut(full.join(placed.select("rep", "block"), "rep").groupBy("block").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("rep", "tokens")).alias("members")))
    met = cut(met.join(placed.select("rep", "block"), "rep").join(blocks.select("block", "total"), "block"))

    # first each block by itself, and with the largest block that it shares a token with
    of_key = met.groupBy("h", "block", "total").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    hubs = of_key.groupBy("h").agg(F.max_by(F.struct("block", "least", "most"), F.struct("total", "block")).alias("hub"), F.count(F.lit(1)).alias("blocks"))
    first = cut(of_key.join(hubs.filter("blocks > 1"), "h").filter("block <> hub.block")
                .filter(f"100 * most >= {percent} * hub.least and 100 * hub.most >= {percent} * least")
                .select(F.col("block").alias("bx"), F.col("hub.block").alias("by")).distinct())
    within = blocks.filter("size(members) > 1").select(
        F.col("block").alias("bx"), F.col("block").alias("by"), F.col("members").alias("x"), F.col("members").alias("y"))
    # a row holds two whole blocks, so a batch of the usual size would hold all of a task
    with arrow_rows(docs.sparkSession, PAIRS_A_BATCH):
        links = _verified(within, percent).unionByName(_verified(_block_pairs(first, blocks), percent))
        found = connected(links).withColumnRenamed("node", "rep")
        # then all pairs of blocks, but only for tokens whose sets are not all linked yet
        rest = cut(_unlinked_pairs(met, found, percent).join(first, ["bx", "by"], "left_anti"))
        if rest.limit(1).count():
            links = _verified(_block_pairs(rest, blocks), percent)
            found = connected(found.select(F.col("rep").alias("a"), F.col("component").alias("b")).unionByName(links)).withColumnRenamed("node", "rep")

    members = rows.select("row", *KEY, "n", "s1", "s2").join(sets.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"], "left")
    return members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep", "row"))


def _prefix_tokens(full: DataFrame, percent: int) -> DataFrame:
    """h, rep, n, short, group_tokens: tokens by which sets can link, of whole sets, those that few hold first.

    Of two linked sets, the larger one's prefix has a token of the smaller one's short prefix, which is
    laid out for sets that are not smaller. Tokens that no other set holds take up their places.
    """
    tokens = full.select("rep", F.explode("tokens").alias("h"))
    held = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = tokens.join(held, "h").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("held", "h"))).alias("shared"))
    ranked = shared.join(full.select("rep", "n"), "rep").withColumn("alone", F.col("n") - F.size("shared"))
    prefix = ranked.select("rep", "n", "alone", F.posexplode(F.expr(
        f"slice(shared, 1, int(greatest((100 - {percent}) * n div 100 + 1 - alone, 0)))")).alias("place", "token"))
    signs = prefix.select("rep", "n", F.col("token.h").alias("h"), F.expr(
        f"alone + place < n - (2 * {percent} * n + 99 + {percent}) div (100 + {percent}) + 1").alias("short"))
    groups = signs.groupBy("h").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("group_tokens"), F.max("short").alias("any_short"))
    return signs.join(groups.filter("sets > 1 and any_short").select("h", "group_tokens"), "h")


def _block_pairs(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Both blocks of each pair; the first is sent to the second, so it is the one with fewer tokens."""
    side = lambda at, name: blocks.select(F.col("block").alias(at), F.col("members").alias(name))
    return pairs.join(side("bx", "x"), "bx").join(side("by", "y"), "by").select("bx", "by", "x", "y")


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.mapInArrow(letting_go(_verify(percent)), "a long, b long")


def _unlinked_pairs(met: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks that share a token, hold sets near in size for it, and of more than one component."""
    linked = met.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_keys = linked.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("h")
    of_key = linked.join(open_keys, "h").groupBy("h", "block", "total").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("short").alias("short"),
        F.min("component").alias("lo"), F.max("component").alias("hi"))
    side = lambda name: of_key.select("h", F.col("block").alias(f"b{name}"), *(
        F.col(c).alias(f"{c}_{name}") for c in ("total", "least", "most", "short", "lo", "hi")))
    return (side("x").join(side("y"), "h")
            .filter("(total_x < total_y or (total_x = total_y and bx < by)) and (short_x or short_y)")
            .filter("least(lo_x, lo_y) < greatest(hi_x, hi_y)")
            .filter(f"100 * most_x >= {percent} * least_y and 100 * most_y >= {percent} * least_x").select("bx", "by").distinct())


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """row, id, n_shingles, component_id of every input row; rows link at ``percent`` similarity."""
    members = _members(docs, width, percent, id_column, text_column)
    least = members.groupBy("component").agg(F.min("id").alias("component_id"))
    return members.join(least, "component").select("row", "id", F.col("n").alias("n_shingles"), "component_id")


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of each group of linked rows one, all columns: the one of the smallest id, rows without id last,
    and of several texts of that id the one of the smallest hash. Rows without words stay."""
    rows = _members(docs, width, percent, id_column, text_column).filter("n > 0")
    keys = cut(rows.groupBy("component", *KEY).agg(F.count(F.lit(1)).alias("rows")))
    firsts = keys.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), *KEY)).alias("first"), F.count(F.lit(1)).alias("keys"))
    marked = keys.join(firsts.filter("keys > 1").select("component", "first"), "component", "left").withColumn(
        "goes", F.col("first").isNotNull() & ~(F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))))
    marked = cut(marked.filter("goes or rows > 1").select("goes", *(F.col(c).alias(f"__{c}") for c in KEY)))
    gone, repeated = (marked.filter(which).drop("goes") for which in ("goes", "not goes"))
    own = document_key(id_column, text_column)

    same = own["id"].eqNullSafe(F.col("__id")) & (own["k1"] == F.col("__k1")) & (own["k2"] == F.col("__k2"))
    kept = docs.join(small(gone), same, "left_anti")
    if not repeated.limit(1).count():
        return kept
    # only rows that are there more than once are sent to each other
    repeated = small(repeated)
    once = kept.join(repeated, same, "left_semi").withColumns({f"__{c}": x for c, x in own.items()}).dropDuplicates([f"__{c}" for c in KEY])
    return kept.join(repeated, same, "left_anti").unionByName(once.select(*docs.columns))


def _is_high(percent: int):
    """Whether a token, kept as a signed long, is at or above the bound for low ones."""
    bound = int(low_bound(percent))
    signed_bound = bound - (1 << 64) if bound >> 63 else bound
    if signed_bound >= 0:
        return lambda h: (h < 0) | (h >= signed_bound)
    return lambda h: (h < 0) & (h >= signed_bound)


def _texts_of(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted`` (with id, n, s1, s2, rep) and the whole token sets, in order of hash, from the texts."""
    wanted = cut(wanted)
    ids = small(cut(wanted.select(F.col("id").alias("wanted_id")).distinct()))
    read = texts.join(ids, texts.id.eqNullSafe(ids.wanted_id), "left_semi").mapInArrow(letting_go(_sets(width)), SETS)
    # any text with the same set will do
    return wanted.join(read.drop("id").dropDuplicates(["n", "s1", "s2"]), ["n", "s1", "s2"])
