"""Sets of tokens that share some: blocks of sets meet in pairs of blocks, and only what shares enough leaves a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import cut, dealt

#: Sets and tokens of a block at most, sets from which a group is divided, and into how many blocks for the sake of tasks alone.
SETS_PER_TASK, TOKENS_PER_TASK, FEW_SETS, SOME_BLOCKS = 100_000, 4_000_000, 2_000, 6
#: Meetings that are laid out at once, and how many of a task's commonest tokens (8 words of 64) are bits of each set, not met one by one.
MEETINGS, COMMON = 300_000, 512
#: Pairs of items that leave a task at once, and keys of equal sets that go together.
PAIRS, KEYS = 262_144, 1_024


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges first[i] .. first[i] + counts[i] - 1."""
    out = np.repeat((first - np.cumsum(counts) + counts).astype(np.int32), counts)
    out += np.arange(len(out), dtype=np.int32)
    return out


def coded(sets: pa.Array) -> pa.Array:
    """Lists of tokens as lists of numbers in a dictionary of their own."""
    edge = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(sets)))])
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), sets.flatten().dictionary_encode())


def ranked(*sides: pa.Array | pa.ChunkedArray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Of each side its sets' tokens as numbers, from rare to common within a set, and the sets' sizes; and how many tokens there are."""
    sizes = [np.asarray(pc.list_value_length(s)).astype(np.int64) for s in sides]
    tokens = pa.chunked_array([c.flatten() for s in sides for c in (s.chunks if isinstance(s, pa.ChunkedArray) else [s])])
    tokens = tokens.unify_dictionaries() if pa.types.is_dictionary(tokens.type) else tokens.dictionary_encode()
    ids = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in tokens.chunks])
    del tokens
    times = np.bincount(ids)
    place = np.empty(len(times), np.int32)
    place[np.argsort(times, kind="stable")] = np.arange(len(times))
    keys = np.repeat(np.arange(sum(map(len, sizes))) * len(times), np.concatenate(sizes))
    keys += place[ids]
    del ids
    keys.sort()
    np.remainder(keys, max(1, len(times)), out=keys)
    return list(zip(np.split(keys.astype(np.int32), np.cumsum([n.sum() for n in sizes[:-1]])), sizes)), len(times)


class Side:
    """Sets of one side: the tokens that are met one by one, with their sets' rows, and the common ones as bits.

    Sets that share least tokens share one that is not among the last least - 1 of either. So common tokens at a
    set's end are not met, they only count as bits.
    """

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, names: int, least: int):
        self.n, first = len(sizes), max(0, names - COMMON)
        rows = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        early = np.arange(len(tokens)) < (np.cumsum(sizes) - (least - 1))[rows]
        rare = tokens < first
        self.bits = np.zeros((self.n, COMMON // 64), np.uint64)
        at, bit = rows[~rare], tokens[~rare] - first
        self.commons = np.bincount(at, minlength=self.n).astype(np.int32)
        for w in range(COMMON // 64):
            flags = np.zeros((self.n, 64), bool)
            flags[at[bit // 64 == w], bit[bit // 64 == w] % 64] = True
            self.bits[:, w] = np.packbits(flags, axis=1).view(np.uint64)[:, 0]
        met = rare | early
        self.tokens, self.rows, self.rare = tokens[met], rows[met], rare[met]


def ones(words: np.ndarray) -> np.ndarray:
    """How many bits are set in each row of 8 words: their counts, 8 bytes together, are summed as 4 numbers of 16 bits."""
    counts, every = np.bitwise_count(words).view(np.uint64)[:, 0], np.uint64(0x00FF00FF00FF00FF)
    halves = (counts & every) + (counts >> np.uint64(8) & every)
    return (halves * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64)


def sharing(left: pa.Array | pa.ChunkedArray, right: pa.Array | pa.ChunkedArray | None, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, shared) arrays, sorted by i and j, of the sets of left and right (lists of distinct tokens) that share least or more; left goes by in parts.

    Without right, left's sets among themselves, i < j.
    """
    alone = right is None
    own, names = ranked(left) if alone else ranked(left, right)
    del left, right
    one = Side(*own[0], names, least)
    other = one if alone else Side(*own[1], names, least)
    del own
    order = np.argsort(other.tokens, kind="stable")
    times = np.bincount(other.tokens, minlength=names)
    begin = np.cumsum(times) - times
    bits = max(1, other.n).bit_length()  # of j in a key: i, j, whether the token met is a rare one
    rows = other.rows[order].astype(np.uint32) << np.uint32(1)
    start, counts = begin[one.tokens], times[one.tokens]
    if alone:  # only those behind in the token's list
        later = np.empty(len(order), np.int64)
        later[order] = np.arange(1, len(order) + 1)
        start, counts = later, start + counts - later
    edge = np.concatenate([[0], np.cumsum(np.bincount(one.rows, minlength=one.n))])
    met = np.concatenate([[0], np.cumsum(counts)])[edge]
    a = 0
    while a < one.n:
        b = max(a + 1, min(int(np.searchsorted(met, met[a] + MEETINGS, "right")) - 1, a + (1 << (31 - bits))))
        here = slice(edge[a], edge[b])
        keys = rows[ragged(start[here], counts[here])]
        keys += np.repeat((one.rows[here] - a).astype(np.uint32) << np.uint32(bits + 1) | one.rare[here], counts[here])
        keys.sort()
        pairs = keys >> np.uint32(1)
        first = np.flatnonzero(np.concatenate([[len(pairs) > 0], pairs[1:] != pairs[:-1]])[: len(pairs)])
        pairs, run = pairs[first], np.diff(first, append=len(pairs))
        i, j = (pairs >> np.uint32(bits)) + np.uint32(a), pairs & np.uint32((1 << bits) - 1)
        may = np.flatnonzero(run + np.minimum(one.commons[i], other.commons[j]) >= least)
        i, j, first, run = i[may].astype(np.int64), j[may].astype(np.int64), first[may], run[may]
        rare = np.concatenate([[0], np.cumsum(keys & np.uint32(1), dtype=np.int32)])
        shared = rare[first + run] - rare[first] + ones(one.bits[i] & other.bits[j])
        found = np.flatnonzero(shared >= least)
        yield i[found], j[found], shared[found]
        a = b


def blocks_of(sets: DataFrame, name: str, most: int) -> DataFrame:
    """(g, name): into how many blocks of most sets the sets of each group are dealt."""
    n = F.count("*")
    return sets.groupBy("g").agg(F.greatest(F.ceil(n / most), F.ceil(F.sum(F.size("ts")) / TOKENS_PER_TASK), F.least(F.lit(SOME_BLOCKS), F.ceil(n / FEW_SETS))).alias(name))


def sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    table = table.combine_chunks()
    return table.filter(pc.equal(table["side"], 0)), table.filter(pc.equal(table["side"], 1))


def lists(table: pa.Table) -> pa.Array:
    """The sets, with tokens whose bytes may be many."""
    column = table["ts"].combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.cast(pa.list_(pa.large_string()))


def sharing_pairs(sets: DataFrame, least: int, most: int = SETS_PER_TASK) -> DataFrame:
    """(a, b, shared, a_copies, b_copies) of the sets (a, g, ts, copies) of a group that share least tokens or more, a < b.

    Each pair of a group's blocks meets in one task: a set travels once for each block, whatever its tokens are.
    """
    kind = sets.schema["a"].dataType.simpleString()
    block = F.pmod(F.xxhash64("a"), F.col("blocks"))
    each = sets.join(blocks_of(sets, "blocks", most), "g").withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = (F.col("own") > F.col("other")).cast("int")
    rows = each.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "a", "ts", "copies")

    def meet(table):
        one, other = sides(table)
        alone = table["i"][0].as_py() == table["j"][0].as_py()
        other = one if alone else other
        out = []
        for i, j, shared in sharing(lists(one), None if alone else lists(other), least):
            i, j = pa.array(i), pa.array(j)
            out.append(pa.table([one["a"].take(i), other["a"].take(j), pa.array(shared, pa.int64()), one["copies"].take(i), other["copies"].take(j)], ["a", "b", "shared", "a_copies", "b_copies"]))
        empty = pa.table([one["a"].slice(0, 0), one["a"].slice(0, 0), pa.array([], pa.int64()), one["copies"].slice(0, 0), one["copies"].slice(0, 0)], ["a", "b", "shared", "a_copies", "b_copies"])
        return pa.concat_tables([empty, *out])

    met = dealt(rows, "g", "i", "j").groupBy("g", "i", "j").applyInArrow(meet, f"a {kind}, b {kind}, shared long, a_copies long, b_copies long")
    turned = F.col("a") > F.col("b")
    swap = lambda x, y, name: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name)
    return met.select(swap("a", "b", "a"), swap("b", "a", "b"), "shared", swap("a_copies", "b_copies", "a_copies"), swap("b_copies", "a_copies", "b_copies"))


def expanded(left: pa.Array, right: pa.Array, i: np.ndarray, j: np.ndarray, shared: np.ndarray, inner: bool = False) -> Iterator[pa.RecordBatch]:
    """(a, b, shared): each key of the list left[i] beside each of right[j], in parts; if inner, each of a list beside its later ones."""
    begin = [np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(s)), dtype=np.int64)]) for s in (left, right)]
    keys, wide = (left.flatten(), right.flatten()), np.diff(begin[1])[j]
    ends = np.cumsum(np.diff(begin[0])[i] * wide)
    for s in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        e = min(s + PAIRS, int(ends[-1]))
        first, last = np.searchsorted(ends, [s, e - 1], "right")
        edges = np.concatenate([[s], ends[first:last], [e]])
        of = np.repeat(np.arange(first, last + 1), np.diff(edges))
        at = np.arange(s, e) - np.concatenate([[0], ends])[of]
        u, v = at // wide[of], at % wide[of]
        if inner:
            of, u, v = of[u < v], u[u < v], v[u < v]
        a, b = keys[0].take(pa.array(begin[0][i[of]] + u)), keys[1].take(pa.array(begin[1][j[of]] + v))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(shared[of], pa.int64())], ["a", "b", "shared"])


def item_pairs(items: DataFrame, least: int, most: int = SETS_PER_TASK) -> DataFrame:
    """(a, b, shared) of the items (k, g, ts) of a group that share least tokens or more, a < b, whether or not their sets are equal.

    Items with equal sets travel as one set with its keys; if these are many, as several sets in blocks of their own.
    Pairs leave the task in parts.
    """
    kind = items.schema["k"].dataType.simpleString()
    keys = items.groupBy("g", "ts").agg(F.collect_list("k").alias("ks"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("ks") - 1) / KEYS)), lambda p: F.slice("ks", (p * KEYS + 1).cast("int"), F.lit(KEYS)))
    sets = cut(keys.select("g", "ts", F.posexplode(parts).alias("part", "ks")))
    own = F.pmod(F.xxhash64("ts") + F.col("part"), F.col("blocks"))
    each = sets.join(blocks_of(sets, "blocks", most), "g").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = each.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "ks", "ts")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, keys = ([], []), ([], [])
        for batch in batches:  # words are held once for each batch
            alone = batch["i"][0].as_py() == batch["j"][0].as_py()
            for side in (0, 1):
                part = batch.filter(pc.equal(batch["side"], side))
                if part.num_rows:
                    sets[side].append(coded(part["ts"]))
                    keys[side].append(part["ks"])
        if not sets[0] or not (alone or sets[1]):
            return
        one = pa.concat_arrays(keys[0])
        other = one if alone else pa.concat_arrays(keys[1])
        if alone:
            sizes = np.concatenate([np.asarray(pc.list_value_length(s)) for s in sets[0]])
            several = np.flatnonzero(np.asarray(pc.list_value_length(one)) > 1)
            yield from expanded(one, other, several, several, sizes[several], inner=True)
        found = sharing(pa.chunked_array(sets[0]), None if alone else pa.chunked_array(sets[1]), least)
        del sets, keys, batch, part
        for i, j, shared in found:
            yield from expanded(one, other, i, j, shared)

    met = dealt(rows, "g", "i", "j").groupBy("g", "i", "j").applyInArrow(meet, f"a {kind}, b {kind}, shared long").where("a <> b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared")


def first_sharing(sets: DataFrame, leaders: DataFrame, least: int, most: int = SETS_PER_TASK) -> DataFrame:
    """(n, leader): of each set (g, n, ts) the smallest n among its group's leaders that share least tokens or more; sets without one are left out."""
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    counts = blocks_of(sets, "i_blocks", most).join(blocks_of(leaders, "j_blocks", most), "g")
    own = lambda df, blocks: df.join(counts, "g").withColumn("own", F.pmod(F.xxhash64("n"), F.col(blocks)))
    asked = own(sets, "i_blocks").select("g", F.col("own").alias("i"), every("j_blocks").alias("j"), F.lit(0).alias("side"), "n", "ts")
    known = own(leaders, "j_blocks").select("g", every("i_blocks").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "n", "ts")

    def meet(table):
        one, other = sides(table)
        other = other.sort_by("n")
        at, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j, _ in sharing(lists(one), lists(other), least):
            rows, place = np.unique(i, return_index=True)
            at.append(rows)
            first.append(j[place])
        return pa.table([one["n"].take(pa.array(np.concatenate(at))), other["n"].take(pa.array(np.concatenate(first)))], ["n", "leader"])

    met = dealt(asked.unionByName(known), "g", "i", "j").groupBy("g", "i", "j").applyInArrow(meet, "n long, leader long")
    return met.groupBy("n").agg(F.min("leader").alias("leader"))
