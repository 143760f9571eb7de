"""SimHash near-duplicates: fingerprints linked by Hamming distance, found by vantage-point trees.

Contract
* Words are runs without ASCII white space (A-Z lower-cased); a text has all its runs of SHINGLE words, repeats
  included, each joined by a space; of fewer words it has the whole. h is a run's XXH64 (UTF-8, seed 42). A bit of
  the fingerprint is 1 if set in over half of a text's h; a text without words (null, empty) has fingerprint zero,
  which links like any other. Two rows are linked when their fingerprints differ in RADIUS bits at most.
* Per row: doc_id, fingerprint (16 lower-case hex digits), component_id (the smallest id it reaches by links, its
  own included; null ids don't count unless there are no others). Rows that repeat an id count each; further
  columns pass; very long texts are read whole, some runs at a time; an empty table gives no rows.

Method: equal fingerprints are one node, so copies cost nothing later. A vantage-point tree is fitted on a bounded
sample (SAMPLE fingerprints): each inner node has a fingerprint and a radius m. A node goes inward at a distance
up to m and outward beyond; what is inward within RADIUS of the border is a guest outward as well. By the triangle
inequality two linked nodes never part without one of them visiting the other's side, so each link lies whole in
some leaf, and a leaf is a shard. Shards that came out larger than SHARD get a tree of their own, fitted on a
sample of them. In a shard the same descent goes on in memory, one branch at a time, down to sets compared pair by
pair. A set that no vantage point divides (a dense ball) is linked through shared neighbours at one flipped bit
instead, as two fingerprints differ in two bits at most just when they have such a neighbour in common. Shards
give forests, not pairs; what hangs together across shards is found by contraction rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, cut, pieces, raw_text, table
from .near_duplicates import SALTS, components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints that a tree is fitted on at most, sample rows of a leaf at least, and nodes of a shard aimed at and accepted.
SAMPLE, LEAF_SAMPLE, AIM, SHARD = 65_536, 16, 4_096, 1 << 20
#: Sets up to this size are compared pair by pair; candidates tried as a vantage point, and members that judge them.
PAIRS, TRIED, JUDGES = 256, 8, 1024
#: Runs of words whose bits are counted at once.
RUNS = 1 << 15


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """SimHash of lower-cased UTF-8 bytes."""
    line = b" ".join(text.split())
    if not line:
        return 0
    gap = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    first, last = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(line)]])
    runs = max(1, len(first) - n + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, runs, RUNS):
        b = min(runs, a + RUNS)
        end = last[a + n - 1 : b + n - 1] if len(last) >= n else last[-1:]
        h = np.fromiter((xxhash.xxh64_intdigest(line[x:y], SEED) for x, y in zip(first[a:b].tolist(), end.tolist())), "<u8", b - a)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > runs, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in pieces(batches, "_t"):
        data, edge = raw_text(batch.column(1))
        data, edge = data.translate(LOWER_BYTES), edge.tolist()
        found = np.fromiter((fingerprint(data[a:b]) for a, b in zip(edge, edge[1:])), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def apart(fps: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(fps ^ other)


def choose(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.uint64, int] | None:
    """The vantage point and border that divide best for the guests they cause; None if none divides."""
    judges = fps[:: max(1, len(fps) // JUDGES)]
    best = None
    for point in fps[:: max(1, len(fps) // TRIED)][:TRIED]:
        times = np.bincount(apart(judges, point), minlength=65) / len(judges)
        inward = np.cumsum(times)
        guests = inward - np.concatenate([np.zeros(radius), inward])[:65]
        larger, both = np.maximum(inward, 1 - inward + guests), 1 + guests
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = -inward * np.log2(inward) - (1 - inward) * np.log2(1 - inward)
            cost = np.where((inward < 1) & (larger < 0.9), np.log2(both) / bits, np.inf)
        m = int(np.argmin(cost))
        if cost[m] < (best[0] if best else 0.75):
            best = (cost[m], point, m)
    return best and (best[1], best[2])


def parted(distance: np.ndarray, m: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Which go inward, and which outward; those within radius of the border go both ways."""
    return distance <= m, distance > m - radius


def fit(sample: np.ndarray, share: float, aim: int) -> list:
    """A tree as rows (point, m, inward, outward), leaves as None; share is the number of nodes a sample row stands for."""
    tree: list = []

    def grow(fps) -> int:
        at = len(tree)
        tree.append(None)
        if len(fps) * share > aim and len(fps) >= 2 * LEAF_SAMPLE and (found := choose(fps)):
            inward, outward = parted(apart(fps, found[0]), found[1])
            tree[at] = (int(found[0]), found[1], grow(fps[inward]), grow(fps[outward]))
        return at

    grow(np.sort(sample))
    return tree


def route(fps: np.ndarray, tree: list):
    """(leaf, indexes) of the fingerprints that come to it, guests included."""
    todo = [(0, np.arange(len(fps)))]
    while todo:
        at, inside = todo.pop()
        if tree[at] is None:
            if len(inside):
                yield at, inside
            continue
        point, m, left, right = tree[at]
        inward, outward = parted(apart(fps[inside], np.uint64(point)), m)
        todo += [(left, inside[inward]), (right, inside[outward])]


def _route(trees: dict):
    """Rows (shard, fp) to the shards below; trees has a tree for some shards, new names continue the old."""

    def run(batches):
        for batch in batches:
            shard, fps = np.asarray(batch.column(0).to_pylist(), object), batch.column(1).to_numpy().view(np.uint64)
            found = [(f"{name}.{leaf}", own[inside]) for name in set(shard.tolist()) for own in [fps[shard == name]] for leaf, inside in route(own, trees[name])]
            if found:
                names = np.repeat(np.array([name for name, _ in found], object), [len(x) for _, x in found])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate([x for _, x in found]).view(np.int64))], ["shard", "fp"])

    return run


def shards(nodes: DataFrame) -> DataFrame:
    """(shard, fp): every fingerprint in its own shard and as a guest in those whose borders it is near."""
    done, todo = [], nodes.select(F.lit("").alias("shard"), "fp")
    sizes = {"": todo.count()}
    while sizes:
        every = sum(sizes.values())
        picked = todo.orderBy(F.xxhash64("fp", F.lit(1)), "shard").limit(SAMPLE).collect()
        sample: dict = {name: [] for name in sizes}
        for r in picked:
            sample[r["shard"]].append(r["fp"])
        trees = {name: fit(np.array(got, np.int64).view(np.uint64), every / max(1, len(picked)), AIM) for name, got in sample.items()}
        routed = cut(todo.mapInArrow(_route(trees), "shard string, fp bigint"))
        grown = {r["shard"]: r["n"] for r in routed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # SAMPLE / LEAF_SAMPLE at most
        # A shard that its tree left whole stays so: the descent in memory deals with it.
        sizes = {name: n for name, n in grown.items() if n > SHARD and trees[name.rpartition(".")[0]] != [None]}
        again = F.col("shard").isin(list(sizes)) if sizes else F.lit(False)
        done.append(routed.where(~again))
        todo = routed.where(again)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class Forest:
    """Which members of a sorted set hang together."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.top(x), self.top(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def _by_neighbours(fps: np.ndarray, inside: np.ndarray, forest: Forest) -> None:
    """Ties what shares a fingerprint at one flipped bit or none; in passes over parts of the keys."""
    flips = np.concatenate([[0], 1 << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    parts = max(1, len(inside) * 65 >> 22)
    for part in range(parts):
        keys, owner = [], []
        for flip in flips:
            key = fps[inside] ^ flip
            mine = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts) == part
            keys.append(key[mine])
            owner.append(inside[mine])
        key, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        forest.tie(owner[same], owner[same + 1])


def link(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the sorted, distinct fingerprints of a shard the index of the first it hangs together with."""
    forest, todo = Forest(len(fps)), [np.arange(len(fps))]
    while todo:
        inside = todo.pop()
        if len(inside) <= PAIRS:
            near = apart(fps[inside][:, None], fps[inside][None, :]) <= radius
            a, b = np.nonzero(np.triu(near, 1))
            forest.tie(inside[a], inside[b])
        elif found := choose(fps[inside], radius):
            inward, outward = parted(apart(fps[inside], found[0]), found[1], radius)
            if inward.sum() + outward.sum() < 1.7 * len(inside):
                todo += [inside[inward], inside[outward]]
            else:
                _by_neighbours(fps, inside, forest)
        else:
            _by_neighbours(fps, inside, forest)
    return np.array([forest.top(i) for i in range(len(fps))], np.int64)


def _link(batches):
    def outcome(parts):
        fps = np.unique(np.concatenate(parts).view(np.uint64))
        root = link(fps)
        tied = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[tied].view(np.int64)), pa.array(fps[root[tied]].view(np.int64))], ["a", "b"])

    name, held = None, []
    for batch in batches:
        shard, fps = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        edge = [0, *(i for i in range(1, len(shard)) if shard[i] != shard[i - 1]), len(shard)]
        for a, b in zip(edge, edge[1:]):
            if b > a:
                if shard[a] != name and held:
                    yield outcome(held)
                    held = []
                name = shard[a]
                held.append(fps[a:b])
    if held:
        yield outcome(held)


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    marked = cut(rows.mapInArrow(_fingerprints, f"doc_id {kind}, fp bigint"))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    edges = shards(nodes).repartition("shard").sortWithinPartitions("shard").mapInArrow(_link, "a bigint, b bigint")
    labels = components(edges)  # of the linked nodes
    named = cut(nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left"))
    # A component may hold many nodes: its smallest id is copied for SALTS parts of them.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    best = named.where("label is not null").groupBy("label").agg(F.min("least").alias("component_id")).withColumn("salt", salts)
    linked = named.where("label is not null").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(best, ["label", "salt"])
    single = named.where("label is null and copies > 1").select("fp", F.col("least").alias("component_id"))
    per_node = cut(linked.select("fp", "component_id").unionByName(single))  # other rows are components of their own
    out = marked.join(per_node.withColumn("found", F.lit(True)), "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
