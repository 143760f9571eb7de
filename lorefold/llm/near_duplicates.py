"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Contract
* Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII; a text's set holds all
  its runs of SHINGLE words, or the whole of its words if it has fewer. Two texts are linked when the
  Jaccard similarity of their sets is THRESHOLD or more; linked texts form a class, transitively.
* Per row: doc_id, class_id (smallest id of the class), n_links (other sets linked to its own), copies
  (rows with the same set, itself included), n_shingles. Texts without words (null, empty) are classes of
  their own. Rows that repeat an id count each; extra columns pass; an empty table gives no rows.

Method: equal sets collapse to one node first, so copies cost nothing later. Bands and rows of the MinHash
signature are chosen so that a pair at the threshold shares a band with probability RECALL. Nodes are
shuffled on band hashes; each is tied to the smallest node of every bucket only, and what hangs together
is a candidate group. Its nodes are put into blocks of bounded bytes, those of one bucket side by side, and
only blocks that share a bucket meet: each such pair of blocks is verified on full sets in one task, which
counts pairs and never lists them. So a chain of many near copies costs what its buckets cost, and one
large group of near copies gives rows in proportion to its members and blocks. (Within a bucket
comparisons still grow with the square of its different sets, as counting their links asks.)
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, match_rows, pieces, ragged, row_key, settle, split_words, starts, table

SHINGLE, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
#: Members and shingles of a block at most (a single larger set is a block of its own).
BLOCK_MEMBERS, BLOCK_SHINGLES = 128, 250_000
#: Rows of keys (about 50 bytes each) that are broadcast at most; beyond that the join shuffles.
BROADCAST_ROWS = 200_000
SALTS = 16
#: Bytes of texts or sets that a task works on at once; a larger one is taken whole.
AT_ONCE = 2 << 20
MEETS = "array<struct<i:long,j:long>>"
PRIME = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, that reach recall with so many hashes."""
    for rows in range(hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("so many hashes can't reach this recall")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of n words, in a row, and where each text's begin."""
    words, per_text = split_words(texts)
    coded = words.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    w = np.concatenate([hashes[np.asarray(coded.indices)], np.zeros(n, np.uint64)]) if len(words) else np.zeros(n, np.uint64)
    first = starts(per_text)[:-1]
    runs = np.where(per_text >= n, per_text - n + 1, 0)
    at = ragged(first, runs)
    h = w[at]
    for k in range(1, n):
        h = h * PRIME + w[at + k]
    h, edge, out = mix(h), starts(runs), []
    for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
        if b > a:
            out.append(np.unique(h[a:b]))
        elif per_text[i]:
            short = w[first[i] : first[i] + per_text[i]]
            out.append(np.array([xxhash.xxh64_intdigest(short.tobytes(), seed=1)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), starts(np.fromiter(map(len, out), np.int64, len(out)))


def band_hashes(sets: np.ndarray, edge: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash a text and band; texts without shingles must not be asked."""
    rng = np.random.default_rng(20240229)
    factor = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    out = np.zeros((len(edge) - 1, bands), np.uint64)
    at = np.searchsorted(edge, np.arange(0, edge[-1], 65536)).tolist()  # some texts at a time, so that they stay in cache
    bounds = [*dict.fromkeys(at), len(edge) - 1]
    for a, b in zip(bounds, bounds[1:]):
        h, begin = sets[edge[a] : edge[b]], edge[a:b] - edge[a]
        for band in range(bands):
            total = np.full(b - a, band + 1, np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                total = total * PRIME + np.minimum.reduceat((h * factor[k] + shift[k]) >> np.uint64(16), begin)
            out[a:b, band] = mix(total)
    return out


def _sketch(bands: int, rows: int):
    def sketch(batches):
        for batch in pieces(batches, "_t", AT_ONCE):
            sets, edge = shingle_sets(batch.column(2))
            size = np.diff(edge)
            some = size > 0
            hashes = np.zeros((batch.num_rows, bands), np.int64)
            if some.any():
                hashes[some] = band_hashes(sets, starts(size[some]), bands, rows).view(np.int64)
            digest = [xxhash.xxh3_128_digest(sets[a:b].tobytes()) if b > a else None for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, hashes.size + 1, bands, dtype=np.int32)), pa.array(hashes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digest, pa.binary()), pa.array(size), lists], ["_id", "_k", "node", "n_shingles", "bands"])
        settle()

    return sketch


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node on the (a, b) edges; label is one node of its component.

    Every round ties each node to its smallest neighbour's smallest neighbour and contracts the edges;
    labels are hashes, so the number of rounds grows with the logarithm of the longest path.
    """
    edges, labels = cut(edges.where("a <> b").distinct()), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        down = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
        onward = down.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = cut(down.join(onward, "label").select("node", F.col("next").alias("label")))
        moved = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = step if labels is None else cut(labels.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        sides = [step.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
        edges = cut(edges.join(sides[0], "a").join(sides[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b").distinct())
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def compare(sets: list[np.ndarray], left: int | None, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold; with left, only pairs of the first left sets with the others."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), size)
    values, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    column = np.cumsum(times > 1) - 1
    owner, code = owner[shared], column[code[shared]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    for a in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        part = slice(np.searchsorted(code, a), np.searchsorted(code, a + width))
        there = np.zeros((len(sets), min(width, int(code[-1]) + 1 - a)), np.float32)
        there[owner[part], code[part] - a] = 1
        common += there @ there.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if left is not None:
        linked[:left, :left] = linked[left:, left:] = False
    return linked


def _verify(threshold: float):
    schema = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])

    def verify(batches):
        def outcome(key, members):
            members.sort(key=lambda x: (x[1] != key[1], x[0]))
            left = None if key[1] == key[2] else sum(x[1] == key[1] for x in members)
            if len(members) < 2 or left == len(members):
                return None
            linked = compare([np.frombuffer(x[2], np.uint64) for x in members], left, threshold)
            links = linked.sum(1)
            label = np.arange(len(members))
            while True:  # the smallest label among each member and those linked to it
                new = np.minimum(label, np.where(linked, label[None, :], len(members)).min(1, initial=len(members)))
                new = new[new]
                if (new == label).all():
                    break
                label = new
            at = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array([members[i][0] for i in at], pa.binary()), pa.array([members[label[i]][0] for i in at], pa.binary()), pa.array(links[at])], schema=schema)

        key, members = None, []
        for batch in pieces(batches, "data", AT_ONCE):
            for node, group, i, j, block, data in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if (group, i, j) != key:
                    if members and (out := outcome(key, members)) is not None:
                        yield out
                    key, members = (group, i, j), []
                members.append((node, block, data))
        if members and (out := outcome(key, members)) is not None:
            yield out
        settle()

    return verify


def _sets(batches):
    for batch in pieces(batches, "_t", AT_ONCE):
        sets, edge = shingle_sets(batch.column(batch.num_columns - 1))
        data = pa.array([sets[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(batch.num_columns - 1)), data], ["node", "group", "block", "meets", "data"])
    settle()


def _small(df: DataFrame) -> DataFrame:
    """df as a broadcast, if a count finds it small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _blocks(tied: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, group, block, meets, _i2, _k2) of nodes that share a bucket: meets lists the pairs of blocks (i, j) its block is compared in.

    A node goes by its smallest shared bucket. What many nodes share is dealt to blocks of its own by node
    hash; small parts of a group are put together, by bucket hash, into as few blocks as their sizes ask for.
    """
    first = tied.groupBy("node").agg(F.min("bucket").alias("by"))
    groups = components(tied.select(F.col("node").alias("a"), F.col("hub").alias("b"))).withColumnRenamed("label", "group")
    member = cut(groups.join(first, "node").join(classes.select("node", "n_shingles", F.col("_id").alias("_i2"), F.col("_k").alias("_k2")), "node"))
    n_blocks = lambda k, total: F.greatest(F.lit(1), F.ceil(k / BLOCK_MEMBERS), F.ceil(total / BLOCK_SHINGLES)).cast("int")
    parts = member.groupBy("group", "by").agg(F.count("*").alias("k"), F.sum("n_shingles").alias("total")).withColumn("own", n_blocks(F.col("k"), F.col("total")))
    small = F.col("own") == 1
    bins = parts.groupBy("group").agg(n_blocks(F.sum(F.when(small, F.col("k"))), F.sum(F.when(small, F.col("total")))).alias("bins"), (F.sum("own") > 1).alias("several"))
    dealt = parts.select("group", "by", "own").join(bins, "group")
    block = F.when(small, F.xxhash64(F.pmod(F.xxhash64("by"), F.col("bins")))).otherwise(F.xxhash64("by", F.pmod(F.xxhash64("node"), F.col("own"))))
    member = cut(member.join(dealt, ["group", "by"]).select("node", "group", block.alias("block"), "several", "_i2", "_k2"))
    # Blocks of one bucket meet; groups of a single block need no look.
    spans = tied.join(member.where("several").select("node", "group", "block"), "node").select("bucket", "group", "block").distinct()
    met = spans.select("bucket", "group", F.col("block").alias("i")).join(spans.select("bucket", F.col("block").alias("j")), "bucket").where("i < j").select("group", "i", "j").distinct()
    both = met.select("group", F.col("i").alias("block"), "i", "j").unionByName(met.select("group", F.col("j").alias("block"), "i", "j"))
    meets = both.groupBy("group", "block").agg(F.collect_list(F.struct("i", "j")).alias("more"))
    alone = F.array(F.struct(F.col("block").alias("i"), F.col("block").alias("j")))
    return cut(member.join(meets, ["group", "block"], "left").select("node", "group", "block", F.concat(alone, F.coalesce("more", F.array().cast(MEETS))).alias("meets"), "_i2", "_k2"))


def _linked(rows: DataFrame, sketches: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal sets (node, id, key, copies), links (node, n_links), and (node, label) of linked nodes."""
    per_set = sketches.where("n_shingles > 0").groupBy("node", "n_shingles").agg(F.min(F.struct("_id", "_k")).alias("r"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    classes = cut(per_set.select("node", "n_shingles", F.col("r._id").alias("_id"), F.col("r._k").alias("_k"), "copies", "bands"))
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    tied = cut(buckets.join(crowded, "bucket").select("node", "hub", "bucket"))
    member = _blocks(tied, classes)
    texts = rows.join(_small(member), (F.col("_k") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_i2"))).select("node", "group", "block", "meets", "_t")
    texts = texts.dropDuplicates(["node"])  # the row that stands for a class may be repeated
    sets = texts.mapInArrow(_sets, f"node binary, group binary, block long, meets {MEETS}, data binary")
    pairs = sets.withColumn("m", F.explode("meets")).select("node", "group", "m.i", "m.j", "block", "data")
    dealt = pairs.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    found = cut(dealt.mapInArrow(_verify(threshold), "node binary, root binary, links long"))
    return classes, found.groupBy("node").agg(F.sum("links").alias("n_links")), components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: _id, _k, class_id, class_k (row key of the class's smallest row), n_links, copies, n_shingles."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("_id"), row_key(doc_id, text).alias("_k"), F.col(text).alias("_t"))
    sketches = cut(rows.mapInArrow(_sketch(*choose_bands(threshold, recall)), f"_id {kind}, _k bigint, node binary, n_shingles bigint, bands array<bigint>"))
    classes, links, labels = _linked(rows, sketches, threshold)
    named = classes.select("node", "_id", "_k", "copies").join(labels, "node", "left").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = cut(named)
    # A class may hold many nodes: its smallest row is copied for SALTS parts of them.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    least = named.groupBy("label").agg(F.min(F.struct("_id", "_k")).alias("c")).withColumn("salt", salts)
    per_node = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(least, ["label", "salt"]).select("node", F.col("c._id").alias("class_id"), F.col("c._k").alias("class_k"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "copies")
    per_node = per_node.where("copies > 1 or n_links > 0")  # other rows are classes of their own
    out = sketches.drop("bands").join(per_node, "node", "left")
    own = F.col("copies").isNull()
    return out.select(
        "_id", "_k", F.when(own, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(own, F.col("_k")).otherwise(F.col("class_k")).alias("class_k"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"), "n_shingles"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """documents with one row of each class: that of the smallest id."""
    found = cut(near_duplicates(documents))
    same = F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_k") == F.col("class_k"))
    gone = cut(found.where(~same).select("_id", "_k").distinct())
    kept = match_rows(documents, gone, "left_anti", broadcast=gone.count() <= BROADCAST_ROWS)[0]
    repeated = found.where(same & (F.col("n_shingles") > 0)).groupBy("_id", "_k").count().where("count > 1").select("_id", "_k")
    return kept if repeated.isEmpty() else _drop_repeats(kept)


def _drop_repeats(documents: DataFrame) -> DataFrame:
    """Rows of equal id and text down to one, but for texts without words."""
    (key,) = free_names(documents, "_key")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    once = documents.where(~wordless).withColumn(key, row_key("doc_id")).dropDuplicates(["doc_id", key]).drop(key)
    return once.unionByName(documents.where(wordless))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "class_id", "n_links", "copies", "n_shingles")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(list_slice(w, k, k + 4), ' ')))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
k AS (SELECT doc_id, g, sha256(array_to_string(g, ',')) AS node FROM s),
n AS (SELECT node, any_value(g) AS g, len(any_value(g)) AS size, min(doc_id) AS id, count(*) AS copies FROM k WHERE len(g) > 0 GROUP BY node),
u AS (SELECT node, size, unnest(g) AS x FROM n),
e AS (SELECT a.node AS a, b.node AS b FROM u a JOIN u b ON a.x = b.x AND a.node <> b.node GROUP BY a.node, b.node, a.size, b.size HAVING count(*) >= 0.8 * (a.size + b.size - count(*))),
r AS (SELECT node AS a, node AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS node, min(n.id) AS class_id FROM r JOIN n ON n.node = r.b GROUP BY r.a),
l AS (SELECT a AS node, count(*) AS links FROM e GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(links, 0)::BIGINT AS n_links, coalesce(copies, 1)::BIGINT AS copies, len(k.g)::BIGINT AS n_shingles FROM k LEFT JOIN n USING (node) LEFT JOIN c USING (node) LEFT JOIN l USING (node)
"""
