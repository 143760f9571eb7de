"""Merkle manifest of a table whose edits are path-copied versions of a persistent tree.

Contract
* A leaf is H of a row's fields in order, each `-` if null, else its UTF-8 bytes' number, `:` and itself; H is
  lower-case hex SHA-256 of its inputs' text in a row. Rows of a tree name (null is a name) stand by id, null
  first, then by leaf. While a tree has several nodes, every FAN neighbours (the last run may be shorter) become
  their H. The trees' roots, by name, null first and bytewise, form one more tree, whose root is the table's.
* An edited row is a version of its own: it shares all nodes but its ancestors, which are copied. A row that isn't
  edited folds to the same nodes again.
* Per row: id, leaf, edited leaf, subroot, root, proof (its runs' other nodes, upward, left to right), copied
  (its version's ancestors, upward; empty for a table of one row) and folded_root, verified.
* Rows that repeat an id each have a leaf; equal ones are exchangeable. Null ids, sources, numbers and texts are
  leaves like any other; very long texts are hashed whole. Further columns of any name pass: only the named
  fields are used. An empty table gives no rows.

Method: rows are put in order by a range shuffle, and numbered by the offsets of its parts, so a hot source is
spread like any other. FAN ** BLOCK_LEVELS neighbours form an aligned block, in which all levels are hashed at
once; blocks' roots go on as the nodes of the next round, until every tree has one. Downward, each round hands a
block the path above it: a version copies the ancestors inside its block and goes on along that path. No round
holds more than a block in a row, and nothing but the largest tree's size reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

FAN, BLOCK_LEVELS = 3, 6
WIDTH = FAN**BLOCK_LEVELS
#: Offsets (a row for each tree and part of the order) that are broadcast at most; beyond that the join shuffles.
BROADCAST_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(*fields):
    """H of the fields, each led by its number of bytes; a null field is `-`."""
    text = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def in_order(nodes: DataFrame, *order: str) -> DataFrame:
    """nodes with pos, their place in their tree by order, and n, the tree's size."""
    salted = nodes.withColumn("_at", F.monotonically_increasing_id())  # equal rows may go to several parts
    sorted_ = salted.repartitionByRange("tree", *order, "_at").sortWithinPartitions("tree", *order, "_at").drop("_at")
    numbered = cut(sorted_.withColumn("_seq", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_part", F.shiftright("_seq", 33))
    parts = numbered.groupBy("tree", "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(parts.select("tree", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy("tree")).alias("n")))
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_ROWS else offsets
    return numbered.join(offsets, ["tree", "_part"]).withColumn("pos", F.col("_seq") - F.col("_first") + F.col("_before")).drop("_seq", "_part", "_first", "_before")


def blocks(nodes: DataFrame, *kept: str) -> DataFrame:
    """One row per aligned block: tree, block, n (nodes of the tree), rows sorted by pos with their hash and what is kept."""
    members = F.sort_array(F.collect_list(F.struct("pos", "hash", *kept)))
    return cut(nodes.groupBy("tree", F.floor(F.col("pos") / WIDTH).alias("block")).agg(F.max("n").alias("n"), members.alias("rows")))


def levels():
    """All levels of a block, from its rows' hashes up to its root alone."""
    up = lambda level: F.transform(F.sequence(F.lit(1), F.size(level), F.lit(FAN)), lambda first: F.sha2(F.array_join(F.slice(level, first, F.lit(FAN)), ""), 256))
    return F.aggregate(_steps(), F.array(F.transform("rows", lambda r: r["hash"])), lambda done, _: F.concat(done, F.array(up(F.element_at(done, -1)))))


def _steps():
    """The numbers of a block's levels below its root: as many as a small tree needs, else all."""
    needed = sum(((F.col("n") > FAN**k).cast("int") for k in range(BLOCK_LEVELS)), F.lit(0))
    return F.slice(F.array(*[F.lit(k) for k in range(BLOCK_LEVELS)]), F.lit(1), needed)


def grow(nodes: DataFrame, *kept: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, lowest first, and (tree, hash) of the roots."""
    rounds = []
    while True:
        rounds.append(blocks(nodes, *(kept if len(rounds) == 0 else ())))
        tops = rounds[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / WIDTH).alias("n"), F.element_at(F.element_at(levels(), -1), 1).alias("hash"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= WIDTH:
            return rounds, tops.select("tree", "hash")
        nodes = tops


def below(level: DataFrame, above: DataFrame) -> DataFrame:
    """One row per node of a round's blocks: what above (tree, block, path, ...) says of its block, its own row and its whole path."""
    side = lambda level, i, k, first, count: F.array_join(F.slice(level, first, count), "")
    place = lambda i, k: F.floor(i / F.pow(F.lit(FAN), k)).cast("int")

    def step(all_levels, i, k):
        """The hashes beside node i's ancestor at level k: those to the left, and those to the right."""
        at, level = place(i, k), F.element_at(all_levels, k + 1)
        inside = F.pmod(at, F.lit(FAN))
        return F.named_struct(F.lit("left"), side(level, i, k, at - inside + 1, inside), F.lit("right"), side(level, i, k, at + 2, F.lit(FAN - 1) - inside))

    joined = level.join(above, ["tree", "block"]).withColumn("_levels", levels()).withColumn("_steps", _steps())
    inner = lambda i: F.transform("_steps", lambda k: step(F.col("_levels"), i, k))
    each = F.transform("rows", lambda r, i: F.named_struct(F.lit("row"), r, F.lit("path"), F.concat(inner(i), F.col("path"))))
    others = [c for c in above.columns if c not in ("block", "path")]
    return joined.select(*others, F.explode(each).alias("_x")).select(*others, "_x.row", "_x.path")


def descend(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Nodes of the lowest round with their paths to where top (tree, path, ...) goes on."""
    above = top.withColumn("block", F.lit(0).cast("bigint"))
    for level in reversed(rounds[1:]):
        nodes = below(level, above)
        above = cut(nodes.select(*[c for c in nodes.columns if c not in ("row", "path")], F.col("row.pos").alias("block"), "path"))
    return below(rounds[0], above)


def manifest(rows: DataFrame, leaf, edited, row_id: str = "doc_id", tree: str = "source") -> DataFrame:
    """leaf and edited are columns of rows: the hash as it stands, and that of the edited row or null."""
    name = F.coalesce(F.concat(F.lit("+"), F.col(tree).cast("string")), F.lit(""))  # null sorts first and stays apart from ''
    leaves = rows.select(name.alias("tree"), F.col(row_id).alias("id"), leaf.alias("hash"), edited.alias("edited"))
    rounds, roots = grow(in_order(cut(leaves), "id", "hash"), "id", "edited")  # the range shuffle reads its input twice, so not the texts
    roots = cut(roots)
    upper, root = grow(in_order(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), "name"), "name")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    named = descend(upper, root.select("tree", F.col("hash").alias("root"), no_path.alias("path")))
    named = cut(named.select(F.col("row.name").alias("tree"), "root", F.col("row.hash").alias("subroot"), "path"))
    found = descend(rounds, named).select(F.col("row.id").alias("id"), F.col("row.hash").alias("leaf"), F.col("row.edited").alias("edited"), "subroot", "root", "path")
    start = F.coalesce("edited", "leaf")
    version = F.aggregate("path", F.array(start), lambda done, s: F.concat(done, F.array(digest(s["left"], F.element_at(done, -1), s["right"]))))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = found.withColumn("proof", proof).withColumn("copied", version).withColumn("folded_root", F.element_at("copied", -1))
    return out.select("id", "leaf", "edited", "subroot", "root", "proof", F.slice("copied", F.lit(2), F.size("copied")).alias("copied"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    field = [F.col(c) for c in FIELDS]
    tampered = leaf_hash(*field[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    found = manifest(documents, leaf_hash(*field), F.when(hit, tampered))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


ORACLE = r"""
WITH RECURSIVE c AS (SELECT row_number() OVER () AS rid, coalesce('+' || source, '') AS tree, doc_id, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
  list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda x: x::UBIGINT)), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))) AS crc FROM documents),
l AS (SELECT rid, tree, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS edited FROM c),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
t AS (SELECT tree, 0 AS lev, pos, n, leaf AS h FROM p UNION ALL SELECT tree, lev + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY tree, lev, pos // 3),
s AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lev, pos, n, h FROM s UNION ALL SELECT lev + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lev, pos // 3),
tr AS MATERIALIZED (SELECT tree, lev, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
ur AS MATERIALIZED (SELECT lev, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
f AS (SELECT rid, tree, 0 AS lev, pos, '' AS proof, coalesce(edited, leaf) AS h FROM p
  UNION ALL SELECT rid, f.tree, f.lev + 1, pos // 3, proof || array_to_string(hs[1:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], ''), sha256(array_to_string(hs[1:pos % 3], '') || h || array_to_string(hs[pos % 3 + 2:], '')) FROM f JOIN tr ON f.tree = tr.tree AND f.lev = tr.lev AND pos // 3 = run),
ft AS MATERIALIZED (SELECT f.rid, s.tree, s.pos, s.h AS subroot, proof, f.h FROM f JOIN s USING (tree) WHERE f.lev = (SELECT max(lev) FROM t WHERE t.tree = f.tree)),
g AS (SELECT rid, subroot, 0 AS lev, pos, proof, h FROM ft
  UNION ALL SELECT rid, subroot, g.lev + 1, pos // 3, proof || array_to_string(hs[1:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], ''), sha256(array_to_string(hs[1:pos % 3], '') || h || array_to_string(hs[pos % 3 + 2:], '')) FROM g JOIN ur ON g.lev = ur.lev AND pos // 3 = run)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, g.h AS folded_root, g.h = root AS verified
FROM g JOIN p USING (rid), (SELECT h AS root FROM u WHERE n = 1) WHERE g.lev = (SELECT max(lev) FROM u)
"""
