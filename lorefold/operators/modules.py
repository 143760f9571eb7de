"""Module trees of nodes by their paths, level by level, and what each leaf shows of its sources and edges.

A tree is an adjacency table: a row per module with its place (names from the top), depth and size. Groups that
are too large are split again, all of a level at once; only sizes per group travel back to the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut, pack_snippets

#: Folders of a package key, letters of a file's name as a key, shares of a budget that are filled, that call for a split, and edges shown.
KEY_PARTS, STEM_LETTERS, FILLED, REFINED, EDGES = 4, 20, 0.9, 0.8, 50


def parts(path):
    return F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda p: p != "")


def stem(path):
    """A file's name without its last ending."""
    name = F.element_at(F.concat(F.array(F.lit("")), parts(path)), -1)
    return F.when(name.rlike(r".\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def top_key(path, by_package: bool = False):
    """The first folder, or the first folders of a package (without the file); `root` without a path."""
    own = parts(path)
    few = F.least(F.lit(KEY_PARTS), F.greatest(F.lit(1), F.size(own) - 1)) if by_package else F.lit(1)
    return F.when(F.size(own) == 0, "root").otherwise(F.array_join(F.slice(own, F.lit(1), few), "/"))


def split_key(path):
    """The first parts of a long path, else its last."""
    own = parts(path)
    return F.when(F.size(own) >= KEY_PARTS, F.array_join(F.slice(own, 1, KEY_PARTS), "_")).when(F.size(own) > 0, F.element_at(F.concat(F.array(F.lit("")), own), -1)).otherwise("_")


def tree(nodes: DataFrame, depth: int = 3, most: int = 200, by_package: bool = False) -> tuple[DataFrame, DataFrame]:
    """(place, name, parent, depth, n, leaf) of every module, and (id, file_path, place) of nodes with their leaf.

    A module of more than most nodes is split by split_key, or by file names where that gives one group, until
    depth levels are reached; one that can't be split further stays a leaf with all its nodes.
    """
    at = cut(nodes.where("kind <> 'file'").select("id", "file_path", F.array(top_key(F.col("file_path"), by_package)).alias("place")))
    levels = []
    for level in range(1, depth + 1):
        sub = split_key(F.col("file_path"))
        size = cut(at.groupBy("place").agg(F.count("*").alias("n"), (F.min(sub) == F.max(sub)).alias("one")).where(F.size("place") == level))
        split = (F.col("n") > most) & F.lit(level < depth)
        levels.append(size.select("place", "n", (~split).alias("leaf")))
        large = size.where(split).select("place", "one")
        if level == depth or large.isEmpty():
            break
        name = F.when(F.col("one"), F.substring(stem(F.col("file_path")), 1, STEM_LETTERS)).otherwise(sub)
        at = cut(at.join(large, "place", "left").select("id", "file_path", F.when(F.col("one").isNull(), F.col("place")).otherwise(F.concat("place", F.array(name))).alias("place")))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    path = F.col("place")
    parent = F.when(F.size(path) > 1, F.slice(path, F.lit(1), F.size(path) - 1))
    return out.select("place", F.element_at(path, -1).alias("name"), parent.alias("parent"), F.size(path).alias("depth"), "n", "leaf"), at


def components(leaves: DataFrame, most: int = 200) -> DataFrame:
    """The first most nodes of each leaf, by id."""
    n = F.row_number().over(Window.partitionBy("place").orderBy("id"))
    return leaves.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def contexts(leaves: DataFrame, snippets: DataFrame, edges: DataFrame, budget: int = 8000) -> tuple[DataFrame, DataFrame]:
    """(leaf, place, id, file_path, tokens, taken) of every component, and (leaf, src, dst, kind, rank) of the first EDGES edges at each leaf.

    Components go by id; a snippet (id, tokens) is taken while the leaf's taken ones fit FILLED of the budget;
    components without a snippet are named but take nothing. An edge inside a leaf counts once.
    """
    leaf = F.array_join("place", "_")
    rows = cut(leaves.select(leaf.alias("leaf"), "place", "id", "file_path").join(snippets.select("id", "tokens"), "id", "left"))
    taken = pack_snippets(rows.where("tokens is not null"), "leaf", "id", "tokens", int(budget * FILLED))
    out = rows.join(taken, ["leaf", "id"], "left").select("leaf", "place", "id", "file_path", "tokens", F.coalesce("taken", F.lit(False)).alias("taken"))
    ends = edges.select("src", "dst", "kind", F.explode(F.array_distinct(F.array("src", "dst"))).alias("id"))
    near = ends.join(rows.select("id", "leaf"), "id").select("leaf", "src", "dst", "kind").distinct()
    rank = F.row_number().over(Window.partitionBy("leaf").orderBy("src", "dst", "kind"))
    return out, near.withColumn("rank", rank).where(F.col("rank") <= EDGES)


def refine(rows: DataFrame, budget: int = 8000) -> DataFrame:
    """(leaf, parent, id, file_path, tokens, taken, reason): leaves whose taken snippets fill more than REFINED of the budget become one a file.

    A part holds the parent's taken snippets of its file, as many as fit FILLED of the budget; it is named after the file.
    """
    total = rows.groupBy("leaf").agg(F.sum(F.when(F.col("taken"), F.col("tokens")).otherwise(0)).alias("_t"))
    large = F.col("_t") > budget * REFINED
    joined = cut(rows.join(total, "leaf"))
    same = joined.where(~large).select("leaf", F.lit(None).cast("string").alias("parent"), "id", "file_path", "tokens", "taken", F.lit(None).cast("string").alias("reason"))
    divided = joined.where(large & F.col("taken")).select(F.col("leaf").alias("parent"), "id", "file_path", "tokens").withColumn("part", F.to_json(F.struct("parent", "file_path")))
    taken = pack_snippets(divided, "part", "id", "tokens", int(budget * FILLED))
    parts_ = divided.join(taken, ["part", "id"]).select(F.concat("parent", F.lit("__"), stem(F.col("file_path"))).alias("leaf"), "parent", "id", "file_path", "tokens", "taken", F.lit("file_level_split").alias("reason"))
    return same.unionByName(parts_)
