"""A symbol graph kept up to date file by file: changed files are parsed again, and only their dependants resolved again.

Beside files, nodes and edges the store has two tables by name: names (what a name may stand for) and mentions
(which files use it). When files change, the names whose targets changed lead to the files that mention them;
these and the changed ones get new edges, from targets looked up by name. Everything else stays untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import Store
from . import code as C
from .graph import cut, drop

SCHEMAS = {
    "files": "path string, language string, text string, hash string",
    "nodes": "id string, kind string, name string, file_path string, language string, start_line int, end_line int, signature string, qualified_name string, docstring string",
    "edges": "src string, dst string, kind string, confidence double, file_path string",
    "names": "name string, id string, kind string, file_path string",
    "mentions": "name string, path string",
}
KEYS = {"files": "path", "nodes": "file_path", "edges": "file_path", "names": "name", "mentions": "name"}
TARGET = ("name", "id", "kind", "file_path")


def open_store(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    return Store(spark, root, SCHEMAS, KEYS, buckets)


def newest(versions: DataFrame) -> DataFrame:
    """The last version (path, language, text, hash) of each file by seq; a null text is a deleted file."""
    last = versions.groupBy("path").agg(F.max_by(F.struct("language", "text"), F.struct("seq", F.xxhash64("text"))).alias("r"))
    return last.select("path", "r.language", "r.text", F.sha2("r.text", 256).alias("hash"))


def _without(rows: DataFrame, paths: DataFrame, column: str) -> DataFrame:
    return rows.join(paths.select(F.col("path").alias(column)), column, "left_anti").select(*rows.columns)


def _of(rows: DataFrame, paths: DataFrame, column: str) -> DataFrame:
    return rows.join(paths.select(F.col("path").alias(column)), column, "left_semi").select(*rows.columns)


def _differ(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of either that the other hasn't (as often); each is read once."""
    both = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    return both.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")


def apply(store: Store, versions: DataFrame, number: int) -> dict[str, list[int]]:
    """Make version number of the graph from the last one before it and versions (path, language, text, seq); the buckets it rewrote, by table."""
    before = store.newest(number - 1)
    latest = cut(newest(versions))
    file_buckets = store.touched(latest, "path")
    known = store.read("files", before, file_buckets)
    pair = latest.alias("n").join(known.alias("o"), "path", "left")
    changed = cut(pair.where("n.text is not null or o.path is not null").where("not (n.hash <=> o.hash)").select("path", "n.language", "n.text", "n.hash", F.col("o.language").alias("old_language"), F.col("o.text").alias("old_text")))
    if changed.isEmpty():
        store.commit(number, {}, before)
        drop(latest, changed)
        return {}
    alive, was = changed.where("text is not null").select("path", "language", "text", "hash"), changed.where("old_text is not null").select("path", F.col("old_language").alias("language"), F.col("old_text").alias("text"))
    file_buckets = store.touched(changed, "path")
    old_nodes, new_nodes = cut(_of(store.read("nodes", before, file_buckets), changed, "file_path")), cut(C.symbols(alive).select(*store.spark.createDataFrame([], SCHEMAS["nodes"]).columns))
    moved = cut(_differ(old_nodes.select(*TARGET), new_nodes.select(*TARGET)))
    name_buckets = store.touched(moved, "name")
    mentioning = store.read("mentions", before, name_buckets).join(moved.select("name").distinct(), "name", "left_semi").select("path").distinct()
    dependants = cut(_without(mentioning, changed, "path"))
    near = store.touched(dependants, "path")
    texts = cut(alive.select("path", "language", "text").unionByName(_of(store.read("files", before, near).select("path", "language", "text"), dependants, "path")))
    nodes = cut(new_nodes.unionByName(_of(store.read("nodes", before, near), dependants, "file_path")))
    # What the affected files mention, as it is now; calls are looked for in bodies once for all who ask.
    mentioned = cut(C.mentions(texts, nodes))
    asked = cut(mentioned.select("name").distinct())
    known_names = _without(store.read("names", before, store.touched(asked, "name")), changed, "file_path").join(asked, "name", "left_semi")
    targets = cut(known_names.select(*TARGET).unionByName(new_nodes.select(*TARGET)))
    edges = C.edges_of(texts, nodes, targets).withColumn("file_path", F.substring_index("src", "::", 1))
    affected = cut(changed.select("path").unionByName(dependants.select("path")))
    edge_buckets = sorted({*file_buckets, *near})
    turned = cut(_differ(C.mentions(was, old_nodes), _of(mentioned, changed, "path")))
    mention_buckets = store.touched(turned, "name")
    kept = lambda name, buckets, paths, column: _without(store.read(name, before, buckets), paths, column)
    swap = lambda name, buckets, diff: _swapped(store.read(name, before, buckets), diff)
    changes = {
        "files": (kept("files", file_buckets, changed, "path").unionByName(alive), file_buckets),
        "nodes": (kept("nodes", file_buckets, changed, "file_path").unionByName(new_nodes), file_buckets),
        "edges": (kept("edges", edge_buckets, affected, "file_path").unionByName(edges), edge_buckets),
        "names": (swap("names", name_buckets, moved), name_buckets),
        "mentions": (swap("mentions", mention_buckets, turned), mention_buckets),
    }
    store.commit(number, changes, before)
    drop(latest, changed, old_nodes, new_nodes, moved, dependants, texts, nodes, mentioned, asked, targets, affected, turned)
    return {name: buckets for name, (_, buckets) in changes.items()}


def _swapped(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """Rows of a set with those that differ turned: what was there goes, what wasn't comes."""
    return rows.unionByName(differing.select(*rows.columns)).groupBy(*rows.columns).count().where(F.col("count") == 1).drop("count")


def sync(source: DataFrame, root: str, checkpoint: str, buckets: int = 64, every: str | None = None) -> StreamingQuery:
    """Keep the graph at root by a stream of file versions (path, language, text, seq); a batch is a version."""

    def each(batch: DataFrame, number: int) -> None:
        apply(open_store(batch.sparkSession, root, buckets), batch, number)

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
