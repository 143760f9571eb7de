"""Symbol and key graphs as (node, edge) DataFrames: building, bounded traversal, paths, grouping, updates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Kinds of edges that walks follow forward, backward, and paths besides.
FORWARD, BACKWARD, PATHS_TOO = ("calls", "references", "entry_to"), ("implements",), ("contains",)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lorefold-")  # one machine, such as tests: driver and executors are one process
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written to the folder in spark.checkpoint.dir and read again, so that loops don't grow their lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def drop(*frames: DataFrame | None) -> None:
    """Delete what cut wrote for these, once nothing reads them any more."""
    for df in frames:
        if getattr(df, "_folder", None):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt over all tasks by keys: for small rows that grow into large ones next, which their own size would leave to one task."""
    spark = df.sparkSession
    return df.repartition(max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def shuffled(df: DataFrame) -> DataFrame:
    """df, whose joins sort and merge: what its keys or files say of its size is far less than its rows take, so that it might be broadcast whole."""
    return df.hint("merge")


def numbered(df: DataFrame, *order: str, name: str = "n") -> DataFrame:
    """df with its rows' places by order, from 0: parts of a range shuffle are counted, and each row adds its part's offset."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_seq", F.monotonically_increasing_id()))
    parts = placed.groupBy(F.shiftright("_seq", 33).alias("_part")).agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each part
    offsets = parts.select("_part", (before - F.col("_first")).alias("_offset"))
    return placed.withColumn("_part", F.shiftright("_seq", 33)).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_seq") + F.col("_offset")).drop("_seq", "_part", "_offset")


def neighbours(edges: DataFrame, paths: bool = False) -> DataFrame:
    """Distinct (src, dst) that walks follow: forward kinds, and interfaces to what implements them."""
    kinds = [*FORWARD, *(PATHS_TOO if paths else ())]
    ahead = edges.where(F.col("kind").isin(kinds)).select("src", "dst")
    back = edges.where(F.col("kind").isin(*BACKWARD)).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return ahead.unionByName(back).distinct()


def reach(pairs: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(start, node, depth): nodes within depth steps of each start (a table of node), by shortest distance; starts left out.

    A frontier loop: each round joins only what was new with the edges and drops what was met before.
    """
    frontier = start.select(F.col("node").alias("start"), F.col("node")).distinct()
    met = frontier.withColumn("depth", F.lit(0))
    for d in range(1, depth + 1):
        ahead = frontier.join(pairs, F.col("node") == F.col("src")).select("start", F.col("dst").alias("node")).distinct()
        frontier = cut(ahead.join(met.select("start", "node"), ["start", "node"], "left_anti"))
        if frontier.isEmpty():
            break
        met = met.unionByName(frontier.withColumn("depth", F.lit(d)))
    return met.where("depth > 0")


def turned(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def walked(edges: DataFrame, paths: bool = False) -> DataFrame:
    """neighbours, written once: every round of a walk reads them."""
    return shuffled(cut(neighbours(edges, paths)))


def callees(edges: DataFrame, start: DataFrame, depth: int = 2) -> DataFrame:
    return reach(walked(edges), start, depth)


def callers(edges: DataFrame, start: DataFrame, depth: int = 2) -> DataFrame:
    return reach(turned(walked(edges)), start, depth)


def impact(edges: DataFrame, start: DataFrame, depth: int = 2) -> DataFrame:
    """(start, direction, node, depth, direct) of callers and callees."""
    pairs = walked(edges)
    both = reach(pairs, start, depth).withColumn("direction", F.lit("callees")).unionByName(reach(turned(pairs), start, depth).withColumn("direction", F.lit("callers")))
    return both.withColumn("direct", F.col("depth") == 1)


def shortest_paths(pairs: DataFrame, start: DataFrame, target: DataFrame, most_nodes: int = 12, most_paths: int = 3) -> DataFrame:
    """(start, target, path, length): the first most_paths simple paths of the least length of each pair of starts and targets.

    Distances come from a frontier loop; paths are then rebuilt backward along falling distances only, so
    no walk that isn't a shortest one is ever held, and of a node's walks most_paths are kept.
    """
    near = cut(reach(pairs, start, most_nodes - 1).unionByName(start.select(F.col("node").alias("start"), "node").distinct().withColumn("depth", F.lit(0))))
    ends = near.join(target.select("node").distinct(), "node", "left_semi").where("depth > 0")
    walks = ends.select("start", F.col("node").alias("target"), F.col("node").alias("head"), F.col("depth").alias("left"), F.array("node").alias("path"))
    deepest = ends.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest):
        going, done = walks.where("left > 0"), walks.where("left = 0")
        back = going.join(pairs, F.col("head") == F.col("dst")).join(near.select(F.col("start").alias("s2"), F.col("node").alias("n2"), "depth"), (F.col("start") == F.col("s2")) & (F.col("src") == F.col("n2")) & (F.col("depth") == F.col("left") - 1))
        step = back.select("start", "target", F.col("src").alias("head"), (F.col("left") - 1).alias("left"), F.concat(F.array("src"), F.col("path")).alias("path"))
        n = F.row_number().over(Window.partitionBy("start", "target", "head").orderBy("path"))
        walks = cut(done.unionByName(step.withColumn("n", n).where(F.col("n") <= most_paths).drop("n")))
    n = F.row_number().over(Window.partitionBy("start", "target").orderBy("path"))
    return walks.where("left = 0").withColumn("n", n).where(F.col("n") <= most_paths).select("start", "target", "path", (F.size("path") - 1).alias("length"))


def format_path(path: Column) -> Column:
    return F.array_join(path, " → ")


def owners(members: DataFrame, types: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """members with owner: the last type at or before their line in the same file, an as-of join over a range shuffle.

    A file's lines may fall into several parts, so that no file needs to go through one task; each part begins
    with the last type of the file's parts before it.
    """
    both = types.select(file, line, F.col("id").alias("type_id"), F.lit(None).cast(members.schema["id"].dataType).alias("id"), F.lit(0).alias("_o")).unionByName(
        members.select(file, line, F.lit(None).cast(types.schema["id"].dataType).alias("type_id"), "id", F.lit(1).alias("_o"))
    )
    order = (file, line, "_o", "type_id")
    placed = cut(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    every = placed.groupBy(file, "_part").agg(F.max(F.when(F.col("_o") == 0, F.struct(line, "type_id"))).alias("_last"))
    before = F.last("_last.type_id", ignorenulls=True).over(Window.partitionBy(file).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    w = Window.partitionBy(file, "_part").orderBy(line, "_o", "type_id").rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn("_own", F.last("type_id", ignorenulls=True).over(w)).where("_o = 1")
    # An owner in another part: few rows, those of parts that go on with a file.
    carried = every.withColumn("_before", before).where("_before is not null").select(F.col(file).alias("_f"), F.col("_part").alias("_p"), "_before")
    met = own.join(carried, own[file].eqNullSafe(F.col("_f")) & (F.col("_part") == F.col("_p")), "left")
    return met.select(file, line, "id", F.coalesce("_own", "_before").alias("owner"))


def stats(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count("*").alias("edges"), F.countDistinct("src").alias("sources"))


def resolve(refs: DataFrame, nodes: DataFrame, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Edges of (src, name) references by qualified name, then short name, then ending; and what stays unresolved."""
    keys = [nodes.select(F.col("qualified_name").alias("name"), F.col("id").alias("dst"), F.lit(0).alias("tier"), F.lit(0.8).alias("confidence"))]
    keys.append(nodes.select(F.col("name"), F.col("id").alias("dst"), F.lit(1).alias("tier"), F.lit(0.65).alias("confidence")))
    exact = refs.join(keys[0].unionByName(keys[1]), "name")
    tail = refs.withColumn("short", F.element_at(F.split("name", r"\."), -1)).where("short <> name").join(keys[1].withColumnRenamed("name", "short").withColumns({"tier": F.lit(2), "confidence": F.lit(0.55)}), "short").drop("short")
    found = exact.unionByName(tail)
    best = F.min("tier").over(Window.partitionBy("src", "name"))
    n = F.row_number().over(Window.partitionBy("src", "name").orderBy("dst"))
    edges = found.withColumn("b", best).where("tier = b").withColumn("n", n).where(F.col("n") <= most).groupBy("src", "dst").agg(F.max("confidence").alias("confidence"))
    return edges.withColumn("kind", F.lit("references")), refs.join(found.select("src", "name").distinct(), ["src", "name"], "left_anti")


def interface_dispatch(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Calls of an interface's method also reach methods of that name in what implements it; confidence 0.42."""
    edges, nodes = shuffled(edges), shuffled(nodes)
    calls = edges.where("kind = 'calls'").select("src", F.col("dst").alias("m"))
    own = edges.where("kind = 'contains'").select(F.col("src").alias("type"), F.col("dst").alias("m"))
    named = own.join(nodes.select(F.col("id").alias("m"), "name"), "m")
    implements = edges.where("kind = 'implements'").select(F.col("src").alias("impl"), F.col("dst").alias("type"))
    to = shuffled(named.select(F.col("type").alias("impl"), "name", F.col("m").alias("dst")))
    found = calls.join(named, "m").join(implements, "type").join(to, ["impl", "name"]).select("src", "dst").distinct()
    known = edges.where("kind = 'calls'").select("src", "dst")
    return found.join(known, ["src", "dst"], "left_anti").select("src", "dst", F.lit("calls").alias("kind"), F.lit(0.42).alias("confidence"))


def module_key(path: Column, parts: int = 1) -> Column:
    """The first parts of a path, without its file."""
    folders = F.split(path, "/")
    return F.array_join(F.slice(folders, F.lit(1), F.least(F.lit(parts), F.greatest(F.lit(1), F.size(folders) - 1))), "/")


def module_tree(nodes: DataFrame, path: str = "file_path", most: int = 50, depth: int = 4) -> DataFrame:
    """(node, module): groups by the first folder, those of more than most nodes split by one folder more, depth at most."""
    out = nodes.withColumn("module", module_key(F.col(path), 1))
    for d in range(2, depth + 1):
        large = out.groupBy("module").count().where(F.col("count") > most).select("module", F.lit(True).alias("_large"))
        out = out.join(large, "module", "left").withColumn("module", F.when(F.col("_large"), module_key(F.col(path), d)).otherwise(F.col("module"))).drop("_large")
    return out


def pack_snippets(nodes: DataFrame, module: str, order: str, tokens: str, budget: int) -> DataFrame:
    """(module, order, taken): in order, snippets that still fit the budget are taken, others are passed over.

    Modules go through tasks sorted and row by row; only the room used so far is held.
    """
    kinds = {c: nodes.schema[c].dataType.simpleString() for c in (module, order)}

    def pack(frames):
        at, used = None, 0
        for frame in frames:
            taken = []
            for m, n in zip(frame[module], frame["_n"]):
                if m != at:
                    at, used = m, 0
                fits = used + n <= budget
                used += n if fits else 0
                taken.append(fits)
            yield frame[[module, order]].assign(taken=taken)

    rows = nodes.select(module, order, F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)).alias("_n")).repartition(module).sortWithinPartitions(module, order)
    return rows.mapInPandas(pack, f"`{module}` {kinds[module]}, `{order}` {kinds[order]}, taken boolean")


def save(old_nodes: DataFrame, old_edges: DataFrame, nodes: DataFrame, edges: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph with all nodes of the given (file_path) files replaced, and edges at removed nodes dropped."""
    removed = old_nodes.join(files, "file_path", "left_semi").select("id")
    kept = old_nodes.join(files, "file_path", "left_anti").select(*old_nodes.columns).unionByName(nodes)
    gone = removed.join(nodes.select("id"), "id", "left_anti")
    left = old_edges.join(removed.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return kept, left.select("src", "dst", "kind").unionByName(edges.select("src", "dst", "kind")).distinct()


def foreign_key_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, kind) from each row to those that refer to it, over the relational tables."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    node = lambda kind, c: F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    links = [("nation", "region", "n_regionkey", "nation", "n_nationkey"), ("customer", "nation", "c_nationkey", "customer", "c_custkey"), ("supplier", "nation", "s_nationkey", "supplier", "s_suppkey"), ("orders", "customer", "o_custkey", "order", "o_orderkey")]
    out = None
    for table, a, from_col, b, to_col in links:
        one = read(table).select(node(a, from_col).alias("src"), node(b, to_col).alias("dst"), F.lit(f"{a}_{b}").alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out
