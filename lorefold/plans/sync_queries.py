"""Queries of graphs kept by streams, debounced changes and module trees; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import incremental as I
from ..operators import modules as M
from ..streaming import sync
from .code_queries import java_files
from .text_queries import read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(
    """WITH p AS (SELECT p_partkey AS k, 'src/m' || (p_partkey % 10) || '/Part' || p_partkey || '.java' AS path, p_size % 7 <> 0 AS alive, CASE WHEN p_size % 5 = 0 THEN 'go' ELSE 'run' END AS m FROM part), a AS (SELECT * FROM p WHERE alive)
    SELECT path AS src, path || '::GetMapping' AS dst, 'contains' AS kind, 1.0::DOUBLE AS confidence FROM a WHERE k % 3 = 0 UNION ALL SELECT path, path || '::Part' || k, 'contains', 1.0 FROM a UNION ALL SELECT path || '::Part' || k, path || '::' || m || k, 'contains', 1.0 FROM a
    UNION ALL SELECT a.path || '::' || a.m || a.k, b.path || '::run' || b.k, 'calls', 0.6 FROM a JOIN a b ON b.k = a.k + 1 WHERE b.m = 'run' UNION ALL SELECT a.path || '::Part' || a.k, b.path || '::Part' || b.k, 'extends', 0.8 FROM a JOIN a b ON b.k = a.k - 1"""
)
def graph_incremental(spark, sf_dir):
    """Edges of a repository that comes as a stream: all files, then some with methods renamed, then some deleted; changed files and their dependants alone are resolved again."""
    base = G.shared_folder(spark)
    first = java_files(spark, sf_dir)
    p = read(spark, sf_dir, "part")
    path = F.concat(F.lit("src/m"), s(F.col("p_partkey") % 10), F.lit("/Part"), s(F.col("p_partkey")), F.lit(".java"))
    those = lambda n: p.where(F.col("p_size") % n == 0).select(path.alias("path"))
    renamed = first.join(those(5), "path", "left_semi").withColumn("text", F.replace("text", F.lit("public int run"), F.lit("public int go")))
    deleted = those(7).select("path", F.lit("java").alias("language"), F.lit(None).cast("string").alias("text"))
    for seq, versions in enumerate((first, renamed, deleted)):
        versions.withColumn("seq", F.lit(seq).cast("bigint")).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema("path string, language string, text string, seq long").parquet(f"{base}/in")
        I.sync(source, f"{base}/graph", f"{base}/checkpoint").awaitTermination()
    store = I.open_store(spark, f"{base}/graph")
    return store.read("edges", store.newest()).select("src", "dst", "kind", "confidence")


CHANGED = "'a/' || CASE event_type WHEN 'view' THEN 'target/X.java' WHEN 'purchase' THEN 'logo.png' WHEN 'click' THEN 'F' || (event_id % 3) || '.java' ELSE event_type || '.py' END"


@query(
    f"""WITH e AS (SELECT user_id, ts, {CHANGED} AS path FROM events WHERE event_type NOT IN ('view', 'purchase')),
    g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM e), b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM g)
    SELECT 'repo' || user_id AS source, min(ts)::VARCHAR AS begun, (max(ts) + INTERVAL 6 HOUR)::VARCHAR AS fires, count(*) AS changes, count(DISTINCT path) AS files FROM b GROUP BY user_id, burst"""
)
def stream_debounced(spark, sf_dir):
    """One firing per burst of watched changes, six quiet hours after its last, from a stream of files in order of time and a last beat."""
    e = read(spark, sf_dir, "events")
    base = G.shared_folder(spark)
    kind = F.col("event_type")
    name = F.when(kind == "view", "target/X.java").when(kind == "purchase", "logo.png").when(kind == "click", F.concat(F.lit("F"), s(F.col("event_id") % 3), F.lit(".java"))).otherwise(F.concat(kind, F.lit(".py")))
    changes = e.select(F.concat(F.lit("repo"), s(F.col("user_id"))).alias("source"), F.concat(F.lit("a/"), name).alias("path"), F.col("ts").cast("timestamp").alias("time"))
    beat = e.agg(F.max("ts").alias("t")).select(F.lit("beat").alias("source"), F.lit("beat.py").alias("path"), (F.col("t").cast("timestamp") + F.expr("INTERVAL 120 DAYS")).alias("time"))
    changes.repartitionByRange(3, "time").write.parquet(f"{base}/in")
    beat.write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 8).parquet(f"{base}/in")
    fired = sync.debounced(source, "6 hours", "60 days")
    fired.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").where("source <> 'beat'").select("source", F.col("begun").cast("string").alias("begun"), F.col("fires").cast("string").alias("fires"), "changes", "files")


TREE_MOST, BUDGET = 20, 600


def document_nodes(spark, sf_dir):
    """Documents as nodes of folders by language and source; some are files that trees leave out."""
    d = read(spark, sf_dir, "documents")
    k = F.col("doc_id")
    path = F.concat_ws("/", "lang", "source", F.concat(F.lit("c"), s(k % 2)), F.concat(F.lit("D"), s(k % 9), F.lit(".txt")))
    return d.select(k.alias("id"), path.alias("file_path"), F.when(k % 11 == 0, "file").otherwise("text").alias("kind"), F.floor(F.col("n_chars") / 4).alias("tokens"))


def _level(n: int) -> str:
    """CTEs of level n of the tree: sizes of its groups, and places one level deeper."""
    deeper = "list_append(place, CASE WHEN one THEN stem[1:20] ELSE sub END)"
    return f"""s{n} AS MATERIALIZED (SELECT place, count(*) AS n, count(DISTINCT sub) = 1 AS one FROM l{n} WHERE len(place) = {n} GROUP BY place),
    l{n + 1} AS MATERIALIZED (SELECT l{n}.* EXCLUDE (place), CASE WHEN n > {TREE_MOST} THEN {deeper} ELSE place END AS place FROM l{n} LEFT JOIN s{n} USING (place))"""


TREE = f"""n AS (SELECT doc_id AS id, concat_ws('/', lang, source, 'c' || (doc_id % 2), 'D' || (doc_id % 9) || '.txt') AS path, n_chars // 4 AS tokens FROM documents WHERE doc_id % 11 <> 0),
    l1 AS (SELECT *, replace(path, '/', '_') AS sub, 'D' || (id % 9) AS stem, [split_part(path, '/', 1)] AS place FROM n), {_level(1)}, {_level(2)},
    s3 AS (SELECT place, count(*) AS n FROM l3 WHERE len(place) = 3 GROUP BY place)"""


@query(
    f"""WITH {TREE} SELECT array_to_string(place, '>') AS place, place[-1] AS name, array_to_string(place[1:-2], '>') AS parent, len(place)::INTEGER AS depth, n, leaf
    FROM (SELECT place, n, n <= {TREE_MOST} AS leaf FROM s1 UNION ALL SELECT place, n, n <= {TREE_MOST} FROM s2 UNION ALL SELECT place, n, true FROM s3)"""
)
def module_levels(spark, sf_dir):
    """The module tree of all documents, a row a module."""
    tree, _ = M.tree(document_nodes(spark, sf_dir), 3, TREE_MOST)
    return tree.select(F.array_join("place", ">").alias("place"), "name", F.coalesce(F.array_join("parent", ">"), F.lit("")).alias("parent"), "depth", "n", "leaf")


CONTEXT = f"""{TREE}, c AS MATERIALIZED (SELECT array_to_string(place, '_') AS leaf, place, id, path, tokens, row_number() OVER (PARTITION BY place ORDER BY id) AS rn FROM l3 QUALIFY rn <= {TREE_MOST}),
    g AS (SELECT leaf, id, path, tokens, rn, tokens <= {int(BUDGET * 0.9)} AS taken, CASE WHEN tokens <= {int(BUDGET * 0.9)} THEN tokens ELSE 0 END AS used FROM c WHERE rn = 1
      UNION ALL SELECT c.leaf, c.id, c.path, c.tokens, c.rn, used + c.tokens <= {int(BUDGET * 0.9)}, used + CASE WHEN used + c.tokens <= {int(BUDGET * 0.9)} THEN c.tokens ELSE 0 END FROM g JOIN c ON c.leaf = g.leaf AND c.rn = g.rn + 1),
    e AS (SELECT DISTINCT leaf, src, src + 1 AS dst FROM (SELECT leaf, id AS src FROM c UNION ALL SELECT leaf, id - 1 FROM c) JOIN documents ON doc_id = src WHERE src + 1 IN (SELECT doc_id FROM documents)),
    ec AS (SELECT leaf, least(count(*), 50) AS edges, min(src) AS first_edge FROM e GROUP BY leaf)"""


def contexts(spark, sf_dir):
    nodes = document_nodes(spark, sf_dir)
    _, at = M.tree(nodes, 3, TREE_MOST)
    d = read(spark, sf_dir, "documents").select("doc_id")
    edges = d.join(d.select((F.col("doc_id") - 1).alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("src"), (F.col("doc_id") + 1).alias("dst"), F.lit("next").alias("kind"))
    return M.contexts(M.components(at, TREE_MOST), nodes.select("id", "tokens"), edges, BUDGET)


@query(f"WITH RECURSIVE {CONTEXT} SELECT leaf, count(*) AS components, count(*) FILTER (taken) AS taken, coalesce(sum(tokens) FILTER (taken), 0)::BIGINT AS tokens, coalesce(any_value(edges), 0)::BIGINT AS edges, any_value(first_edge) AS first_edge FROM g LEFT JOIN ec USING (leaf) GROUP BY leaf")
def module_contexts(spark, sf_dir):
    """What every leaf shows: components, snippets within its budget, and edges at it."""
    rows, edges = contexts(spark, sf_dir)
    near = edges.groupBy("leaf").agg(F.count("*").alias("edges"), F.min("src").alias("first_edge"))
    total = F.coalesce(F.sum(F.when(F.col("taken"), F.col("tokens"))), F.lit(0)).cast("bigint")
    per = rows.groupBy("leaf").agg(F.count("*").alias("components"), F.count_if("taken").alias("taken"), total.alias("tokens"))
    return per.join(near, "leaf", "left").select("leaf", "components", "taken", "tokens", F.coalesce("edges", F.lit(0).cast("bigint")).alias("edges"), "first_edge")


@query(
    f"""WITH RECURSIVE {CONTEXT}, t AS (SELECT leaf, sum(CASE WHEN taken THEN tokens ELSE 0 END) > {BUDGET * 0.8} AS large FROM g GROUP BY leaf)
    SELECT leaf, id, NULL AS parent, taken, NULL AS reason FROM g JOIN t USING (leaf) WHERE NOT large
    UNION ALL SELECT leaf || '__' || split_part(split_part(path, '/', -1), '.', 1), id, leaf, true, 'file_level_split' FROM g JOIN t USING (leaf) WHERE large AND taken"""
)
def module_refined(spark, sf_dir):
    """Leaves that fill too much of their budget, divided by file."""
    return M.refine(contexts(spark, sf_dir)[0], BUDGET).select("leaf", "id", "parent", "taken", "reason")
