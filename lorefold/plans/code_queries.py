"""Queries over a repository of generated sources, one Java file a part; their SQL says from the keys what the sources hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import atoms as A
from ..operators import code as C
from ..operators import graph as G
from ..operators import search as Q
from ..operators import surface as U
from ..sources import files as SRC

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def java_files(spark, sf_dir) -> DataFrame:
    """(path, language, text): a class a part, that extends the one before and whose method calls the next one's."""
    k = F.col("p_partkey")
    s = lambda d=0: (k + d).cast("string")
    m = lambda d=0: ((k + d) % 10).cast("string")
    lines = [
        F.concat(F.lit("package com.m"), m(), F.lit(";")), F.concat(F.lit("import com.m"), m(1), F.lit(".Part"), s(1), F.lit(";")), F.lit(""),
        F.when(k % 3 == 0, F.concat(F.lit('@GetMapping("/part/'), s(), F.lit('")'))).otherwise(F.lit("// plain")),
        F.concat(F.lit("public class Part"), s(), F.when(k > 0, F.concat(F.lit(" extends Part"), s(-1))).otherwise(F.lit("")), F.lit(" {")),
        F.concat(F.lit("    public int run"), s(), F.lit("(int x) {")), F.concat(F.lit("        return run"), s(1), F.lit("(x);")), F.lit("    }"), F.lit("}"),
    ]
    path = F.concat(F.lit("src/m"), m(), F.lit("/Part"), s(), F.lit(".java"))
    return G.dealt(read(spark, sf_dir, "part"), "p_partkey").select(path.alias("path"), F.lit("java").alias("language"), F.concat_ws("\n", *lines).alias("text"))


def java_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files, nodes and edges, the latter two written once."""
    files = java_files(spark, sf_dir)
    nodes, edges = C.build(files)
    return files, nodes, G.shuffled(G.cut(edges))


P = "p AS (SELECT p_partkey AS k, 'src/m' || (p_partkey % 10) || '/Part' || p_partkey || '.java' AS path, 'com.m' || (p_partkey % 10) AS pkg FROM part)"
NODES = f"""{P}, n AS (SELECT path || '::GetMapping' AS id, 'route' AS kind, 'GetMapping' AS name, path AS file_path, 4 AS start_line, 4 AS end_line, '@GetMapping("/part/' || k || '")' AS signature, pkg || '.GetMapping' AS qualified_name, k FROM p WHERE k % 3 = 0
  UNION ALL SELECT path || '::Part' || k, 'class', 'Part' || k, path, 5, 5, 'public class Part' || k || CASE WHEN k > 0 THEN ' extends Part' || (k - 1) ELSE '' END || ' {{', pkg || '.Part' || k, k FROM p
  UNION ALL SELECT path || '::run' || k, 'method', 'run' || k, path, 6, 9, 'public int run' || k || '(int x) {{', pkg || '.Part' || k || '.run' || k, k FROM p)"""
CALLS = f"{P}, c AS (SELECT a.path || '::run' || a.k AS src, b.path || '::run' || b.k AS dst, a.k FROM p a JOIN p b ON b.k = a.k + 1)"


@query(
    """WITH f AS (SELECT p_partkey AS k, ['src', 'test', 'gen', 'node_modules', 'docs'][(p_partkey % 5 + 1)::INT] || '/' || ['a', 'b'][(p_size % 2 + 1)::INT] || '/F' || p_partkey || '.' || ['java', 'py', 'md', 'png', 'pb.go', 'yaml', 'txt'][(p_partkey % 7 + 1)::INT] AS path, CASE WHEN p_partkey % 11 = 0 THEN '// DO NOT EDIT' ELSE 'x' END AS text FROM part)
    SELECT path, CASE k % 7 WHEN 0 THEN 'java' WHEN 1 THEN 'python' WHEN 2 THEN 'markdown' WHEN 4 THEN 'go' WHEN 5 THEN 'yaml' ELSE '' END AS language,
      CASE WHEN k % 7 = 3 THEN 'binary' WHEN k % 11 = 0 OR k % 7 = 4 OR contains(path, '/gen/') THEN 'generated' WHEN k % 5 = 1 THEN 'test' WHEN k % 7 = 5 THEN 'config' WHEN k % 7 IN (2, 6) THEN 'doc' ELSE 'source' END AS kind,
      CASE k % 7 WHEN 2 THEN 'markdown' WHEN 6 THEN 'text' ELSE '' END AS source_type, regexp_full_match(path, 'src/.*\\.java|.*/b/.*') AS wanted, k % 7 = 4 OR contains(path, '/gen/') AS generated_path FROM f"""
)
def code_file_kinds(spark, sf_dir):
    """Language, kind and type of paths, globs and generated files."""
    k, pick = F.col("p_partkey"), lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i + 1).cast("int"))
    path = F.concat_ws("/", pick(("src", "test", "gen", "node_modules", "docs"), k % 5), pick(("a", "b"), F.col("p_size") % 2), F.concat(F.lit("F"), k.cast("string"), F.lit("."), pick(("java", "py", "md", "png", "pb.go", "yaml", "txt"), k % 7)))
    f = read(spark, sf_dir, "part").select(path.alias("path"), F.when(k % 11 == 0, "// DO NOT EDIT").otherwise("x").alias("text"))
    p = F.col("path")
    return f.select("path", SRC.lookup(SRC.LANGUAGES, SRC.ending(p)).alias("language"), SRC.file_kind(p, F.col("text")).alias("kind"), SRC.lookup(SRC.DOCUMENT_TYPES, SRC.ending(p)).alias("source_type"), T.matches_any(p, ("src/*.java", "*/b/*")).alias("wanted"), SRC.has_generated_path(p).alias("generated_path"))


@query(f"WITH {NODES} SELECT id, kind, name, start_line, end_line, signature, qualified_name FROM n")
def code_symbols(spark, sf_dir):
    """Symbols with lines, signatures and qualified names."""
    return C.symbols(java_files(spark, sf_dir)).select("id", "kind", "name", "start_line", "end_line", "signature", "qualified_name")


@query(f"WITH {NODES} SELECT CASE kind WHEN 'method' THEN file_path || '::Part' || k ELSE file_path END AS src, id AS dst, 'contains' AS kind FROM n")
def code_contains(spark, sf_dir):
    return C.contains_edges(C.symbols(java_files(spark, sf_dir)))


@query(f"WITH {P} SELECT path, 'Part' || (k + 1) AS name FROM p")
def code_imports(spark, sf_dir):
    return C.imports(java_files(spark, sf_dir))


@query(f"WITH {CALLS} SELECT src, dst, 'calls' AS kind, 0.6::DOUBLE AS confidence FROM c")
def code_calls(spark, sf_dir):
    files = java_files(spark, sf_dir)
    return C.call_edges(C.bodies(files, C.symbols(files)))


@query(f"WITH {P} SELECT a.path || '::Part' || a.k AS src, b.path || '::Part' || b.k AS dst, 'extends' AS kind, 0.8::DOUBLE AS confidence FROM p a JOIN p b ON b.k = a.k - 1")
def code_inheritance(spark, sf_dir):
    return C.inheritance_edges(C.symbols(java_files(spark, sf_dir)))


@query(f"WITH {NODES} SELECT 'rest' AS kind, id AS handler, '/part/' || k AS path, 'http' AS protocol FROM n WHERE k % 3 = 0")
def code_entry_points(spark, sf_dir):
    files = java_files(spark, sf_dir)
    return C.entry_points(files, C.symbols(files))


@query(
    f"""WITH {NODES}, r AS (SELECT 'q' || k AS src, CASE k % 4 WHEN 0 THEN pkg || '.Part' || k WHEN 1 THEN 'run' || k WHEN 2 THEN 'other.Part' || k ELSE 'nowhere' || k END AS name, k % 4 AS t, k, path FROM p)
    SELECT src, CASE t WHEN 1 THEN path || '::run' || k WHEN 3 THEN NULL ELSE path || '::Part' || k END AS dst, CASE t WHEN 0 THEN 0.8 WHEN 1 THEN 0.65 WHEN 2 THEN 0.55 END::DOUBLE AS confidence FROM r"""
)
def code_resolve(spark, sf_dir):
    """References by qualified name, short name, then ending; what stays unresolved has no target."""
    k = F.col("p_partkey")
    pkg, s = F.concat(F.lit("com.m"), (k % 10).cast("string"), F.lit(".Part"), k.cast("string")), k.cast("string")
    name = F.when(k % 4 == 0, pkg).when(k % 4 == 1, F.concat(F.lit("run"), s)).when(k % 4 == 2, F.concat(F.lit("other.Part"), s)).otherwise(F.concat(F.lit("nowhere"), s))
    refs = read(spark, sf_dir, "part").select(F.concat(F.lit("q"), s).alias("src"), name.alias("name"))
    edges, unresolved = G.resolve(refs, G.cut(C.symbols(java_files(spark, sf_dir))))  # read six times
    return edges.select("src", "dst", "confidence").unionByName(unresolved.select("src", F.lit(None).cast("string").alias("dst"), F.lit(None).cast("double").alias("confidence")))


@query(
    """WITH p AS (SELECT p_partkey AS k, p_size % 5 AS m FROM part) SELECT 'caller' || k AS src, 'impl' || k || '.m' || m AS dst, 0.42::DOUBLE AS confidence FROM p"""
)
def code_interface_dispatch(spark, sf_dir):
    """Calls of an interface's method reach the method of that name in what implements it."""
    k, m = F.col("p_partkey").cast("string"), (F.col("p_size") % 5).cast("string")
    p = read(spark, sf_dir, "part")
    at = lambda kind, dot=True: F.concat(F.lit(kind), k, F.lit(".m"), m) if dot else F.concat(F.lit(kind), k)
    edge = lambda a, b, kind: p.select(a.alias("src"), b.alias("dst"), F.lit(kind).alias("kind"))
    edges = edge(at("caller", False), at("face"), "calls").unionByName(edge(at("face", False), at("face"), "contains")).unionByName(edge(at("impl", False), at("impl"), "contains")).unionByName(edge(at("impl", False), at("face", False), "implements"))
    nodes = p.select(F.explode(F.array(at("face"), at("impl"))).alias("id"), F.concat(F.lit("m"), m).alias("name"))
    return G.interface_dispatch(edges, nodes).select("src", "dst", "confidence")


@query(f"WITH {NODES} SELECT 'exact' AS how, id FROM n WHERE name = 'Part7' UNION ALL SELECT 'part', id FROM n WHERE contains(lower(name), 'part7') UNION ALL SELECT 'kind', id FROM n WHERE kind = 'route' UNION ALL SELECT 'file', id FROM n WHERE file_path = 'src/m7/Part17.java' UNION ALL SELECT 'any ' || CASE WHEN contains(lower(name), 'run1') THEN 'name' ELSE 'path' END, id FROM n WHERE contains(lower(name), 'run1') OR contains(lower(file_path), 'run1')")
def code_find(spark, sf_dir):
    """Look-ups by name, kind, file and all of them."""
    nodes = C.symbols(java_files(spark, sf_dir))
    one = lambda how, df: df.select(F.lit(how).alias("how"), "id")
    found = one("exact", U.find_symbol(nodes, "Part7")).unionByName(one("part", U.find_symbol(nodes, "part7", exact=False))).unionByName(one("kind", U.find_by(nodes, kind="route"))).unionByName(one("file", U.find_by(nodes, file="src/m7/Part17.java")))
    return found.unionByName(U.combined(nodes, "run1").select(F.concat_ws(" ", F.lit("any"), "met").alias("how"), "id"))


def wanted_symbols(spark, sf_dir, every: int) -> DataFrame:
    """(query_id, symbol, near): a class or a route near the file of every so many parts."""
    k = F.col("p_partkey")
    s = k.cast("string")
    symbol = F.when(k % 2 == 0, F.concat(F.lit("part"), s)).otherwise(F.lit("GetMapping"))
    return read(spark, sf_dir, "part").where(k % every == 0).select(k.alias("query_id"), symbol.alias("symbol"), F.concat(F.lit("/Part"), s, F.lit(".")).alias("near"))


@query(
    f"""WITH {NODES}, q AS (SELECT k AS query_id, CASE WHEN k % 2 = 0 THEN 'part' || k ELSE 'GetMapping' END AS symbol, '/Part' || k || '.' AS near FROM p WHERE k % 3 = 0),
    s AS (SELECT query_id, id, (name = symbol)::INT * 10 + CASE WHEN contains(file_path, near) THEN 25 WHEN contains(lower(file_path), lower(symbol)) THEN 12 ELSE 0 END + (kind = 'class')::INT * 5 AS rank_score FROM q JOIN n ON lower(name) = lower(symbol))
    SELECT query_id, id, rank_score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank_score DESC, id) = 1"""
)
def code_best_symbol(spark, sf_dir):
    """The best node of each wanted name."""
    return U.best_symbols(G.cut(C.symbols(java_files(spark, sf_dir))), wanted_symbols(spark, sf_dir, 3)).select("query_id", "id", "rank_score")


@query(
    f"""WITH {NODES}, w AS (SELECT a.k AS query_id, a.id AS start, CASE WHEN b.k > a.k THEN 'callees' ELSE 'callers' END AS direction, b.id AS node, abs(b.k - a.k)::INTEGER AS depth, b.name, a.k % 4 AS d FROM n a JOIN n b ON a.kind = 'method' AND b.kind = 'method' AND abs(b.k - a.k) BETWEEN 1 AND 3)
    SELECT query_id, start, direction, node, depth, name FROM w WHERE query_id % 2 = 0 AND (d = 0 OR direction = 'callers')"""
)
def code_trace(spark, sf_dir):
    """Callers, or callers and callees, of many symbols to three steps."""
    _, nodes, edges = java_graph(spark, sf_dir)
    k = F.col("p_partkey")
    wanted = read(spark, sf_dir, "part").where(k % 2 == 0).select(k.alias("query_id"), F.concat(F.lit("run"), k.cast("string")).alias("symbol"), F.lit("").alias("near"), F.when(k % 4 == 0, "both").otherwise("callers").alias("direction"))
    return U.trace(nodes, edges, wanted, 3).select("query_id", "start", "direction", "node", "depth", "name")


@query(
    f"""WITH {P}, a AS (SELECT k, path || '::run' || k AS id FROM p) SELECT x.k AS query_id, list_aggregate([a0.id, a1.id, a2.id], 'string_agg', ' → ') AS summary, 2 AS length FROM a x JOIN a a0 ON a0.k = x.k JOIN a a1 ON a1.k = x.k + 1 JOIN a a2 ON a2.k = x.k + 2 WHERE x.k % 40 = 0"""
)
def code_trace_to(spark, sf_dir):
    """Paths from one symbol to another."""
    _, nodes, edges = java_graph(spark, sf_dir)
    k = F.col("p_partkey")
    run = lambda d: F.concat(F.lit("run"), (k + d).cast("string"))
    pairs = read(spark, sf_dir, "part").where(k % 40 == 0).select(k.alias("query_id"), run(0).alias("from_symbol"), run(2).alias("to_symbol"))
    return U.trace_to(nodes, edges, pairs).select("query_id", "summary", "length")


@query(
    f"""WITH {NODES} SELECT a.k AS query_id, CASE WHEN b.k > a.k THEN 'callees' ELSE 'callers' END AS direction, b.id AS node, abs(b.k - a.k) = 1 AS direct FROM n a JOIN n b ON a.kind = 'method' AND b.kind = 'method' AND abs(b.k - a.k) BETWEEN 1 AND 2 WHERE a.k % 5 = 0"""
)
def code_impact(spark, sf_dir):
    """Direct and wider callers and callees of the first node of each name."""
    _, nodes, edges = java_graph(spark, sf_dir)
    k = F.col("p_partkey")
    wanted = read(spark, sf_dir, "part").where(k % 5 == 0).select(k.alias("query_id"), F.concat(F.lit("run"), k.cast("string")).alias("symbol"))
    return U.impact_of(nodes, edges, wanted, 2).select("query_id", "direction", "node", "direct")


@query(
    f"""WITH {NODES}, m AS (SELECT max(k) AS top FROM p) SELECT k AS query_id, id, array_to_string(list_filter([CASE WHEN k >= 1 THEN 'run' || (k - 1) END, CASE WHEN k >= 2 THEN 'run' || (k - 2) END], lambda x: x IS NOT NULL), ',') AS callers,
    array_to_string(list_filter([CASE WHEN k + 1 <= top THEN 'run' || (k + 1) END, CASE WHEN k + 2 <= top THEN 'run' || (k + 2) END], lambda x: x IS NOT NULL), ',') AS callees,
    '    public int run' || k || '(int x) {{' || chr(10) || '        return run' || (k + 1) || '(x);' || chr(10) || '    }}' AS source FROM n, m WHERE kind = 'method' AND k % 7 = 0"""
)
def code_explore(spark, sf_dir):
    """Cards of symbols: callers and callees to two steps, source of three lines at most."""
    files, nodes, edges = java_graph(spark, sf_dir)
    k = F.col("p_partkey")
    wanted = read(spark, sf_dir, "part").where(k % 7 == 0).select(k.alias("query_id"), F.concat(F.lit("run"), k.cast("string")).alias("symbol"), F.lit("").alias("near"))
    return U.explore(nodes, edges, files, wanted, most_lines=3).select("query_id", "id", F.array_join("callers", ",").alias("callers"), F.array_join("callees", ",").alias("callees"), "source")


@query(
    f"""WITH {NODES}, h AS (SELECT *, CASE WHEN name = 'run12' THEN 1.0 ELSE 0.6 END AS score FROM n WHERE kind = 'method' AND contains(lower(name), 'run12') ORDER BY score DESC, id LIMIT 8),
    b AS (SELECT * FROM h ORDER BY score DESC, id LIMIT 4), m AS (SELECT max(k) AS top FROM p)
    SELECT string_agg('### ' || name || ' (' || file_path || ')' || chr(10) || '```' || chr(10) || '    ' || signature || chr(10) || '        return run' || (k + 1) || '(x);' || chr(10) || '```' || CASE WHEN k > 0 THEN chr(10) || 'callers: run' || (k - 1) ELSE '' END || CASE WHEN k < top THEN chr(10) || 'callees: run' || (k + 1) ELSE '' END, chr(10) || chr(10) ORDER BY score DESC, id) AS markdown FROM b, m"""
)
def code_context(spark, sf_dir):
    """A search's best files as blocks of Markdown."""
    files, nodes, edges = java_graph(spark, sf_dir)
    return U.context_markdown(U.build_context(nodes, edges, files, "kind:method run12", most_blocks=4, most_lines=2))


@query(f"WITH {P}, f AS (SELECT 'r' || (k % 4) AS repo, path FROM p WHERE contains(path, '/m1/') OR contains(path, '/m2/')) SELECT repo, path AS file_path FROM f QUALIFY row_number() OVER (PARTITION BY repo ORDER BY path) <= 5")
def code_list_files(spark, sf_dir):
    """Indexed files of several repositories, each with its share."""
    nodes = C.symbols(java_files(spark, sf_dir))
    key = F.regexp_extract("file_path", r"Part([0-9]+)", 1).cast("long")
    return U.list_files(nodes.withColumn("repo", F.concat(F.lit("r"), (key % 4).cast("string"))), ("*/m1/*", "*/m2/*"), 20, "repo")


@query(f"WITH {NODES}, r AS (SELECT 'r' || (k % 3) AS repo, count(*) AS nodes, count(DISTINCT file_path) AS files FROM n GROUP BY 1), e AS (SELECT 'r' || (k % 3) AS repo, sum(CASE WHEN k % 3 = 0 THEN 3 ELSE 2 END + (k > 0)::INT + (k < top)::INT) AS edges FROM p, (SELECT max(k) AS top FROM p) GROUP BY 1), j AS (SELECT repo, nodes, edges::BIGINT AS edges, files FROM r JOIN e USING (repo)) SELECT * FROM j UNION ALL SELECT 'total', sum(nodes)::BIGINT, sum(edges)::BIGINT, sum(files)::BIGINT FROM j")
def code_repo_stats(spark, sf_dir):
    """Nodes, edges and files of several repositories and of all, by one rollup."""
    _, nodes, edges = java_graph(spark, sf_dir)
    repo = lambda c: F.concat(F.lit("r"), (F.regexp_extract(c, r"Part([0-9]+)\.java", 1).cast("long") % 3).cast("string"))
    return U.repo_stats(nodes.withColumn("repo", repo("file_path")), edges.withColumn("repo", repo("src")))


@query(f"WITH {NODES} SELECT 'entry:rest:' || id AS src, id AS dst, '/part/' || k AS name, file_path FROM n WHERE k % 3 = 0")
def code_attach_entries(spark, sf_dir):
    """Entry points as route nodes with edges to their handlers."""
    files, nodes, edges = java_graph(spark, sf_dir)
    new, to = U.attach_entry_points(nodes, edges, C.entry_points(files, nodes))
    return to.join(new.select(F.col("id").alias("src"), "name", "file_path"), "src").select("src", "dst", "name", "file_path")


@query(
    f"""WITH {P}, e AS (SELECT path || '::run' || k AS id, ['rest', 'rpc', 'cli', 'job'][(k % 4 + 1)::INT] AS kind, path AS file, 'run' || k AS symbol, k FROM p WHERE k % 6 = 0),
    q AS (SELECT k AS query_id, CASE WHEN k % 5 = 0 THEN path || '::run' || k END AS entry_id, CASE WHEN k % 5 = 1 THEN path WHEN k % 5 = 2 THEN 'elsewhere/Part' || k || '.java' END AS file_path, CASE WHEN k % 5 = 3 THEN 'run' || k END AS symbol, k FROM p)
    SELECT query_id, e.id AS entry FROM q JOIN e USING (k) WHERE q.k % 5 < 4"""
)
def code_resolve_entries(spark, sf_dir):
    """Entries by id, path, file name or symbol."""
    k = F.col("p_partkey")
    s = k.cast("string")
    path = F.concat(F.lit("src/m"), (k % 10).cast("string"), F.lit("/Part"), s, F.lit(".java"))
    run, p = F.concat(F.lit("run"), s), read(spark, sf_dir, "part")
    kinds = F.element_at(F.array(*map(F.lit, ("rest", "rpc", "cli", "job"))), (k % 4 + 1).cast("int"))
    entries = p.where(k % 6 == 0).select(F.concat_ws("::", path, run).alias("id"), kinds.alias("kind"), path.alias("file"), run.alias("symbol"))
    file = F.when(k % 5 == 1, path).when(k % 5 == 2, F.concat(F.lit("elsewhere/Part"), s, F.lit(".java")))
    asked = p.select(k.alias("query_id"), F.when(k % 5 == 0, F.concat_ws("::", path, run)).alias("entry_id"), file.alias("file_path"), F.when(k % 5 == 3, run).alias("symbol"))
    return U.resolve_entries(entries, asked)


def code_atoms(spark, sf_dir) -> DataFrame:
    """(atom_id, claim, confidence, status, source_refs): each part's class by node id, its method by name, and a document."""
    k = F.col("p_partkey")
    s = k.cast("string")
    path = F.concat(F.lit("src/m"), (k % 10).cast("string"), F.lit("/Part"), s, F.lit(".java"))
    ref = lambda kind, c, authority="": F.struct(F.lit(kind).alias("type"), c.alias("id"), F.lit(authority).alias("authority"))
    refs = F.array(ref("code", F.concat(path, F.lit("::Part"), s)), ref("code", F.concat(F.lit("x.java#run"), s)), ref("doc", F.concat(F.lit("doc"), s)))
    return read(spark, sf_dir, "part").select(F.concat(F.lit("a"), s).alias("atom_id"), F.col("p_name").alias("claim"), (F.col("p_size") / 50.0).alias("confidence"), refs.alias("source_refs"))


@query(
    f"""WITH {P}, m AS (SELECT max(k) AS top FROM p) SELECT 'a' || k AS atom_id, path || '::Part' || k AS ref, path || '::Part' || k AS node, '' AS edge_path FROM p
    UNION ALL SELECT 'a' || k, 'x.java#run' || k, path || '::run' || k, CASE WHEN k < top THEN 'src/m' || ((k + 1) % 10) || '/Part' || (k + 1) || '.java::run' || (k + 1) ELSE '' END FROM p, m"""
)
def code_enrich(spark, sf_dir):
    """References of records met by id, else by name, with their first callees."""
    _, nodes, edges = java_graph(spark, sf_dir)
    return U.enrich(code_atoms(spark, sf_dir), nodes, edges).select("atom_id", "ref", "node", F.array_join("edge_path", ",").alias("edge_path"))


@query(
    f"""WITH {P}, c AS (SELECT k, path || '::Part' || k AS r, round_even(least(0.2, 0.15 * p_size / 50.0), 4)::DOUBLE AS contribution FROM p JOIN part ON p_partkey = k)
    SELECT r AS ref, 'a' || k AS atom_id, contribution FROM c UNION ALL SELECT unnest(['x.java#run' || k, 'x.java', 'run' || k]), 'a' || k, contribution FROM c"""
)
def code_evidence_index(spark, sf_dir):
    """Records by whole references and each part of them."""
    return A.evidence_index(code_atoms(spark, sf_dir))


@query(
    f"""WITH {P}, r AS (SELECT k, path, CASE k % 4 WHEN 0 THEN path || '#run' || k WHEN 1 THEN path WHEN 2 THEN path || '::none' ELSE 'lost/' || k || '.java#x' END AS ref FROM p)
    SELECT count(*) AS refs, count(*) FILTER (k % 4 = 0) AS symbol_hits, count(*) FILTER (k % 4 IN (1, 2)) AS file_hits, count(*) FILTER (k % 4 = 3) AS misses, round_even(count(*) FILTER (k % 4 < 3) / count(*), 3)::DOUBLE AS resolve_rate, round_even(count(*) FILTER (k % 4 = 0) / count(*), 3)::DOUBLE AS exact_rate FROM r"""
)
def code_ref_rates(spark, sf_dir):
    """How context references resolve: symbols, files, misses and rates."""
    k = F.col("p_partkey")
    s = k.cast("string")
    path = F.concat(F.lit("src/m"), (k % 10).cast("string"), F.lit("/Part"), s, F.lit(".java"))
    ref = F.when(k % 4 == 0, F.concat(path, F.lit("#run"), s)).when(k % 4 == 1, path).when(k % 4 == 2, F.concat(path, F.lit("::none"))).otherwise(F.concat(F.lit("lost/"), s, F.lit(".java#x")))
    items = read(spark, sf_dir, "part").select(k.alias("id"), F.array(ref).alias("context_refs"))
    return U.ref_rates(Q.resolve_refs(items, C.symbols(java_files(spark, sf_dir))))


@query(
    f"""WITH {P} SELECT CASE k % 3 WHEN 0 THEN 'm' || (k % 10) || '/Part' || k || '.java#run' || k WHEN 1 THEN './Part' || k || '.java' ELSE 'gone/G' || k || '.java' END AS ref,
    CASE k % 3 WHEN 2 THEN 'gone/G' || k || '.java' ELSE path END AS path, k % 3 < 2 AS found FROM p"""
)
def code_normalise_refs(spark, sf_dir):
    """References brought to files that exist: by prefix, ending or bare name."""
    k = F.col("p_partkey")
    s = k.cast("string")
    ref = F.when(k % 3 == 0, F.concat(F.lit("m"), (k % 10).cast("string"), F.lit("/Part"), s, F.lit(".java#run"), s)).when(k % 3 == 1, F.concat(F.lit("./Part"), s, F.lit(".java"))).otherwise(F.concat(F.lit("gone/G"), s, F.lit(".java")))
    return U.normalise_refs(read(spark, sf_dir, "part").select(ref.alias("ref")), java_files(spark, sf_dir), ("src",))


@query(f"WITH {P} SELECT path, 7 AS line, '        return run' || (k + 1) || '(x);' AS text, '    public int run' || k || '(int x) {{' || chr(10) || '        return run' || (k + 1) || '(x);' AS lines FROM p WHERE contains('return run' || (k + 1) || '(x);', 'run15') ORDER BY path LIMIT 5")
def code_search_content(spark, sf_dir):
    """The first line of each file that holds a term, and a range of its lines."""
    files = java_files(spark, sf_dir)
    hits = Q.search_content(files.select("path", F.regexp_replace("text", r"public int run[0-9]+", "public int runX").alias("text")), "run15", 5)
    return hits.join(files.select("path", Q.read_lines(F.col("text"), 6, 7).alias("lines")), "path")


@query(
    f"""WITH {NODES}, f AS (SELECT DISTINCT file_path, k FROM n), kept AS (SELECT id, k FROM n WHERE k % 4 <> 0), new AS (SELECT file_path || '::New' || k AS id, k FROM f WHERE k % 8 = 0)
    SELECT 'node' AS what, id FROM kept UNION ALL SELECT 'node', id FROM new UNION ALL SELECT 'edge', c.src || '>' || c.dst FROM (SELECT a.path || '::run' || a.k AS src, b.path || '::run' || b.k AS dst, a.k AS x, b.k AS y FROM p a JOIN p b ON b.k = a.k + 1) c WHERE x % 4 <> 0 AND y % 4 <> 0 UNION ALL SELECT 'edge', id || '>' || id FROM new"""
)
def code_graph_save(spark, sf_dir):
    """A graph with some files' nodes replaced or removed: of every fourth file, half come back with one new node."""
    files = java_files(spark, sf_dir)
    nodes = C.symbols(files).select("id", "file_path")
    calls = C.call_edges(C.bodies(files, C.symbols(files))).select("src", "dst", "kind")
    key = F.regexp_extract("path", r"Part([0-9]+)", 1).cast("long")
    changed = files.where(key % 4 == 0).select(F.col("path").alias("file_path"))
    new = files.where(key % 8 == 0).select(F.concat(F.col("path"), F.lit("::New"), key.cast("string")).alias("id"), F.col("path").alias("file_path"))
    kept, edges = G.save(G.cut(nodes), calls, new, new.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit("calls").alias("kind")), changed)
    return kept.select(F.lit("node").alias("what"), "id").unionByName(edges.select(F.lit("edge").alias("what"), F.concat_ws(">", "src", "dst").alias("id")))


@query(f"WITH {NODES}, g AS (SELECT *, count(*) OVER (PARTITION BY split_part(file_path, '/', 1)) AS c1 FROM n) SELECT CASE WHEN c1 > 50 THEN 'src/m' || (k % 10) ELSE 'src' END AS module, count(*) AS nodes FROM g GROUP BY 1")
def code_modules(spark, sf_dir):
    """Modules by folder, large ones split by one folder more."""
    return G.module_tree(C.symbols(java_files(spark, sf_dir)), most=50, depth=2).groupBy("module").agg(F.count("*").alias("nodes"))


@query("SELECT 'com.M' || p_partkey AS namespace, unnest(['find' || p_size, 'put' || p_size]) AS id, unnest(['select', 'insert']) AS kind FROM part")
def code_mapper_statements(spark, sf_dir):
    s, n = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    text = F.concat(F.lit('<mapper namespace="com.M'), s, F.lit('">\n<select id="find'), n, F.lit('" x="1">q</select>\n<insert id="put'), n, F.lit('">q</insert></mapper>'))
    return C.mapper_statements(read(spark, sf_dir, "part").select(F.concat(F.lit("m/"), s, F.lit(".xml")).alias("path"), text.alias("text")))


@query("WITH p AS (SELECT p_partkey AS k FROM part) SELECT 'J' || a.k || '.java::Own' || a.k AS src, 'J' || b.k || '.java::Own' || b.k AS dst, 0.8::DOUBLE AS confidence FROM p a JOIN p b ON b.k = a.k + 2")
def code_injected(spark, sf_dir):
    """Classes to the types of their injected fields."""
    k = F.col("p_partkey")
    text = F.concat(F.lit("class Own"), k.cast("string"), F.lit(" {\n  @Autowired private x.Own"), (k + 2).cast("string"), F.lit(" it;\n}"))
    files = read(spark, sf_dir, "part").select(F.concat(F.lit("J"), k.cast("string"), F.lit(".java")).alias("path"), F.lit("java").alias("language"), text.alias("text"))
    return C.injected(files, C.symbols(files)).select("src", "dst", "confidence")


@query("WITH p AS (SELECT p_partkey AS k FROM part) SELECT 'c' || a.k || '.js::Card' || a.k AS src, 'c' || b.k || '.js::Card' || b.k AS dst, 'renders' AS kind, 0.42::DOUBLE AS confidence FROM p a JOIN p b ON b.k = a.k * 2 AND a.k > 0")
def code_rendered(spark, sf_dir):
    """Components to those they render."""
    k = F.col("p_partkey")
    text = F.concat(F.lit("function Card"), k.cast("string"), F.lit("(p) {\n  return <div><Card"), (k * 2).cast("string"), F.lit(" a={1} /></div>;\n}"))
    files = read(spark, sf_dir, "part").select(F.concat(F.lit("c"), k.cast("string"), F.lit(".js")).alias("path"), F.lit("javascript").alias("language"), text.alias("text"))
    return C.rendered(files, C.symbols(files))
