"""Queries of smaller steps: statuses, redundant edits, import maps, snippets, look-ups over repositories, searches after failures, call indexes, suggestions; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import atoms as A
from ..operators import code as C
from ..operators import edits as E
from ..operators import evidence as V
from ..operators import runs as R
from ..operators import surface as U
from ..sources import artifacts as AR
from .code_queries import java_files, java_graph
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
    """WITH a AS (SELECT c_custkey AS k, (c_custkey % 100) / 100.0::DOUBLE AS c, CASE c_custkey % 4 WHEN 0 THEN -0.3 WHEN 1 THEN 0.05 WHEN 2 THEN -0.15 ELSE 0 END::DOUBLE AS m FROM customer), b AS (SELECT k, c, greatest(0.0, least(0.95, c + m)) AS n FROM a)
    SELECT k, CASE WHEN n = c AND k % 3 = 0 AND n >= 0.8 THEN c ELSE round_even(n, 2) END AS confidence, CASE WHEN n >= 0.8 THEN 'accepted' WHEN n >= 0.6 THEN 'candidate' WHEN n >= 0.4 THEN 'needs_review' ELSE 'rejected' END AS status FROM b"""
)
def atoms_refreshed(spark, sf_dir):
    """Confidences and statuses after merges, moved by the roles of references."""
    k = F.col("c_custkey")
    ref = lambda *ids: F.array(*[F.struct(F.lit("code").alias("type"), F.lit(i).alias("id"), F.lit("").alias("authority")) for i in ids])
    refs = F.when(k % 4 == 0, ref("a/XHandler.java#f")).when(k % 4 == 1, ref("a/XService.java#f")).when(k % 4 == 2, ref("a/XHandler.java", "b/YHandler.java", "c/ZService.java")).otherwise(ref("a/plain.java"))
    atoms = read(spark, sf_dir, "customer").select(k.alias("k"), ((k % 100) / F.lit(100.0)).alias("confidence"), F.when(k % 3 == 0, "accepted").otherwise("rejected").alias("status"), refs.cast(A.REFS).alias("source_refs"))
    return A.refresh_statuses(atoms).select("k", "confidence", "status")


@query("SELECT event_id, (event_type, event_id % 40) IN (SELECT (event_type, event_id % 40) FROM events WHERE value < 2) AS redundant FROM events")
def edits_redundant(spark, sf_dir):
    """Edits that say what rejected ones said, in other cases and spaces."""
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    content = F.concat(F.lit("Rule  of "), s(i % 40), F.when(i % 2 == 0, " now").otherwise("  NOW "))
    edits = e.select("event_id", "value", F.col("event_type").alias("op"), content.alias("content"))
    return E.flag_redundant(edits, edits.where("value < 2")).select("event_id", "redundant")


@query("SELECT 'src/m' || (p_partkey % 10) || '/Part' || p_partkey || '.java' AS path, 'Part' || (p_partkey + 1) AS name, 'com.m' || ((p_partkey + 1) % 10) || '.Part' || (p_partkey + 1) AS qualified FROM part")
def code_java_imports(spark, sf_dir):
    """What short names of Java files stand for."""
    return C.java_import_map(java_files(spark, sf_dir))


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '  public int run' || p_partkey || '(int x) {' || chr(10) || '    if (x > 1) { return ' || p_size || '; }' || chr(10) || '  }' WHEN 1 THEN '  protected abstract Map<String, Part> run' || p_partkey || '(int x);'
      WHEN 2 THEN '  int run' || p_partkey || '(int x)' || chr(10) || '  {' || chr(10) || '    x = run' || p_partkey || '(x - 1);' || chr(10) || '  }' ELSE '' END AS snippet FROM part"""
)
def code_snippets(spark, sf_dir):
    """Declarations of methods with their bodies, among calls, comments and lesser declarations."""
    k, n = F.col("p_partkey"), s(F.col("p_size"))
    name = F.concat(F.lit("run"), s(k))
    other = F.concat(F.lit("class A {\n  // public int "), name, F.lit("(int c) {\n  int y = "), name, F.lit("(2);\n"))
    public = F.concat(F.lit("  private long "), name, F.lit("(long y) { return y; }\n  public int "), name, F.lit("(int x) {\n    if (x > 1) { return "), n, F.lit("; }\n  }\n}"))
    abstract = F.concat(F.lit("  private int "), name, F.lit("(String t) {\n  }\n  protected abstract Map<String, Part> "), name, F.lit("(int x);\n}"))
    private = F.concat(F.lit("  private long "), name, F.lit("(long x) { }\n  int "), name, F.lit("(int x)\n  {\n    x = "), name, F.lit("(x - 1);\n  }\n}"))
    text = F.when(k % 4 == 0, F.concat(other, public)).when(k % 4 == 1, F.concat(F.lit("class A {\n"), abstract)).when(k % 4 == 2, F.concat(F.lit("class A {\n"), private)).otherwise(other)
    return read(spark, sf_dir, "part").select(k.alias("k"), C.symbol_snippet(text, name).alias("snippet"))


@query(
    """WITH n AS (SELECT p_partkey AS k, 'r' || (p_partkey % 3) AS repo, 'src/m' || (p_partkey % 10) || '/Part' || p_partkey || '.java' AS path FROM part), x AS (SELECT path || '::' || 'Part' || k AS id, 'Part' || k AS name, repo FROM n UNION ALL SELECT path || '::run' || k, 'run' || k, repo FROM n UNION ALL SELECT path || '::GetMapping', 'GetMapping', repo FROM n WHERE k % 3 = 0)
    SELECT 'exact' AS how, k AS query_id, x.repo, id FROM n JOIN x ON name = 'Part' || k UNION ALL SELECT 'part', k, x.repo, id FROM n JOIN x ON contains(lower(name), 'rt' || k) WHERE k % 50 = 0"""
)
def code_repositories(spark, sf_dir):
    """Symbols of a name, or that hold it, over three repositories."""
    _, nodes, _ = java_graph(spark, sf_dir)
    k = F.col("p_partkey")
    number = F.regexp_extract("file_path", r"Part(\d+)\.java$", 1).cast("bigint")
    tagged = nodes.withColumn("repo", F.concat(F.lit("r"), s(number % 3)))
    p = read(spark, sf_dir, "part")
    exact = U.find_in_repositories(tagged, p.select(k.alias("query_id"), F.concat(F.lit("Part"), s(k)).alias("symbol")))
    part = U.find_in_repositories(tagged, p.where(k % 50 == 0).select(k.alias("query_id"), F.concat(F.lit("RT"), s(k)).alias("symbol")), exact=False)
    return exact.select(F.lit("exact").alias("how"), "query_id", "repo", "id").unionByName(part.select(F.lit("part").alias("how"), "query_id", "repo", "id"))


@query(
    r"""WITH q AS (SELECT conv_id, turn, trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS t, role FROM conversations), l AS (SELECT conv_id, turn, list_concat(list_concat([role], [trim(left(t, 120), ' ' || chr(10) || chr(9) || chr(13))]), list_filter(regexp_extract_all(t, '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[A-Z][a-zA-Z0-9]{3,}'))) AS qs FROM q),
    u AS (SELECT conv_id, turn, list_filter(qs, lambda x, i: x <> '' AND list_position(qs, x) = i)[1:6] AS qs FROM l) SELECT conv_id, turn, sha256(array_to_string(qs, '|')) AS digest, len(qs)::INTEGER AS n FROM u"""
)
def failure_searches(spark, sf_dir):
    """What to search a graph for after each turn of all conversations, as a failed question."""
    missed = F.array(F.col("role"), F.lit("12"), F.col("role"))
    found = read(spark, sf_dir, "conversations").select("conv_id", "turn", V.graph_queries(F.col("text"), missed).alias("q"))
    return found.select("conv_id", "turn", F.sha2(F.array_join("q", "|"), 256).alias("digest"), F.size("q").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'own' WHEN event_id % 3 = 1 AND event_type IN ('click', 'view') THEN 'fw ' || event_type ELSE '' END AS framework, CASE WHEN event_id % 3 = 0 THEN 'role' || (event_id % 5) WHEN event_id % 3 = 1 AND event_type = 'click' THEN 'service' ELSE '' END AS role FROM events")
def failure_roles(spark, sf_dir):
    """Roles that items have themselves or by their task."""
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    items = e.select("event_id", F.when(i % 3 != 2, F.col("event_type")).alias("task_type"), F.when(i % 3 == 0, F.concat(F.lit(" role"), s(i % 5))).otherwise(" ").alias("graph_role"), F.lit("own").alias("graph_framework"))
    hints = e.where("event_type in ('click', 'view')").select(F.col("event_type").alias("task_type"), F.concat(F.lit("fw "), F.col("event_type")).alias("framework"), F.when(F.col("event_type") == "click", F.array(F.lit("service"), F.lit("dto"))).otherwise(F.array().cast("array<string>")).alias("roles")).distinct()
    return V.resolve_roles(items, hints).select("event_id", "framework", "role")


@query("SELECT 'q' || user_id AS request_id, count(*) AS calls, string_agg(event_id || ':' || event_type || ':' || CASE WHEN event_id % 4 = 0 THEN 2 ELSE 0 END, ',' ORDER BY event_id) AS line FROM events WHERE event_id % 7 <> 3 AND event_id % 11 <> 5 GROUP BY user_id")
def run_trace_index(spark, sf_dir):
    """Recorded calls by request, among lines that are cut off or have no id."""
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    id_ = F.when(i % 11 != 5, F.concat(F.lit("q"), s(F.col("user_id"))))
    request = F.struct(F.when(i % 2 == 0, id_).alias("request_id"), F.col("event_type").alias("role"))
    response = F.struct(id_.alias("request_id"), F.when(i % 4 == 0, F.array(F.lit("a"), F.lit("b"))).alias("tool_calls"))
    value = F.to_json(F.struct(i.alias("call_index"), request.alias("request"), response.alias("response")))
    records = e.select(i.alias("seq"), F.when(i % 7 == 3, F.expr("substring(to_json(struct(event_id, props)), 1, 9)")).otherwise(value).alias("value"))
    line = F.array_join(F.transform("calls", lambda c: F.concat_ws(":", c["call_index"].cast("string"), c["role"], c["tool_calls"].cast("string"))), ",")
    return AR.trace_index(records).select("request_id", F.size("calls").cast("bigint").alias("calls"), line.alias("line"))


@query(
    """WITH a AS (SELECT p_brand AS project, p_partkey AS k, p_name || ' of ' || p_partkey AS claim FROM part WHERE p_size % 3 <> 0 AND p_partkey % 4 <> 0 AND NOT contains(lower(p_name), 'red')), n AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY k) AS n FROM a),
    g AS (SELECT project, string_agg('- ' || claim, chr(10) ORDER BY n) AS ls FROM n WHERE n <= 30 GROUP BY project), s AS (SELECT DISTINCT p_brand AS project FROM part)
    SELECT project, sha256('# ' || project || CASE WHEN ls IS NULL THEN chr(10) || chr(10) || '### Auto-suggested rules' || chr(10) || 'old' || chr(10) ELSE chr(10) || chr(10) || '### Auto-suggested rules' || chr(10) || chr(10) || '_From M3 atoms (review before gate)._' || chr(10) || chr(10) || ls || chr(10) END) AS digest FROM s LEFT JOIN g USING (project)"""
)
def rules_suggested(spark, sf_dir):
    """Rule documents of all brands with their surest claims in place of an earlier appendix."""
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    atoms = p.select(F.col("p_brand").alias("project"), k.alias("seq"), F.concat(F.lit(" "), F.col("p_name"), F.lit(" of "), s(k), F.lit("\n")).alias("claim"), F.when(F.col("p_size") % 3 == 0, 0.79).otherwise(0.8).alias("confidence"), F.when(k % 4 == 0, "candidate").otherwise("accepted").alias("status"))
    skills = p.select(F.col("p_brand").alias("project")).distinct().withColumn("skill", F.concat(F.lit("# "), F.col("project"), F.lit("\n\n### Auto-suggested rules\nold\n")))
    found = R.append_suggestions(skills, atoms, exclude=("RED",))
    return found.select("project", F.sha2("skill", 256).alias("digest"))
