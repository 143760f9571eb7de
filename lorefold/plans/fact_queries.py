"""Queries of roles, searchable words, bookings, HTML blocks and artifacts; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import facts as X
from ..operators import documents as D
from ..operators.graph import shared_folder
from ..sources import artifacts as R
from .text_queries import choose, pick, read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


TEXTS = ("table", "the and for", "loan interest", "OrderService", "还款计划", "x1", "表格", "event handler", "", "ok")


@query(f"SELECT p_partkey AS k, {choose('p_partkey', 'n', 'n', 'y', 'y', 'y', 'n', 'n', 'y', 'n', 'n')} = 'y' AS searchable, 'loan,' || p_size || 'x' AS words FROM part")
def fact_searchable(spark, sf_dir):
    """Texts that code can be searched by, and words left without those of formats and prompts."""
    words = F.array(F.lit("Table"), F.lit("loan"), F.lit("a"), F.lit("CHECK"), F.concat(s(F.col("p_size")), F.lit("x")))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), X.is_searchable(pick(F.col("p_partkey"), *TEXTS)).alias("searchable"), F.array_join(X.content_words(words), ",").alias("words"))


PLACES = ("a/service/X.java", "a/b/LoanProcessorImpl", "a/x.py", "enums/Kind.java", "a/b/Any", "controller/Web.ts")


@query(f"SELECT p_partkey AS k, {choose('p_partkey', 'service', 'processor', 'unknown', 'enum', 'listener', 'handler_only')} AS role, {choose('p_partkey', 'spring', 'spring', 'mine', 'custom', 'spring', '')} AS framework, {choose('p_partkey', 'api_resource', 'service', 'component', 'own', 'config', '')} AS index_role FROM part")
def fact_roles(spark, sf_dir):
    """Roles by path and symbol, and for a role index by metadata, kind and name."""
    k = F.col("p_partkey")
    symbol = pick(k, "", "", "", "", "OrderListener", "")
    own = X.index_role(pick(k, "route", "class", "class", "class", "config", "class"), pick(k, "x", "PayService", "x", "x", "x", "x"), pick(k, "", "", "mine", "", "", ""), pick(k, "", "", "", "own", "", ""))
    return read(spark, sf_dir, "part").select(k.alias("k"), X.role_by_place(pick(k, *PLACES), symbol).alias("role"), own.alias("o")).select("k", "role", "o.framework", F.col("o.role").alias("index_role"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'LoanStatus.ACTIVE_' || p_size ELSE 'Limits.MAX_' || p_size END AS refs, 'debitAccountId (debit_account),creditAmount (credit_amount),debit (debit),money (amount)' AS names, 'create entry ' || p_size || '|plain a|plain b' AS quotes, 'judge_step_' || p_size AS slug FROM part")
def fact_bookings(spark, sf_dir):
    """Constants, booking names, telling lines and names of calls."""
    n = s(F.col("p_size"))
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("if (LoanStatus . ACTIVE_"), n, F.lit(") Limits.MAX_1"))).otherwise(F.concat(F.lit("x = Limits.MAX_"), n))
    names = X.booking_names(F.lit("money = debit + creditAmount; debitAccountId.of(debit, other)"))
    lines = F.array(F.lit("plain a"), F.lit("plain b"), F.concat(F.lit("create entry "), n), F.lit("plain c"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.array_join(X.enum_refs(text), ",").alias("refs"), F.array_join(names, ",").alias("names"), F.array_join(X.quotes(lines), "|").alias("quotes"), X.request_slug(F.lit("judge"), F.concat(F.lit("step "), n)).alias("slug"))


@query("SELECT p_partkey AS doc, pos::INTEGER AS pos, type, level::INTEGER AS level, CASE pos WHEN 0 THEN 'Part ' || p_partkey WHEN 1 THEN p_name || ' of ' || p_size WHEN 2 THEN 'one' WHEN 3 THEN '| a | ' || p_size || ' |' ELSE 'x = 1' END AS text FROM part, (VALUES (0, 'heading', 2), (1, 'paragraph', 0), (2, 'list_item', 0), (3, 'table_row', 0), (4, 'code', 0)) v(pos, type, level) WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 0, 'heading', 1, p_name FROM part WHERE p_partkey % 3 = 1 UNION ALL SELECT p_partkey, 0, 'paragraph', 0, p_name FROM part WHERE p_partkey % 3 = 2")
def doc_parse(spark, sf_dir):
    """Blocks of HTML, Markdown and plain documents."""
    k, n, name = F.col("p_partkey"), s(F.col("p_size")), F.col("p_name")
    html = F.concat(F.lit("<script>p('<p>no</p>')</script><H2 class='x'>Part "), s(k), F.lit("</H2><p>"), name, F.lit(" <b>of</b>\n"), n, F.lit("</p><ul><li>one</li></ul><table><tr><td>a</td><th>"), n, F.lit("</th></tr></table><pre>x = 1</pre>"))
    rows = read(spark, sf_dir, "part").select(k.alias("doc"), pick(k, "html", "markdown", "text").alias("kind"), F.when(k % 3 == 0, html).when(k % 3 == 1, F.concat(F.lit("# "), name)).otherwise(F.concat(F.lit("  "), name)).alias("t"))
    return D.parse(rows, "doc", "kind", "t")


@query("SELECT 'traces' AS name, count(*) * 2 AS n, 1000::BIGINT AS longest FROM part UNION ALL SELECT 'nodes', count(*), 0 FROM part UNION ALL SELECT 'by brand', count(*), 0 FROM part WHERE p_brand = 'Brand#1' UNION ALL SELECT 'present', 2, 0")
def run_artifacts(spark, sf_dir):
    """A run's tables saved, found, loaded, appended to, and looked up by any of their keys."""
    root = shared_folder(spark)
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    R.save(root, "code", {"nodes": parts})
    for _ in range(2):
        R.append(root, "runs", "traces", parts.select("id", F.repeat(F.lit("q"), F.lit(900)).alias("question"), F.repeat(F.lit("r"), F.lit(500)).alias("answer")), R.TRACE_CUTS)
    traces, nodes = R.load(spark, root, "runs", "traces"), R.load(spark, root, "code", "nodes")
    none = F.lit(0).cast("bigint").alias("longest")
    out = traces.agg(F.lit("traces").alias("name"), F.count("*").alias("n"), F.max(F.length("question") + F.length("answer")).cast("bigint").alias("longest"))
    out = out.unionByName(nodes.agg(F.lit("nodes").alias("name"), F.count("*").alias("n"), F.min(none).alias("longest")))
    found = R.index_sidecar(nodes, "id", "brand").where("key = 'brand' and value = 'Brand#1'")
    out = out.unionByName(found.agg(F.lit("by brand").alias("name"), F.count("*").alias("n"), F.coalesce(F.min(none), F.lit(0)).alias("longest")))
    return out.unionByName(R.discover(spark, root).where("present").agg(F.lit("present").alias("name"), F.count("*").alias("n"), F.min(none).alias("longest")))
