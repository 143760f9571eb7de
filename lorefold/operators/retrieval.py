"""Evidence for questions about code: query plans, channels of candidates, facts; all items at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import atoms as A
from . import graph as G
from . import search as Q

#: Base scores of the channels, and what business code adds.
CHANNELS = {"context_ref": (0.8, 0.0), "file_ref": (0.4, 0.0), "symbol_search": (0.45, 0.2), "trace": (0.3, 0.0), "content_search": (0.3, 0.15), "evidence_index": (0.7, 0.0)}


def query_plan(items: DataFrame) -> DataFrame:
    """Terms, symbols (8) and anchors (4 references) of each item (id, question, context_refs, expected_checks)."""
    question = F.concat_ws(" ", F.col("question"), F.array_join(F.coalesce("expected_checks", F.array().cast("array<string>")), " "))
    names = F.array_distinct(F.regexp_extract_all(question, F.lit(r"\b([A-Z][a-zA-Z0-9]{2,})\b"), F.lit(1)))
    return items.select("id", T.alignment_tokens(question).alias("terms"), F.slice(F.filter(names, lambda n: F.length(n) > 3), 1, 8).alias("symbols"), F.slice(F.array_distinct(F.coalesce("context_refs", F.array().cast("array<string>"))), 1, 4).alias("anchors"))


def _first(df: DataFrame, by: list[str], most: int) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*by).orderBy("node_id"))
    return df.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def candidates(plans: DataFrame, nodes: DataFrame, edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """(id, node_id, source, path, symbol, role, base) of the channels: anchors, symbols, one step of calls, content, evidence."""
    own = nodes.select(F.col("id").alias("node_id"), F.col("name").alias("symbol"), F.col("file_path").alias("path"), F.lower(F.concat_ws(" ", "name", "docstring")).alias("words"))
    refs = plans.select("id", F.explode("anchors").alias("ref")).withColumn("r", T.context_ref(F.col("ref"))).select("id", F.col("r.path").alias("path"), F.col("r.symbol").alias("symbol"))
    anchored = refs.join(own, ["path", "symbol"]).select("id", "node_id", F.lit("context_ref").alias("source"))
    in_file = _first(refs.where("symbol = ''").join(own.drop("symbol"), "path").select("id", "path", "node_id"), ["id", "path"], 3).select("id", "node_id", F.lit("file_ref").alias("source"))
    named = plans.select("id", F.explode("symbols").alias("symbol")).join(own.select("symbol", "node_id"), "symbol")
    by_symbol = _first(named, ["id", "symbol"], 3).select("id", "node_id", F.lit("symbol_search").alias("source"))
    steps = anchored.select("id", F.col("node_id").alias("src")).join(G.neighbours(edges), "src").select("id", "src", F.col("dst").alias("node_id"))
    traced = _first(steps, ["id", "src"], 2).select("id", "node_id", F.lit("trace").alias("source"))
    words = own.select("node_id", F.explode(F.array_distinct(F.split("words", r"[^a-z0-9]+"))).alias("term")).where("length(term) >= 4")
    met = plans.select("id", F.explode(F.slice("terms", 1, 3)).alias("term")).join(words, "term").select("id", "term", "node_id")
    by_content = _first(met, ["id", "term"], 3).select("id", "node_id", F.lit("content_search").alias("source"))
    proofs = plans.select("id", F.explode("anchors").alias("ref")).join(evidence.select("ref", "node_id"), "ref").select("id", "ref", "node_id")
    by_evidence = _first(proofs, ["id", "ref"], 2).select("id", "node_id", F.lit("evidence_index").alias("source"))
    out = anchored
    for more in (in_file, by_symbol, traced, by_content, by_evidence):
        out = out.unionByName(more)
    role = A.role_of(F.concat_ws("#", "path", "symbol"))
    joined = out.distinct().join(own.drop("words"), "node_id").withColumn("role", role)
    base = F.create_map(*[x for k, (b, _) in CHANNELS.items() for x in (F.lit(k), F.lit(b))])
    more = F.create_map(*[x for k, (_, m) in CHANNELS.items() for x in (F.lit(k), F.lit(m))])
    business = F.col("role").isin(*A.BUSINESS_ROLES)
    return joined.withColumn("base", F.element_at(base, F.col("source")) + F.when(business, F.element_at(more, F.col("source"))).otherwise(0.0))


def ranked(found: DataFrame, most: int) -> DataFrame:
    """Candidates re-ranked with what their channels say: anchors, meaning, call chains and evidence."""
    is_source = lambda *s: F.col("source").isin(*s)
    scored = found.select(
        F.col("id").alias("query_id"), F.col("node_id").alias("candidate_id"), "source", "path", "symbol", "role", "base", F.when(is_source("context_ref"), 1.0).otherwise(0.0).alias("anchor"),
        F.when(is_source("context_ref"), 0.8).when(is_source("trace"), 0.6).when(is_source("content_search"), 0.5).when(is_source("symbol_search"), 0.3).otherwise(0.0).alias("semantic"),
        F.when(is_source("trace"), 0.8).otherwise(0.0).alias("chain"), F.when(is_source("evidence_index"), 1.0).otherwise(0.0).alias("evidence"),
    )
    return Q.rerank(scored, most)


def facts(best: DataFrame, with_bodies: DataFrame, least: float = 0.3, most: int = 8) -> DataFrame:
    """(id, fact_id, statement, confidence) of ranked candidates: what a body calls, else its first telling line; each statement once an item."""
    body = with_bodies.select(F.col("id").alias("candidate_id"), "body")
    calls = F.slice(T.method_calls(F.col("body")), 1, 4)
    statement = F.when(F.size(calls) > 0, F.concat(F.col("symbol"), F.lit(" calls "), F.array_join(calls, ", "))).otherwise(F.concat_ws(": ", F.col("symbol"), F.get(T.effective_lines(F.col("body")), F.lit(0))))
    told = best.where((F.col("rank") <= most) & (F.col("score") >= least)).join(body, "candidate_id").withColumn("statement", statement)
    first = F.row_number().over(Window.partitionBy("query_id", "statement").orderBy("rank"))
    confidence = F.bround(F.least(F.lit(0.95), F.col("base") + 0.1 + F.least(F.lit(0.1), 0.15 * F.col("score"))), 2)
    one = told.withColumn("_f", first).where("_f = 1")
    return one.select(F.col("query_id").alias("id"), T.fact_id(F.col("query_id"), F.col("candidate_id")).alias("fact_id"), "statement", confidence.alias("confidence"), "rank")


def retrieve(items: DataFrame, files: DataFrame, nodes: DataFrame, edges: DataFrame, evidence: DataFrame, most: int = 12) -> tuple[DataFrame, DataFrame]:
    """Ranked candidates and facts of every item."""
    from . import code as C

    best = ranked(candidates(query_plan(items), nodes, edges, evidence), most)
    return best, facts(best, C.bodies(files, nodes))
