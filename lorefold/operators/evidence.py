"""Evidence blocks of failed cases: a cascade of sources, each asked only for cases that the ones before left bare, under a budget of characters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Letters of a question and checks named, cases and letters of a report, letters of a symbol's source, of a file's head and of a found block.
QUESTION, CHECKS, CASES, BUDGET, CARD, HEAD, FOUND, REFS, ASKED = 120, 6, 5, 4500, 600, 1200, 800, 2, 4


def cascade(cases: DataFrame, sources: list[tuple[DataFrame, bool]], key: str = "id") -> DataFrame:
    """(key, source, place, text) of sources (key, place, text) in order; one whose flag is set is taken always, others only for cases that have nothing yet."""
    met, out = cases.select(key).limit(0), None
    for number, (rows, always) in enumerate(sources):
        own = rows.select(key, F.lit(number).alias("source"), "place", "text").join(cases.select(key), key, "left_semi")
        own = own if always else own.join(met, key, "left_anti")
        out = own if out is None else out.unionByName(own)
        met = met.unionByName(own.select(key)).distinct()
    return out


def within_budget(blocks: DataFrame, text: str, order: list, budget: int, by: list[str]) -> DataFrame:
    """Blocks from the first on up to the one that goes over the budget; what comes after that is out, however short."""
    used = F.sum(F.length(text)).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return blocks.withColumn("_used", used).where(F.col("_used") <= budget).drop("_used")


def reflect_evidence(failed: DataFrame, evidence: DataFrame, files: DataFrame, cards: DataFrame, found: DataFrame, by: str = "step", cases: int = CASES, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(by, text): a report for each step's first failed cases; and (by, cases, refs, resolved, with_evidence).

    failed has (by, id, place, question, missed_checks, context_refs). Sources, in order: entries of the evidence
    index (ref, text) for a case's references; its first references, as the symbol's card (file_path, symbol,
    text) or else the file's head (path, text); and, for cases left bare, found blocks (id, place, text).
    """
    n = F.row_number().over(Window.partitionBy(by).orderBy("place", "id"))
    first = failed.withColumn("_n", n).where(F.col("_n") <= cases)
    keyed = first.withColumn("_case", F.to_json(F.struct(by, "id")))
    refs = keyed.select("_case", F.posexplode(F.slice("context_refs", 1, REFS)).alias("place", "ref")).withColumn("r", T.context_ref(F.col("ref"))).select("_case", "place", "ref", "r.path", "r.symbol")
    told = refs.join(evidence, "ref").select("_case", "place", "text")
    named = refs.where("symbol <> ''").join(cards.select(F.col("file_path").alias("path"), "symbol", F.col("text").alias("_card")), ["path", "symbol"]).select("_case", "place", F.concat(F.lit("**Symbol** `"), F.col("symbol"), F.lit("`\n```\n"), F.substring("_card", 1, CARD), F.lit("\n```")).alias("text"))
    heads = refs.join(named.select("_case", "place"), ["_case", "place"], "left_anti").join(files.select("path", F.col("text").alias("_head")), "path").where("coalesce(_head, '') <> ''")
    head = heads.select("_case", "place", F.concat(F.lit("**File** `"), F.col("path"), F.lit("`:\n```\n"), F.substring("_head", 1, HEAD), F.lit("\n```")).alias("text"))
    more = keyed.select("_case", "id").join(found, "id").select("_case", "place", F.substring("text", 1, FOUND).alias("text"))
    parts = cascade(keyed, [(told, True), (named.unionByName(head), True), (more, False)], "_case")
    body = parts.groupBy("_case").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "place", "text"))), lambda p: p["text"]), "\n").alias("_body"))
    title = F.concat(F.lit("### Case "), F.col("id").cast("string"), F.lit(": "), F.substring(F.coalesce("question", F.lit("")), 1, QUESTION))
    missed = F.slice(F.coalesce("missed_checks", F.array().cast("array<string>")), 1, CHECKS)
    line = F.when(F.size(missed) > 0, F.concat(F.lit("missed checks: "), F.array_join(missed, ", ")))
    blocks = keyed.join(body, "_case", "left").withColumn("_block", F.concat_ws("\n", title, line, F.col("_body")))
    held = within_budget(blocks, "_block", ["_n"], budget, [by])
    texts = held.groupBy(by).agg(F.concat(F.lit("## Code Evidence (from project graph)\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_block"))), lambda b: b["_block"]), "\n\n")).alias("text"))
    resolved = reduce(DataFrame.unionByName, [named.select("_case"), head.select("_case")]).groupBy("_case").agg(F.count("*").alias("_resolved"))
    counted = blocks.join(resolved, "_case", "left").groupBy(by).agg(F.count("*").alias("cases"), F.sum(F.size(F.slice(F.coalesce("context_refs", F.array().cast("array<string>")), 1, REFS))).alias("refs"), F.sum(F.coalesce("_resolved", F.lit(0))).cast("bigint").alias("resolved"), F.count("_body").alias("with_evidence"))
    return texts, counted


#: Searches asked for a failure at most.
QUERIES = 6


def graph_queries(question, missed):
    """What to look for after a failure: missed checks that a graph can be searched for, the question, and symbols it names; distinct, in order, QUERIES at most."""
    asked = T.strip(F.coalesce(question, F.lit("")))
    checks = F.filter(F.transform(F.coalesce(missed, F.array().cast("array<string>")), lambda c: T.strip(F.coalesce(c, F.lit("")))), T.is_graph_searchable)
    names = F.regexp_extract_all(asked, F.lit(r"\b([A-Z][a-zA-Z0-9]{3,})\b"), F.lit(1))
    every = F.concat(checks, F.array(T.strip(F.substring(asked, 1, QUESTION))), names)
    return F.slice(F.array_distinct(F.filter(every, lambda q: q != "")), 1, QUERIES)


def resolve_roles(items: DataFrame, hints: DataFrame) -> DataFrame:
    """items with framework and role: their own (graph_framework, graph_role), else what hints (task_type, framework, roles) say of their task, else empty."""
    own = F.trim(F.coalesce("graph_role", F.lit("")))
    named = hints.groupBy(F.col("task_type").alias("_t")).agg(F.min(F.struct(F.coalesce("framework", F.lit("")).alias("f"), F.coalesce(F.get("roles", F.lit(0)), F.lit("")).alias("r"))).alias("_h"))
    joined = items.join(named, F.trim("task_type") == F.col("_t"), "left")
    return joined.withColumn("framework", F.when(own != "", F.trim(F.coalesce("graph_framework", F.lit("")))).otherwise(F.coalesce("_h.f", F.lit("")))).withColumn("role", F.when(own != "", own).otherwise(F.coalesce("_h.r", F.lit("")))).drop("_t", "_h")
