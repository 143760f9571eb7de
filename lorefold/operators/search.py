"""Staged search, symbol ranking, weighted re-ranking and retrieval over node tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .atoms import BUSINESS_ROLES, GLUE_ROLES
from .graph import cut, shuffled

#: Weights of the re-ranking score.
ANCHOR, ROLE, SEMANTIC, CHAIN, EVIDENCE, GLUE = 0.35, 0.25, 0.20, 0.10, 0.10, 0.25


@dataclass
class Query:
    """A search as typed: terms, kind:a,b and file:glob prefixes."""

    terms: list[str] = field(default_factory=list)
    kinds: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)


def parse_query(raw: str) -> Query:
    out = Query()
    for word in raw.split():
        name, colon, value = word.partition(":")
        if colon and value and name in ("kind", "file"):
            (out.kinds if name == "kind" else out.files).extend(v for v in value.split(",") if v)
        else:
            out.terms.append(word[1:-1] if len(word) > 1 and word[0] == word[-1] and word[0] in "\"'" else word)
    return out


def inverted_index(nodes: DataFrame, id: str, *columns: str) -> DataFrame:
    """Distinct (token, id) of the columns' lower-cased words."""
    words = F.flatten(F.array(*[F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^a-z0-9]+") for c in columns]))
    return nodes.select(F.explode(F.array_distinct(words)).alias("token"), F.col(id).alias("id")).where("token <> ''")


def search(nodes: DataFrame, query: Query, limit: int, id: str = "id", columns=("name", "file_path", "qualified_name")) -> DataFrame:
    """Hits by stage: a whole word 1.0, a part of the text 0.6, kind and file alone 0.4; best stage of each node, ties by id.

    Kinds and files filter the scan; all stages are one pass over it, without union or join.
    """
    kept = nodes
    if query.kinds:
        kept = kept.where(F.col("kind").isin(query.kinds))
    if query.files:
        kept = kept.where(T.matches_any(F.col("file_path"), query.files))
    word, part = F.lit(False), F.lit(False)
    for term in query.terms:
        low = F.lit(term.lower())
        tokens = lambda c: F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^a-z0-9]+")
        for c in columns:
            word = word | F.array_contains(tokens(c), low)
            part = part | F.lower(F.coalesce(F.col(c), F.lit(""))).contains(low)
    alone = F.lit(not query.terms)
    score = F.when(word, 1.0).when(part, 0.6).when(alone, 0.4)
    hits = kept.withColumn("score", score).where("score is not null")
    others = [c for c in nodes.columns if c != id]
    best = hits.groupBy(id).agg(F.max(F.struct("score", *others)).alias("r"))
    return best.select(id, "r.*").orderBy(F.desc("score"), id).limit(limit)


def rank_symbols(nodes: DataFrame, symbol: str, near: str | None = None) -> DataFrame:
    """Nodes of a name: exact 10, near file 25 or name in path 12, types 5, generated -20."""
    low = F.lit(symbol.lower())
    name, path = F.lower("name"), F.coalesce(F.col("file_path"), F.lit(""))
    place = F.when(path.contains(near) if near else F.lit(False), 25).when(F.lower(path).contains(low), 12).otherwise(0)
    score = F.when(F.col("name") == symbol, 10).otherwise(0) + place + F.when(F.col("kind").isin("class", "interface"), 5).otherwise(0) - F.when(F.lower(path).rlike("swagger|generated"), 20).otherwise(0)
    return nodes.where(name.contains(low)).withColumn("rank_score", score).orderBy(F.desc("rank_score"), "id")


def rerank(candidates: DataFrame, most: int, by: str = "query_id") -> DataFrame:
    """Weighted score of (anchor, role, semantic, chain, evidence), glue subtracted; best of each path and symbol, most a query."""
    role = F.when(F.col("role").isin(*BUSINESS_ROLES), 1.0).when(F.col("role") == "call_chain", 0.6).when(F.col("role") == "unknown", 0.3).otherwise(0.0)
    glue = F.when(F.col("role") == "handler_only", 0.7).when(F.col("role").isin(*GLUE_ROLES), 1.0).otherwise(0.0)
    score = ANCHOR * F.col("anchor") + ROLE * role + SEMANTIC * F.col("semantic") + CHAIN * F.col("chain") + EVIDENCE * F.col("evidence") - GLUE * glue
    scored = candidates.withColumn("score", F.bround(score, 4))
    first = F.row_number().over(Window.partitionBy(by, "path", "symbol").orderBy(F.desc("score"), "candidate_id"))
    n = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "candidate_id"))
    return scored.withColumn("_f", first).where("_f = 1").drop("_f").withColumn("rank", n).where(F.col("rank") <= most)


def quota(hits: DataFrame, source: str, limit: int, sources: int) -> DataFrame:
    """Hits of several sources: each gives limit over sources rows, three at least; the best limit stay."""
    each = max(limit // max(1, sources), 3)
    n = F.row_number().over(Window.partitionBy(source).orderBy(F.desc("score"), "id"))
    return hits.withColumn("_n", n).where(F.col("_n") <= each).drop("_n").orderBy(F.desc("score"), source, "id").limit(limit)


def read_lines(text: Column, first: int, last: int, most: int = 300) -> Column:
    """Lines first to last, counted from 1, most at most."""
    return F.array_join(F.slice(F.split(text, "\n"), max(1, first), min(most, max(0, last - max(1, first) + 1))), "\n")


def search_content(files: DataFrame, term: str, most: int) -> DataFrame:
    """(path, line, text): the first line of each file that holds the term."""
    lines = F.split("text", "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains(term)), True)
    return files.where(F.col("text").contains(term)).select("path", at.alias("line"), F.get(lines, (at - 1).cast("int")).alias("text")).orderBy("path").limit(most)


def resolve_refs(items: DataFrame, symbols: DataFrame) -> DataFrame:
    """(id, ref, outcome) of items' references: symbol_hit, file_hit or miss."""
    refs = items.select("id", F.explode("context_refs").alias("ref")).withColumn("r", T.context_ref(F.col("ref"))).select("id", "ref", "r.path", "r.symbol")
    own = cut(symbols.select(F.col("file_path").alias("path"), F.col("name").alias("symbol")).distinct())  # read twice
    known, files = shuffled(own.withColumn("s", F.lit(True))), shuffled(own.select("path").distinct().withColumn("f", F.lit(True)))
    joined = refs.join(known, ["path", "symbol"], "left").join(files, "path", "left")
    return joined.select("id", "ref", F.when(F.col("s"), "symbol_hit").when(F.col("f"), "file_hit").otherwise("miss").alias("outcome"))
