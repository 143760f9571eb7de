"""Search over an index of stems and letter runs: many queries at once, joined with what they ask for.

An index has two tables: postings (a row per word: stem, node, field, place), written once and reused, and
grams (a row per distinct run of up to three letters of a field), which are many times the texts and made as they are read. A query's terms meet postings by stem, and
texts inside names meet grams by the rarest run of theirs; only what meets there is compared whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stems as S
from ..functions import text as T
from .graph import cut

FIELDS = ("name", "file_path", "qualified_name")
GRAM = 3
#: Scores of a whole word, a part of the text, kind or file alone, and a name that holds a term.
WORD, PART, ALONE, FUZZY = 1.0, 0.6, 0.4, 0.5
#: Looked-up runs that are broadcast, so that the letter runs of all fields are not shuffled for them.
FEW = 100_000
#: Words of a claim that are looked for.
CLAIM_WORDS = 6


def postings(nodes: DataFrame, id: str = "id", fields=FIELDS) -> DataFrame:
    """(stem, id, field, at) of every word of the fields."""
    texts = nodes.select(F.col(id).alias("id"), F.explode(F.array(*[F.struct(F.lit(i).alias("field"), S.words(F.col(c)).alias("ws")) for i, c in enumerate(fields)])).alias("f"))
    stemmed = texts.select("id", "f.field", F.col("f.ws").alias("ws")).where(F.size("ws") > 0).withColumn("ss", S.stems(F.col("ws")))
    return stemmed.select("id", "field", F.posexplode("ss").alias("at", "stem")).select("stem", "id", "field", "at")


def letter_runs(text, least: int = 1):
    """Distinct runs of least to GRAM letters."""
    none = F.array().cast("array<string>")

    def of(n: int):
        return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n)))).otherwise(none)

    return F.array_distinct(F.concat(*[of(n) for n in range(least, GRAM + 1)]))


def grams(nodes: DataFrame, id: str = "id", fields=FIELDS) -> DataFrame:
    """(gram, id, field, text) of every field's runs of one to three letters, lower-cased; text is the field itself."""
    texts = nodes.select(F.col(id).alias("id"), F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.lower(F.col(c)).alias("text")) for i, c in enumerate(fields)])).alias("f")).select("id", "f.*").where("text <> ''")
    return texts.select(F.explode(letter_runs(F.col("text"))).alias("gram"), "id", "field", "text")


def gram_counts(runs: DataFrame) -> DataFrame:
    """(gram, n): how many fields hold a run; what the rarest run of a query is chosen by."""
    return runs.groupBy("gram").agg(F.count("*").alias("n"))


def parse(queries: DataFrame, text: str = "text") -> DataFrame:
    """queries with terms (kind: and file: words taken out, quoted ones bare), kinds and globs."""
    bare = lambda w: F.when((F.length(w) > 1) & w.startswith('"') & w.endswith('"'), F.substr(w, F.lit(2), F.length(w) - 2)).otherwise(w)
    parts = F.filter(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    kind, file = lambda w: w.rlike(r"(?i)^kind:[\w,]+$"), lambda w: w.rlike(r"(?i)^file:.+$")
    after = lambda ws: F.transform(ws, lambda w: F.regexp_replace(w, r"^[^:]*:", ""))
    rows = queries.withColumn("_w", parts)
    kinds = F.filter(F.split(F.lower(F.array_join(after(F.filter("_w", kind)), ",")), ","), lambda k: k != "")
    return rows.withColumns({"terms": F.transform(F.filter("_w", lambda w: ~kind(w) & ~file(w)), bare), "kinds": kinds, "globs": after(F.filter("_w", file))}).drop("_w")


def word_hits(parsed: DataFrame, index: DataFrame, by: str = "query_id", first: int | None = None) -> DataFrame:
    """(by, id): nodes with a field that holds a term's words, stemmed, side by side; any of the terms will do.

    Where only a query's first hits by id are wanted, a term of one word brings no more than its first ones.
    """
    terms = parsed.select(by, F.posexplode("terms").alias("term", "t")).withColumn("ws", S.words(F.col("t"))).where(F.size("ws") > 0)
    asked = terms.select(by, "term", F.size("ws").alias("n"), F.posexplode(S.stems(F.col("ws"))).alias("k", "stem"))
    lone = asked.where("n = 1").select(by, "stem").distinct()
    held = index.select("stem", "id").join(lone.select("stem").distinct(), "stem", "left_semi").distinct()
    if first:
        held = held.withColumn("_n", F.row_number().over(Window.partitionBy("stem").orderBy("id"))).where(F.col("_n") <= first).drop("_n")
    one = lone.join(held, "stem").select(by, "id")
    met = asked.where("n > 1").join(index, "stem")
    side = met.groupBy(by, "term", "n", "id", "field", (F.col("at") - F.col("k")).alias("first")).agg(F.count_distinct("k").alias("m"))
    return one.unionByName(side.where("m = n").select(by, "id")).distinct()


def part_hits(asked: DataFrame, runs: DataFrame, counts: DataFrame, by: str = "query_id", wild: bool = True) -> DataFrame:
    """(by, id, field) of fields that hold asked's text q, whatever the case; where wild, _ stands for a letter and % for any text.

    Of the longest plain piece of q the rarest run of letters is looked up, and what has it is compared whole;
    a q that has no plain letter finds nothing.
    """
    pieces = F.split(F.lower("q"), "[_%]") if wild else F.array(F.lower("q"))
    longest = F.aggregate(pieces, F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best))
    keyed = asked.distinct().withColumn("piece", longest)
    size = F.least(F.length("piece"), F.lit(GRAM))
    own = keyed.select(by, "q", F.explode(F.filter(letter_runs(F.col("piece")), lambda g: F.length(g) == size)).alias("gram"))
    rare = own.join(counts, "gram", "left").groupBy(by, "q").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    held = F.like(F.col("text"), F.concat(F.lit("%"), F.lower("q"), F.lit("%")), F.lit("\u0001")) if wild else F.contains("text", F.lower("q"))
    rare = cut(rare)
    met = runs.join(F.broadcast(rare) if rare.count() <= FEW else rare, "gram")
    return met.where(held).select(by, "id", "field").distinct()


def glob_pattern(glob):
    """Regular expression of a glob column: * crosses slashes, ? is one character."""
    plain = F.regexp_replace(glob, r"([\\.^$+{}()|\[\]])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(plain, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def fits(glob):
    """Whether _path matches a glob, or the glob without its leading stars and slashes."""
    return F.regexp_like("_path", glob_pattern(glob)) | F.regexp_like("_path", glob_pattern(F.regexp_replace(glob, r"^[*/]+", "")))


def allowed(hits: DataFrame) -> DataFrame:
    """Hits whose node (_kind, _path) is of their query's kinds and globs; an empty list asks nothing."""
    kind = (F.size("kinds") == 0) | F.array_contains("kinds", F.col("_kind"))
    return hits.where(kind & ((F.size("globs") == 0) | F.exists("globs", fits)))


def alone(asked: DataFrame, node: DataFrame, by: str) -> DataFrame:
    """(by, id) for queries of kinds and globs alone: by kind where there is one, else through the distinct paths."""
    kinded = asked.select(by, "kinds", "globs", F.explode("kinds").alias("_kind")).join(node, "_kind")
    by_kind = allowed(kinded).select(by, "id")
    globbed = asked.where(F.size("kinds") == 0).select(by, F.explode("globs").alias("g"))
    # A glob meets the distinct paths that share its plain folders; one that starts with a star meets them all.
    lead = F.regexp_extract("g", r"^((?:[^*?/]+/)*)", 1)
    folders = F.transform(F.sequence(F.lit(0), F.size(F.split("_path", "/")) - 1), lambda n: F.concat(F.array_join(F.slice(F.split("_path", "/"), F.lit(1), n), "/"), F.when(n > 0, "/").otherwise("")))
    paths = node.select("_path").distinct().select("_path", F.explode(folders).alias("lead"))
    matched = globbed.select("g").distinct().withColumn("lead", lead).join(paths, "lead").where(fits(F.col("g"))).select("g", "_path").distinct()
    by_path = globbed.join(matched, "g").join(node, "_path").select(by, "id")
    return by_kind.unionByName(by_path).distinct()


def search(queries: DataFrame, nodes: DataFrame, index: DataFrame, runs: DataFrame, limit: int, id: str = "id", by: str = "query_id", text: str = "text", counts: DataFrame | None = None, fuzzy: bool = True) -> DataFrame:
    """(by, id, score, rank): the first limit nodes of each query by stage, then by id.

    Stages: a term's words 1.0; the whole query inside a field 0.6; kinds and globs alone 0.4; and last, where
    these leave room, names that hold a term of the query 0.5, whatever their kind and path.
    """
    counts = gram_counts(runs) if counts is None else counts
    parsed = parse(queries.select(by, F.col(text).alias("text"))).withColumn("q", F.array_join("terms", " "))
    node = nodes.select(F.col(id).alias("id"), F.lower("kind").alias("_kind"), F.coalesce("file_path", F.lit("")).alias("_path"))
    filled, rules = parsed.where("q <> ''"), parsed.where((F.size("kinds") > 0) | (F.size("globs") > 0)).select(by, "kinds", "globs")
    fit = lambda hits: hits.join(rules, by, "left_anti").unionByName(allowed(hits.join(rules, by).join(node, "id")).select(by, "id"))
    # A query without rules keeps its first hits by id; one whose words fill it has no room for parts.
    free = word_hits(filled.join(rules, by, "left_anti"), index, by, limit)
    words = cut(free.unionByName(fit(word_hits(filled.join(rules, by, "left_semi"), index, by))))
    room = filled.join(words.groupBy(by).agg(F.count("*").alias("n")).where(F.col("n") >= limit), by, "left_anti")
    parts = fit(part_hits(room.select(by, "q"), runs, counts, by).select(by, "id").distinct()).join(words, [by, "id"], "left_anti")
    held = words.withColumn("score", F.lit(WORD)).unionByName(parts.withColumn("score", F.lit(PART)))
    out = held.unionByName(alone(rules.join(filled, by, "left_anti"), node, by).withColumn("score", F.lit(ALONE))).withColumn("late", F.lit(0))
    if fuzzy:
        out = cut(out)  # read three times below
        full = out.groupBy(by).agg(F.count("*").alias("n")).where(F.col("n") >= limit)
        terms = parsed.join(full, by, "left_anti").select(by, F.explode(T.search_terms(F.col("text"))).alias("q"))
        near = part_hits(terms, runs.where("field = 0"), counts, by, wild=False).select(by, "id").distinct()
        out = out.unionByName(near.join(out, [by, "id"], "left_anti").withColumn("score", F.lit(FUZZY)).withColumn("late", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("late", F.desc("score"), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= limit).select(by, "id", "score", "rank")


def supporting(claims: DataFrame, nodes: DataFrame, index: DataFrame, runs: DataFrame, limit: int = 5, by: str = "claim_id", text: str = "claim") -> DataFrame:
    """Nodes that speak of claims: a search for the first words of three letters or more, or for the claim if it has none."""
    found = F.slice(F.regexp_extract_all(text, F.lit(r"([\w\p{L}\p{N}]{3,})"), F.lit(1)), 1, CLAIM_WORDS)
    asked = claims.select(by, F.when(F.size(found) > 0, F.array_join(found, " ")).otherwise(F.col(text)).alias("text"))
    return search(asked, nodes, index, runs, limit, by=by)
