"""Benchmark decontamination by winnowing, in DataFrame functions only.

Contract
* A word is a run of ASCII digits, a-z (A-Z are lower-cased first) and characters beyond ASCII.
* Every item contributes each of its windows of SPAN consecutive words; an item of fewer words, but
  not none, is a single window. A document word inside any occurrence of a window is hit.
* Null or empty texts have no words: no hits as documents, no windows as items. Items with equal texts
  all count. Rows that repeat an id, and extra columns of any name, pass: only id and text are used.
* An empty benchmark or document table gives no hits or no rows.

Method: every GRAM-word hash of a text is taken, and of each SPAN - GRAM + 1 neighbouring ones the
smallest is kept. Two texts that share SPAN words share all hashes of that span and so keep the same
one: none is missed. Documents and items that keep a common hash are joined, and only there are the
words compared, window by window along the diagonals of the hits. Items shorter than SPAN have no such
guarantee, so the hashes of all runs of their length are looked up instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, let, match_rows, named, row_key, table, words

SPAN, GRAM = 10, 5
#: The benchmark is broadcast up to so many kept hashes (about 10 MB with its words); beyond that the joins shuffle.
BROADCAST_ROWS = 200_000


def run_hashes(hashes, length: int):
    """Hash of each run of so many words, in order."""
    none = F.array().cast("array<bigint>")
    runs = lambda wh: F.transform(F.sequence(F.lit(0), F.size(wh) - length), lambda i: F.xxhash64(*[F.get(wh, i + k) for k in range(length)]))
    return let(hashes, lambda wh: F.when(F.size(wh) >= length, runs(wh)).otherwise(none))


def winnow(grams):
    """The smallest of each SPAN - GRAM + 1 neighbours, once each."""
    width, none = SPAN - GRAM + 1, F.array().cast("array<bigint>")
    least = lambda g: F.transform(F.sequence(F.lit(0), F.size(g) - width), lambda i: F.least(*[F.get(g, i + k) for k in range(width)]))
    return F.array_distinct(let(grams, lambda g: F.when(F.size(g) >= width, least(g)).otherwise(none)))


def word_hashes(col):
    return F.transform(col, lambda w: F.xxhash64(w))


def benchmark_marks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, its row's key ik and words iw, run length, and the hashes f to look up: kept ones, or for a short item the whole."""
    split = items.select(F.col(item_id).alias("item"), row_key(item_id, text).alias("ik"), words(F.col(text)).alias("iw")).where(F.size("iw") > 0)
    hashed = split.withColumn("wh", word_hashes(F.col("iw")))
    kept = winnow(run_hashes(F.col("wh"), GRAM))
    whole = F.array(F.coalesce(*[F.when(F.size("wh") == n, F.xxhash64(*[F.get("wh", F.lit(k)) for k in range(n)])) for n in range(1, SPAN)]))
    marks = F.explode(F.when(F.size("iw") >= SPAN, kept).otherwise(whole))
    return hashed.select("item", "ik", "iw", F.least(F.size("iw"), F.lit(SPAN)).alias("len"), marks.alias("f"))


def of_length(hashes, n: int):
    """Each hash with the number of its words."""
    return F.transform(hashes, lambda h: named(len=F.lit(n), f=h))


def document_marks(keyed: DataFrame, lengths: list[int]) -> DataFrame:
    """(_id, _k, len, f) of every document: kept hashes, and all runs of the short items' lengths."""
    hashed = keyed.select("_id", "_k", word_hashes(words(F.col("_t"))).alias("wh"))
    kept = of_length(winnow(run_hashes(F.col("wh"), GRAM)), SPAN)
    more = [of_length(F.array_distinct(run_hashes(F.col("wh"), n)), n) for n in lengths if n < SPAN]
    return hashed.select("_id", "_k", F.explode(F.concat(kept, *more) if more else kept).alias("m")).select("_id", "_k", "m.len", "m.f")


def find_hits(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per occurrence: _id, _k (row key), item, first word's position at, number of words len."""
    spark = documents.sparkSession
    keyed = documents.select(F.col(doc_id).alias("_id"), row_key(doc_id, text).alias("_k"), F.col(text).alias("_t"))
    marks = cut(benchmark_marks(benchmark, item_id, item_text))
    sizes = {r["len"]: r["n"] for r in marks.groupBy("len").agg(F.count("*").alias("n")).collect()}  # SPAN rows at most
    if not sizes:
        return spark.createDataFrame([], f"_id {documents.schema[doc_id].dataType.simpleString()}, _k bigint, item {benchmark.schema[item_id].dataType.simpleString()}, at int, len int")
    small = F.broadcast if sum(sizes.values()) <= BROADCAST_ROWS else lambda df: df
    met = document_marks(keyed, sorted(sizes)).join(small(marks.select("len", "f", "item", "ik")), ["len", "f"])
    # One row per document and item row with their common hashes; the item's words come along. Rows of one id may differ in their text.
    per_item = met.groupBy("_id", "_k", "item", "ik", "len").agg(F.collect_set("f").alias("fs"))
    items = small(marks.select(F.col("item").alias("_item"), F.col("ik").alias("_ik"), "iw").distinct())
    met_items = per_item.join(items, (F.col("ik") == F.col("_ik")) & F.col("item").eqNullSafe(F.col("_item")))
    per_doc = met_items.groupBy(F.col("_id").alias("_i2"), F.col("_k").alias("_k2")).agg(F.collect_list(F.struct("item", "len", "fs", "iw")).alias("ms"))
    docs = keyed.join(per_doc, (F.col("_k") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_i2")))
    both = let(words(F.col("_t")), lambda dw: named(dw=dw, dg=run_hashes(word_hashes(dw), GRAM)))
    one = docs.select("_id", "_k", both.alias("b"), F.explode("ms").alias("m")).select("_id", "_k", "b.*", "m.*")
    one = one.withColumn("ig", run_hashes(word_hashes(F.col("iw")), GRAM))
    places = lambda runs, fs: F.filter(F.transform(runs, lambda h, i: F.when(F.array_contains(fs, h), named(i=i, h=h))), lambda x: x.isNotNull())
    alike = lambda dp, ip: F.flatten(F.transform(dp, lambda p: F.transform(F.filter(ip, lambda q: q["h"] == p["h"]), lambda q: named(diag=p["i"] - q["i"], q=q["i"]))))
    begins = lambda x: F.when(F.size("iw") >= SPAN, F.sequence(F.greatest(F.lit(0), x["q"] - (SPAN - GRAM)), F.least(x["q"], F.size("iw") - SPAN)))
    around = lambda x: F.transform(begins(x), lambda s: named(d=x["diag"] + s, s=s))
    fits = lambda x: (x["d"] >= 0) & (x["d"] <= F.size("dw") - SPAN) & (F.slice("dw", F.greatest(x["d"], F.lit(0)) + 1, F.lit(SPAN)) == F.slice("iw", x["s"] + 1, F.lit(SPAN)))
    tried = let(places(F.col("dg"), F.col("fs")), lambda dp: let(places(F.col("ig"), F.col("fs")), lambda ip: F.array_distinct(F.flatten(F.transform(alike(dp, ip), around)))))
    at = F.array_distinct(F.transform(F.filter(tried, fits), lambda x: x["d"]))
    long = one.where(F.col("len") == SPAN).select("_id", "_k", "item", F.explode(at).alias("at"), "len")
    short = one.where(F.col("len") < SPAN).select(
        "_id", "_k", "item", F.explode(F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("dw") - F.col("len"))), lambda p: F.slice("dw", p + 1, F.col("len")) == F.col("iw"))).alias("at"), "len"
    )
    return long.unionByName(short) if min(sizes) < SPAN else long


def decontaminate(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (sorted ids as strings), contaminated."""
    hits = find_hits(documents, benchmark, doc_id, text, item_id, item_text)
    spans = F.flatten(F.transform("spans", lambda x: F.sequence(x["at"], x["at"] + x["len"] - 1)))
    per_doc = hits.groupBy("_id", "_k").agg(F.collect_set(F.struct("at", "len")).alias("spans"), F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    per_doc = per_doc.select(F.col("_id").alias("_i2"), F.col("_k").alias("_k2"), F.size(F.array_distinct(spans)).cast("bigint").alias("n_hit"), "items")
    docs = documents.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("_k"), F.size(words(F.col(text))).cast("bigint").alias("n_words"))
    out = docs.join(per_doc, (F.col("_k") == F.col("_k2")) & F.col("doc_id").eqNullSafe(F.col("_i2")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without the rows that any benchmark window occurs in."""
    hits = find_hits(documents, benchmark).select("_id", "_k").distinct()
    return match_rows(documents, hits, "left_anti")[0]


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, k, k + least(10, len(w)) - 1) AS run FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS k FROM i)),
dw AS (SELECT rid, k, n, list_slice(w, k, k + n - 1) AS run FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT rid, item_id, k, n FROM dw JOIN iw USING (n, run)),
p AS (SELECT rid, count(DISTINCT pos) AS hit FROM (SELECT rid, unnest(range(k, k + n)) AS pos FROM (SELECT DISTINCT rid, k, n FROM h)) GROUP BY rid),
s AS (SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN s USING (rid)
"""
