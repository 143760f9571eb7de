"""Secret scans: credentials in texts, and parts that only mean something together.

Contract
* Base kinds, leftmost and without overlap per kind: assign (a name such as password or api_key, then
  a value of 12 characters or more), access (AKIA and capitals or digits, 18 or more), hex (16 or more).
* Weak kinds, reported only when the parts that complement them start within WINDOW code points in the
  same text: weak_key (40 base64 characters of mixed case and digits) beside an access identifier;
  weak_id (another identifier prefix) beside an assigned or weak key; endpoint (a URL) beside both.
* Null and empty texts hold nothing. Rows that repeat an id are scanned each; extra columns pass.
* Positions are code points, ends exclusive; spans are ordered by start, then kind as in KINDS.

The scan runs over texts as they lie. Only spans are shuffled: weak ones meet, by document and bin of
WINDOW positions, the first and last part of each role in their own and the neighbouring bins, which
decides every distance without listing pairs.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, match_rows, named, row_key, table

KINDS = ("assign", "access", "hex", "weak_key", "weak_id", "endpoint")
WINDOW = 400
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
WEAK_ID = re.compile(r"(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}(?![A-Za-z0-9])")
ENDPOINT = re.compile(r"""https?://[^\s"'<>]+""")
MIXED = re.compile(r"(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])")
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
SPAN_TYPE = "array<struct<start:int,kind:int,end:int>>"


def scan_text(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base and weak spans as (start, kind's place in KINDS, end), ordered."""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    weak = [(m.start(), 3, m.end()) for m in WEAK_KEY.finditer(text) if MIXED.match(m[0])]
    weak += [(m.start(), 4, m.end()) for m in WEAK_ID.finditer(text)]
    weak += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(base), sorted(weak)


def _scan(batches):
    for batch in batches:
        base, weak = [], []
        for text in batch.column(2):
            b, w = scan_text(text.as_py() or "")
            base.append(b)
            weak.append(w)
        as_array = lambda rows: pa.array([[dict(zip(("start", "kind", "end"), s)) for s in r] for r in rows], SPANS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), as_array(base), as_array(weak)], ["_id", "_k", "base", "weak"])


def find_secrets(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: _id, _k (row key), base and spans (base and linked weak ones), arrays of (start, kind, end)."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("_id"), row_key(doc_id, text).alias("_k"), F.col(text).alias("_t"))
    found = cut(rows.mapInArrow(_scan, f"_id {kind}, _k bigint, base {SPAN_TYPE}, weak {SPAN_TYPE}"))
    some = found.where(F.size("weak") > 0).dropDuplicates(["_id", "_k"])
    weak = some.select("_id", "_k", F.explode("weak").alias("s"))
    role = F.when(F.col("s.kind").isin(1, 4), "id").when(F.col("s.kind").isin(0, 3), "key")
    parts = some.select("_id", "_k", F.explode(F.concat("base", "weak")).alias("s")).withColumn("role", role).where("role is not null")
    bins = parts.groupBy("_id", "_k", F.floor(F.col("s.start") / WINDOW).alias("bin"), "role").agg(F.min("s.start").alias("first"), F.max("s.start").alias("last"))
    bins = bins.withColumnsRenamed({"_id": "_i2", "_k": "_k2"})
    near = weak.withColumn("bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("s.start") / WINDOW) + d)))
    at = F.col("s.start")
    meet = near.join(bins.withColumnRenamed("bin", "_b2"), (F.col("_k") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_i2")) & (F.col("bin") == F.col("_b2")))
    meet = meet.where(F.least(F.abs(F.col("first") - at), F.abs(F.col("last") - at)) <= WINDOW)
    roles = meet.groupBy("_id", "_k", "s").agg(F.collect_set("role").alias("roles"))
    has = lambda r: F.array_contains("roles", r)
    linked = roles.where(F.when(F.col("s.kind") == 3, has("id")).when(F.col("s.kind") == 4, has("key")).otherwise(has("id") & has("key")))
    linked = linked.groupBy(F.col("_id").alias("_i2"), F.col("_k").alias("_k2")).agg(F.collect_list("s").alias("more"))
    out = found.join(linked, (F.col("_k") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_i2")), "left")
    return out.select("_id", "_k", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPAN_TYPE)))).alias("spans"))


def spans_text(spans):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame) -> DataFrame:
    """documents with every found span replaced by its kind in angle brackets; n_chars follows."""
    found = find_secrets(documents).where(F.size("spans") > 0).dropDuplicates(["_id", "_k"]).select("_id", "_k", "spans")
    rows, (_, _, spans) = match_rows(documents, found, "left")
    (new,) = free_names(rows, "_new")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = F.col("text")

    def step(done, s):
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.when(s["start"] >= done["at"], F.concat(gap, F.lit("<"), F.get(kinds, s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return named(at=F.greatest(done["at"], s["end"]), out=F.concat(done["out"], mark))

    masked = F.aggregate(spans, named(at=F.lit(0), out=F.lit("")), step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    rows = rows.withColumn(new, F.when(F.col(spans).isNull(), text).otherwise(masked))
    length = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(new)) if "n_chars" in documents.columns else None
    return rows.select(*[F.col(new).alias("text") if c == "text" else length.alias(c) if c == "n_chars" else F.col(c) for c in documents.columns])


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return found.select(
        F.col("_id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans")
    )


#: Places of matches come from the lengths of what lies between them.
ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
k AS (SELECT * FROM (VALUES
 (0, 'assign', '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', '^[^:=]*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]{12,}$', ':|='),
 (1, 'access', 'AKIA[A-Z0-9]+', '^.{18,}$', 'AKIA'), (2, 'hex', '[0-9a-f]{16,}', '^', '[0-9a-f]{16}'),
 (3, 'weak_key', '[A-Za-z0-9+/=]+', '^[A-Za-z0-9+/]{40}$', '[A-Za-z0-9+/]{40}'), (4, 'weak_id', '[A-Za-z0-9]+', '^(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}$', 'ASIA|AROA|AIDA'), (5, 'endpoint', 'https?://[^\s"''<>]+', '^', '://')) AS v(kind, name, pattern, keep, need)),
m AS (SELECT rid, kind, name, keep, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS gaps FROM t, k WHERE regexp_matches(text, need)),
u AS (SELECT rid, kind, name, keep, unnest(found) AS s, unnest(list_slice(gaps, 1, len(found))) AS gap, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0),
a AS (SELECT rid, kind, name, keep, s, sum(length(gap) + length(s)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM u),
c AS (SELECT rid, kind, name, (stop - length(s))::BIGINT AS start, stop::BIGINT AS stop FROM a WHERE regexp_matches(s, keep) AND (kind <> 3 OR (regexp_matches(s, '[A-Z]') AND regexp_matches(s, '[a-z]') AND regexp_matches(s, '[0-9]')))),
l AS (SELECT w.rid, w.kind, w.name, w.start, w.stop, bool_or(p.kind IN (1, 4)) AS id, bool_or(p.kind IN (0, 3)) AS key FROM c w JOIN c p ON w.rid = p.rid AND p.kind <= 4 AND p.kind <> 2 AND abs(w.start - p.start) <= 400 WHERE w.kind >= 3 GROUP BY ALL),
o AS (SELECT * FROM c WHERE kind < 3 UNION ALL SELECT rid, kind, name, start, stop FROM l WHERE CASE kind WHEN 3 THEN id WHEN 4 THEN key ELSE id AND key END),
g AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
  string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base, string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans FROM o GROUP BY rid)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (rid)
"""
