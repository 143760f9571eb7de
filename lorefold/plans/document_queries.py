"""Queries over documents, pages, benchmark, labels and conversations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import atoms as A
from ..operators import documents as D
from ..operators import edits as E
from ..operators import scoring as S
from ..operators.graph import numbered
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


REDACT_SQL = [
    ("sk-[A-Za-z0-9]{32,}", "<REDACTED_API_KEY>"),
    (r"(?i)((?:api[_-]?key|apikey|secret|token|password)[ \t\r\n\f]*)[:=][ \t\r\n\f]*[\"'']?[^\"''& \t\r\n\f]+", r"\1=<REDACTED>"),
    (r"(?:Bearer|Basic)[ \t\r\n\f]+[A-Za-z0-9+/=_-]{20,}", "<REDACTED_AUTH>"),
    (r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]+", "<REDACTED_EMAIL>"),
    (r"(?i)(?:jdbc|mysql|postgresql|mongodb)://[^ \t\r\n\f\"'']+", "<REDACTED_DB_URL>"),
]


def redact_sql(column: str) -> tuple[str, str]:
    """Nested replacements and the sum of matches, in DuckDB's terms."""
    text, counts = column, []
    for pattern, put in REDACT_SQL:
        counts.append(f"len(regexp_extract_all({text}, '{pattern}'))")
        text = f"regexp_replace({text}, '{pattern}', '{put}', 'g')"
    return text, " + ".join(counts)


STRIP_SQL = r"regexp_replace({}, '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g')"
COLLAPSE_SQL = r"trim(regexp_replace({}, '[ \t\r\n\f\v]+', ' ', 'g'), ' ')"
CLEAN_SQL = STRIP_SQL.format(r"regexp_replace(replace({}, chr(12288), ' '), '\n{{3,}}', E'\n\n', 'g')")
TYPE_SQL = """CASE
 WHEN contains({0}, '步骤') OR contains({0}, '流程') OR contains(left({0}, 10), '先') OR contains(left(lower({0}), 20), 'step') THEN 'procedure'
 WHEN contains({0}, '不得') OR contains({0}, '禁止') OR contains({0}, '严禁') OR contains(lower({0}), 'must not') THEN 'constraint'
 WHEN contains({0}, '错误码') OR contains(lower({0}), 'error code') THEN 'error_code'
 WHEN contains({0}, '常见问题') OR contains(left(lower({0}), 5), 'q:') OR contains(left(lower({0}), 5), 'a:') THEN 'faq'
 WHEN contains(left(lower({0}), 5), 'api') OR contains(left(lower({0}), 10), 'endpoint') OR contains(left(lower({0}), 5), 'request') OR contains(left(lower({0}), 5), 'response') THEN 'api_contract'
 WHEN contains({0}, '```') OR contains(left({0}, 10), 'class ') OR contains(left({0}, 10), 'def ') OR contains(left({0}, 10), 'function ') THEN 'example'
 ELSE 'concept' END"""


@query(f"SELECT doc_id, {redact_sql('text')[1]} AS redactions, sha256({redact_sql('text')[0]}) AS redacted_hash FROM documents")
def doc_redact_counts(spark, sf_dir):
    """Redacted text and number of substitutions by one fold over the rules."""
    rows = read(spark, sf_dir, "documents").select("doc_id", T.redacted(F.col("text")).alias("r"))
    return rows.select("doc_id", F.col("r.n").cast("bigint").alias("redactions"), F.sha2("r.text", 256).alias("redacted_hash"))


@query(
    f"""WITH c AS (SELECT lang, {CLEAN_SQL.format(redact_sql('text')[0])} AS t FROM documents),
    l AS (SELECT lang, {STRIP_SQL.format("unnest(string_split(t, chr(10)))")} AS line FROM c)
    SELECT lang, {TYPE_SQL.format("line")} AS content_type, count(*) AS blocks, avg((length(line) // 4)::DOUBLE) AS mean_tokens FROM l WHERE line <> '' GROUP BY ALL"""
)
def doc_content_type_profile(spark, sf_dir):
    """Redact and clean each document, take its lines as blocks, and profile their content types."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", T.clean(T.redact(F.col("text"))).alias("text"))
    lines = docs.select("lang", F.explode(F.split("text", "\n")).alias("line")).select("lang", T.strip(F.col("line")).alias("line")).where("line <> ''")
    return lines.groupBy("lang", T.content_type(F.col("line")).alias("content_type")).agg(F.count("*").alias("blocks"), F.avg(T.token_estimate(F.col("line")).cast("double")).alias("mean_tokens"))


@query(
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
    SELECT doc_id, pos::INTEGER AS pos, sha256({STRIP_SQL.format("line")}) AS line_hash FROM l WHERE {STRIP_SQL.format("line")} <> ''"""
)
def doc_clean_lines(spark, sf_dir):
    return D.text_blocks(read(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"), "pos", F.sha2("text", 256).alias("line_hash"))


#: Markdown made of a document's lines by their place: headings of three levels, table rows and rulers, lists, fenced code.
MARKED_SQL = """array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE (i - 1) % 11 WHEN 0 THEN repeat('#', ((i - 1) // 11 % 3 + 1)::INTEGER) || ' ' || left(x, 30) WHEN 1 THEN '| ' || left(x, 9) || ' | b |' WHEN 2 THEN '|---|---|'
  WHEN 3 THEN '| c | ' || length(x) || ' |' WHEN 4 THEN '- ' || x WHEN 5 THEN '2. ' || left(x, 50) WHEN 6 THEN '```' WHEN 7 THEN '# in code' WHEN 8 THEN '```java' ELSE x END), chr(10))"""


def marked(text):
    first, lines = lambda x, n: F.substring(x, 1, n), F.split(text, "\n")

    def line(x, i):
        level = F.repeat(F.lit("#"), (F.floor(i / 11) % 3 + 1).cast("int"))
        out = F.when(i % 11 == 0, F.concat(level, F.lit(" "), first(x, 30))).when(i % 11 == 1, F.concat(F.lit("| "), first(x, 9), F.lit(" | b |"))).when(i % 11 == 2, F.lit("|---|---|"))
        out = out.when(i % 11 == 3, F.concat(F.lit("| c | "), F.length(x).cast("string"), F.lit(" |"))).when(i % 11 == 4, F.concat(F.lit("- "), x)).when(i % 11 == 5, F.concat(F.lit("2. "), first(x, 50)))
        return out.when(i % 11 == 6, "```").when(i % 11 == 7, "# in code").when(i % 11 == 8, "```java").otherwise(x)

    return F.array_join(F.transform(lines, line), "\n")


def marked_blocks(spark, sf_dir):
    return D.markdown_blocks(read(spark, sf_dir, "documents").select("doc_id", marked(F.col("text")).alias("text")), "doc_id", "text")


BLOCKS_SQL = f"""l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS pos FROM (SELECT doc_id, {MARKED_SQL} AS t FROM documents)),
    f AS (SELECT *, starts_with(line, '```') AS fence, sum(starts_with(line, '```')::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM l),
    o AS (SELECT doc_id, pos, line, CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN 'heading' WHEN starts_with({STRIP_SQL.format("line")}, '|') THEN 'table_row'
      WHEN regexp_matches({STRIP_SQL.format("line")}, '^([-*+]|[0-9]+\\.) ') THEN 'list_item' WHEN {STRIP_SQL.format("line")} <> '' THEN 'paragraph' END AS type FROM f WHERE nth % 2 = 0 AND NOT fence)"""


@query(
    f"""WITH {BLOCKS_SQL}, c AS (SELECT doc_id, 'code' AS type FROM f WHERE fence AND nth % 2 = 0)
    SELECT type, count(*) AS blocks, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, type FROM o UNION ALL SELECT * FROM c) WHERE type IS NOT NULL GROUP BY type"""
)
def doc_blocks_markdown(spark, sf_dir):
    return marked_blocks(spark, sf_dir).groupBy("type").agg(F.count("*").alias("blocks"), F.countDistinct("doc").alias("docs"))


@query(
    f"""WITH {BLOCKS_SQL}, h AS (SELECT doc_id, pos, length(regexp_extract(line, '^(#+)', 1)) AS level, {STRIP_SQL.format("regexp_replace(line, '^#+ ', '')")} AS title FROM o WHERE type = 'heading')
    SELECT h.doc_id, h.pos::INTEGER AS pos, h.level::INTEGER AS level, h.title, max(p.pos)::INTEGER AS parent FROM h LEFT JOIN h p ON p.doc_id = h.doc_id AND p.pos < h.pos AND p.level < h.level GROUP BY ALL"""
)
def doc_heading_tree(spark, sf_dir):
    """Sections of marked-up documents with the nearest heading of a lower level before each."""
    return D.heading_tree(marked_blocks(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


@query(
    f"""WITH {BLOCKS_SQL}, r AS (SELECT doc_id, pos, line, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM o WHERE type = 'table_row'),
    k AS (SELECT doc_id, run, pos, list_transform(string_split(regexp_replace({STRIP_SQL.format("line")}, '^\\||\\|$', '', 'g'), '|'), lambda x: trim(x)) AS cells FROM r WHERE NOT regexp_matches(line, '^[|\\s:-]+$'))
    SELECT doc_id, min(pos)::INTEGER AS first, array_to_string(arg_min(cells, pos), '/') AS columns, (count(*) - 1)::BIGINT AS n_rows, string_agg(array_to_string(cells, '/'), ';' ORDER BY pos) AS whole FROM k GROUP BY doc_id, run"""
)
def doc_tables(spark, sf_dir):
    """Neighbouring table rows as tables: first row as columns, rulers left out."""
    t = D.tables(marked_blocks(spark, sf_dir))
    whole = F.array_join(F.transform(F.concat(F.array("columns"), "rows"), lambda r: F.array_join(r, "/")), ";")
    return t.select(F.col("doc").alias("doc_id"), "first", F.array_join("columns", "/").alias("columns"), F.size("rows").cast("bigint").alias("n_rows"), whole.alias("whole"))


@query(
    f"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    s AS (SELECT doc_id, length({STRIP_SQL.format("line")}) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l WHERE {STRIP_SQL.format("line")} <> ''),
    r AS (SELECT doc_id, i, 1 AS chunk, (n + 1)::BIGINT AS chars FROM s WHERE i = 1
      UNION ALL SELECT s.doc_id, s.i, CASE WHEN r.chars // 4 + s.n // 4 > 120 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.chars // 4 + s.n // 4 > 120 THEN s.n + 1 ELSE r.chars + s.n + 1 END
      FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i + 1)
    SELECT doc_id, chunk::INTEGER AS chunk, (max(chars) // 4)::BIGINT AS token_estimate FROM r GROUP BY doc_id, chunk"""
)
def doc_chunk_pack(spark, sf_dir):
    """Greedy packing of lines into chunks of 120 estimated tokens, as a fold inside each row."""
    return D.chunk_text(read(spark, sf_dir, "documents"), "doc_id", "text", 120).select(F.col("doc").alias("doc_id"), "chunk", "token_estimate")


@query(f"""SELECT left(sha256({COLLAPSE_SQL.format("text")}), 12) AS semantic_hash, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1""")
def doc_exact_dedup(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(T.semantic_hash(F.col("text")).alias("semantic_hash")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))


@query(
    """SELECT min(doc_id) AS atom_id, arg_min(lang, doc_id) AS kind, max(n_chars)::DOUBLE AS confidence, count(*) AS merged, array_to_string(list_sort(list(DISTINCT source)), ',') AS refs
    FROM documents GROUP BY left(text, 80)"""
)
def doc_prefix_merge(spark, sf_dir):
    """Rows as records: those that begin alike merge, sources join, the largest size stays as confidence."""
    refs = F.array(F.struct(F.lit("doc").alias("type"), F.col("source").alias("id"), F.lit("").alias("authority")))
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("atom_id"), F.col("lang").alias("kind"), F.col("text").alias("claim"), refs.alias("source_refs"), F.col("n_chars").cast("double").alias("confidence"))
    return A.merge_by_prefix(rows).select("atom_id", "kind", "confidence", "merged", F.array_join(F.transform("source_refs", lambda r: r["id"]), ",").alias("refs"))


@query(
    f"""WITH l AS (SELECT doc_id, lower({COLLAPSE_SQL.format("unnest(string_split(text, chr(10)))")}) AS line FROM documents)
    SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS repeated FROM l WHERE line <> '' GROUP BY doc_id"""
)
def doc_repeated_lines(spark, sf_dir):
    """Repeated lines of each document, counted inside the row."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: T.text_key(x)), lambda x: x != "")
    out = read(spark, sf_dir, "documents").select("doc_id", lines.alias("ls")).where(F.size("ls") > 0)
    return out.select("doc_id", F.size("ls").cast("bigint").alias("lines"), (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("repeated"))


@query(
    """WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{9,}'))) AS ts FROM documents),
    t AS (SELECT r, doc_id, lang, unnest(ts) AS t FROM d WHERE len(ts) >= 8)
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM t a JOIN t b ON a.lang = b.lang AND a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.r, b.r, a.doc_id, b.doc_id HAVING count(*) >= 8"""
)
def doc_near_dup_pairs(spark, sf_dir):
    """All pairs of documents of a language that share 8 or more long words, copies too."""
    words = F.array_remove(F.regexp_extract_all(F.lower("text"), F.lit(r"([a-z]{9,}+)(?![\p{L}\p{N}_])|[\p{L}\p{N}_]++"), F.lit(1)), "")  # all words in turn: looking behind halves letters beyond 16 bits
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", words.alias("ts"))
    return A.item_pairs(docs, "doc_id", "lang", "ts", least=8)


@query(
    """WITH RECURSIVE d AS (SELECT conv_id * 1000 + turn AS k, role AS g, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{5,}')))) AS ts FROM conversations),
    o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k) AS i FROM d),
    r AS (SELECT g, i, k, k AS leader, [{'k': k, 'ts': ts}] AS leaders FROM o WHERE i = 1
      UNION ALL SELECT o.g, o.i, o.k, coalesce(f.k, o.k), CASE WHEN f.k IS NULL THEN list_append(leaders, {'k': o.k, 'ts': o.ts}) ELSE leaders END
      FROM r JOIN o ON o.g = r.g AND o.i = r.i + 1, LATERAL (SELECT list_min(list_transform(list_filter(leaders, lambda l: len(list_intersect(l.ts, o.ts)) >= 4), lambda l: l.k)) AS k) f)
    SELECT k AS key, leader FROM r"""
)
def doc_align_greedy(spark, sf_dir):
    """Turns as records of their role: each joins the first leader with 4 long words or more in common."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: w.rlike("^[a-z]{5,}$"))
    turns = read(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("k"), "role", words.alias("ts"))
    return A.align_greedy(turns, "k", "role", "ts", least=4)


@query(f"""SELECT page_id, sha256({COLLAPSE_SQL.format("regexp_replace(html, '<[^>]+>', ' ', 'g')")}) AS text_hash FROM pages""")
def page_html_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.sha2(D.html_text(F.col("html")), 256).alias("text_hash"))


@query(
    """SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
    regexp_extract(url, '\\?([^#]*)', 1) AS query FROM pages"""
)
def page_url_parts(spark, sf_dir):
    part = lambda p: F.regexp_extract("url", p, 1)
    return read(spark, sf_dir, "pages").select(
        "page_id", part("^([a-z]+)://").alias("scheme"), part("^[a-z]+://([^/?#]+)").alias("host"), part("^[a-z]+://[^/?#]+([^?#]*)").alias("path"), part(r"\?([^#]*)").alias("query")
    )


@query(
    """WITH k AS (SELECT p.page_id, CASE WHEN regexp_matches(lower(url), 'test|spec|__test__') THEN 'test' WHEN regexp_extract(lower(url), '\\.([a-z0-9]+)$', 1) IN ('html', 'txt', 'md') THEN 'doc' ELSE 'source' END AS kind FROM pages p)
    SELECT kind, count(*) AS pages FROM k GROUP BY kind"""
)
def page_role(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.lower("url").alias("url"))
    kind = F.when(F.col("url").rlike("test|spec|__test__"), "test").when(SRC.ending(F.col("url")).isin("html", "txt", "md"), "doc").otherwise("source")
    return pages.groupBy(kind.alias("kind")).agg(F.count("*").alias("pages"))


@query(
    """WITH i AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS place, count(*) OVER () AS items, list_distinct(list_filter(string_split(lower(replace(text, ',', '')), ' '), lambda w: regexp_full_match(w, '[a-z]{8,}'))) AS checks FROM benchmark),
    d AS (SELECT doc_id, lower(replace(text, ',', '')) AS a, len(list_filter(string_split(trim(regexp_replace(text, '[ \\t\\r\\n\\f\\v]+', ' ', 'g'), ' '), ' '), lambda w: w <> '')) AS words FROM documents),
    p AS (SELECT doc_id, words, checks, len(list_filter(checks, lambda c: contains(a, c))) AS n, greatest(len(checks), 1) AS total FROM d JOIN i ON doc_id % items = place),
    q AS (SELECT *, n / total AS soft, n / greatest(words, 1) AS prec FROM p)
    SELECT doc_id, n AS passed, (n = total)::INTEGER AS hard, round_even(soft, 3) AS soft, round_even(prec, 3) AS prec, round_even(CASE WHEN prec + soft > 0 THEN 2 * prec * soft / (prec + soft) ELSE 0 END, 3) AS f1 FROM q"""
)
def bench_keyword_score(spark, sf_dir):
    """Every document as the answer to one item, dealt over all there are: its long words as expected checks."""
    words = F.filter(F.split(F.lower(F.replace("text", F.lit(","), F.lit(""))), " "), lambda w: w.rlike("^[a-z]{8,}$"))
    bench = read(spark, sf_dir, "benchmark")
    n = bench.count()
    items = numbered(bench, "item_id", name="place").select("place", F.array_distinct(words).alias("checks"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % F.lit(max(1, n))).alias("place"))
    scored = S.keyword_score(docs.join(items, "place"), "text", "checks")
    return scored.select("doc_id", F.size("passed_checks").cast("bigint").alias("passed"), "hard", "soft", F.col("precision").alias("prec"), "f1")


@query(
    """WITH k AS (SELECT item_id, text AS whole, left(text, 60) AS part FROM benchmark) SELECT k.item_id, count(*) AS docs, count(*) FILTER (contains(d.text, k.whole)) AS whole_docs
    FROM documents d JOIN k ON contains(d.text, k.part) GROUP BY k.item_id"""
)
def bench_leakage_scan(spark, sf_dir):
    """Documents that contain the first 60 characters, or the whole, of a benchmark item."""
    items = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("whole"), F.substring("text", 1, 60).alias("part"))
    met = S.contained(read(spark, sf_dir, "documents").select("text"), "text", items, "part")
    return met.groupBy("item_id").agg(F.count("*").alias("docs"), F.count_if(F.col("text").contains(F.col("whole"))).alias("whole_docs"))


@query(
    """WITH j AS (SELECT lang, quality AS hard, 1 - toxic * 0.5 AS soft FROM labels JOIN documents USING (doc_id))
    SELECT lang, count(*) AS items, round_even(avg(hard), 3) AS hard, round_even(avg(soft), 3) AS soft, round_even(0.7 * avg(hard) + 0.3 * avg(soft), 3) AS mixed FROM j GROUP BY lang"""
)
def label_gate_metrics(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = read(spark, sf_dir, "labels").join(docs, "doc_id").select("lang", F.col("quality").alias("hard"), (1 - F.col("toxic") * 0.5).cast("double").alias("soft"))
    out = rows.groupBy("lang").agg(F.count("*").alias("items"), F.avg("hard").alias("h"), F.avg("soft").alias("s"))
    return out.select("lang", "items", F.bround("h", 3).alias("hard"), F.bround("s", 3).alias("soft"), F.bround(S.gate_score(F.col("h"), F.col("s"), "mixed", 0.3), 3).alias("mixed"))


@query(
    """WITH s AS (SELECT source, count(*) AS atoms, avg((quality = 1)::INT) AS accepted_rate, avg(toxic) AS toxic_rate FROM labels JOIN documents USING (doc_id) GROUP BY source)
    SELECT source, atoms, round_even(accepted_rate, 4) AS accepted_rate, round_even(toxic_rate, 4) AS toxic_rate,
    array_to_string(list_filter([CASE WHEN accepted_rate < 0.7 THEN 'accepted_rate' END, CASE WHEN toxic_rate > 0.12 THEN 'toxic_rate' END], lambda x: x IS NOT NULL), ',') AS failures FROM s"""
)
def label_artifact_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    rows = read(spark, sf_dir, "labels").join(docs, "doc_id").groupBy("source").agg(F.count("*").alias("atoms"), F.avg((F.col("quality") == 1).cast("int")).alias("a"), F.avg("toxic").alias("t"))
    failed = F.concat_ws(",", F.when(F.col("a") < 0.7, "accepted_rate"), F.when(F.col("t") > 0.12, "toxic_rate"))
    return rows.select("source", "atoms", F.bround("a", 4).alias("accepted_rate"), F.bround("t", 4).alias("toxic_rate"), failed.alias("failures"))


@query(
    """SELECT conv_id, turn, role, coalesce(lag(role) OVER w, '') AS before, coalesce(length(lag(text) OVER w), 0)::BIGINT AS before_chars,
    sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS chars_so_far FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
)
def conv_turn_context(spark, sf_dir):
    """Each turn with the one before it and the characters so far."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", F.coalesce(F.lag("role").over(w), F.lit("")).alias("before"), F.coalesce(F.length(F.lag("text").over(w)), F.lit(0)).cast("bigint").alias("before_chars"), F.sum(F.length("text").cast("bigint")).over(w).alias("chars_so_far"))


CONV_PATTERNS = (r"(?m)^(The|La|El|Der|Die|Das) ", r"[0-9]{3,}", r"(?i)\bla la\b|(?i)the the")


@query(
    """SELECT role, count(*) AS turns, count(*) FILTER (NOT regexp_matches(text, '(?m)^(The|La|El|Der|Die|Das) ') AND NOT regexp_matches(text, '[0-9]{3,}')) AS clean,
    count(*) FILTER (regexp_matches(text, '(?m)^(The|La|El|Der|Die|Das) ')) AS article_first, count(*) FILTER (regexp_matches(text, '[0-9]{3,}')) AS numbers FROM conversations GROUP BY role"""
)
def conv_hygiene(spark, sf_dir):
    """Turns that match patterns which do occur here, counted as the answer hygiene report counts them."""
    found = S.detect_echo(F.col("text"), CONV_PATTERNS[:2])
    rows = read(spark, sf_dir, "conversations").select("role", found.alias("h"))
    has = lambda p: F.count_if(F.array_contains("h.matched", p))
    return rows.groupBy("role").agg(F.count("*").alias("turns"), F.count_if("h.clean").alias("clean"), has(CONV_PATTERNS[0]).alias("article_first"), has(CONV_PATTERNS[1]).alias("numbers"))


@query("SELECT 'both' AS part, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'documents', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'labels', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def split_overlap(spark, sf_dir):
    """Ids in both tables or one, by one full join."""
    a = read(spark, sf_dir, "documents").select("doc_id").distinct().withColumn("a", F.lit(True))
    b = read(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("b", F.lit(True))
    j = a.join(b, "doc_id", "full").agg(*[F.count_if(c).alias(n) for n, c in (("both", F.col("a") & F.col("b")), ("documents", F.col("b").isNull()), ("labels", F.col("a").isNull()))])
    return j.select(F.expr("stack(3, 'both', both, 'documents', documents, 'labels', labels) AS (part, n)"))


@query(
    """SELECT lang, avg(len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{4,}')))))::DOUBLE AS mean_words, max(length(text) // 4)::BIGINT AS most_tokens FROM documents GROUP BY lang"""
)
def doc_token_profile(spark, sf_dir):
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: w.rlike("^[a-z]{4,}$")))
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.avg(F.size(words)).alias("mean_words"), F.max(T.token_estimate(F.col("text"))).alias("most_tokens"))


@query(
    r"""SELECT item_id, substring(text, 1, 40) AS head, rule_slug, 'sha256:' || sha256(c) AS rejected_hash, left(sha256(lower(c)), 16) AS fingerprint FROM (
    SELECT item_id, text, trim(regexp_replace(text, '[ \t\r\n\f\v]+', ' ', 'g'), ' ') AS c, left(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 40) AS rule_slug FROM benchmark)"""
)
def bench_fingerprints(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "benchmark").select("item_id", F.substring(t, 1, 40).alias("head"), T.rule_slug(t).alias("rule_slug"), T.rejected_hash(t).alias("rejected_hash"), T.fingerprint(t).alias("fingerprint"))


@query(
    r"""WITH e AS (SELECT conv_id, turn, text, ['append', 'insert_after', 'replace', 'delete'][(turn % 4 + 1)::INT] AS op, string_split(text, ' ')[2] AS target, '- must check ' || role AS content FROM conversations),
    p AS (SELECT *, position(coalesce(target, '') IN text) AS k, coalesce(target, '') <> '' AS has FROM e)
    SELECT conv_id, turn, op, sha256(CASE WHEN op = 'append' OR (op = 'insert_after' AND NOT has) THEN regexp_replace(text, '\n+$', '') || chr(10) || content
      WHEN op = 'insert_after' THEN left(text, k - 1) || target || chr(10) || content || substring(text, k + length(target))
      WHEN op = 'replace' AND has THEN left(text, k - 1) || content || substring(text, k + length(target)) WHEN op = 'delete' AND has THEN left(text, k - 1) || substring(text, k + length(target)) ELSE text END) AS edited FROM p"""
)
def conv_edit_apply(spark, sf_dir):
    """One edit of each turn's text: append, insert after, replace or delete its second word."""
    op = F.element_at(F.array(*[F.lit(x) for x in ("append", "insert_after", "replace", "delete")]), (F.col("turn") % 4 + 1).cast("int"))
    e = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text", op.alias("op"), F.get(F.split("text", " "), F.lit(1)).alias("target"), F.concat(F.lit("- must check "), "role").alias("content"))
    return e.select("conv_id", "turn", "op", F.sha2(E.apply_edit(F.col("text"), F.col("op"), F.col("target"), F.col("content")), 256).alias("edited"))


@query(
    r"""SELECT conv_id, count(*) AS edits, count(*) FILTER (length(trim(text)) < 40) AS short, count(DISTINCT CASE role WHEN 'user' THEN 'append' ELSE 'replace' END || ':' || lower(trim(regexp_replace(left(text, 100), '[ \t\r\n\f\v]+', ' ', 'g'), ' '))) AS fingerprints FROM conversations GROUP BY conv_id"""
)
def conv_edit_fingerprints(spark, sf_dir):
    """Distinct edits of each conversation by operation and beginning."""
    op = F.when(F.col("role") == "user", "append").otherwise("replace")
    c = read(spark, sf_dir, "conversations").select("conv_id", "text", T.edit_fingerprint(op, F.col("text")).alias("f"))
    return c.groupBy("conv_id").agg(F.count("*").alias("edits"), F.count_if(F.length(F.trim("text")) < 40).alias("short"), F.count_distinct("f").alias("fingerprints"))
