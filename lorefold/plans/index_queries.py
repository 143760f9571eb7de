"""Queries of stems, indexed search and calls in texts; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calls as C
from ..functions import stems as S
from ..functions import text as T
from ..operators import index as X
from ..operators.graph import cut
from .text_queries import read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Stems in SQL: a step a column, over distinct words


def shape(x: str) -> str:
    """y that is a vowel becomes i; a leading y is a consonant."""
    return f"regexp_replace(regexp_replace({x}, '^y', 'z'), '([^aeiouy])y', '\\1i', 'g')"


def measured(x: str) -> str:
    return f"len(regexp_extract_all({shape(x)}, '[aeiou]+[^aeiou]+'))"


def voiced(x: str) -> str:
    return f"regexp_matches({shape(x)}, '[aeiou]')"


def short(x: str) -> str:
    return f"regexp_matches({shape(x)}, '[^aeiou][aeiou][^aeiouwxy]$')"


def endings(table: dict[str, str], least: int, more: str = "") -> str:
    """CASE over word endings, the longest first: without its ending the word must measure enough."""
    out = ""
    for end in sorted(table, key=len, reverse=True):
        base = f"left(w, {-len(end)})"
        ok = f"{measured(base)} > {least}" + (more.format(base=base) if end == "ion" else "")
        out += f" WHEN ends_with(w, '{end}') THEN CASE WHEN {ok} THEN {base} || '{table[end]}' ELSE w END"
    return f"CASE{out} ELSE w END"


STEP_2 = dict(zip("ational tional enci anci izer logi bli alli entli eli ousli ization ation ator alism iveness fulness ousness aliti iviti biliti".split(), "ate tion ence ance ize log ble al ent e ous ize ate ate al ive ful ous al ive ble".split()))
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = dict.fromkeys("al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(), "")


def stem_steps(words: str) -> str:
    """CTEs from words (w) to stemmed (word, stem)."""
    base = "CASE WHEN ends_with(w, 'ed') THEN left(w, -2) ELSE left(w, -3) END"
    steps = [
        "CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, -2) WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN left(w, -1) ELSE w END",
        f"CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {measured('left(w, -3)')} > 0 THEN left(w, -1) ELSE w END WHEN (ends_with(w, 'ed') OR ends_with(w, 'ing')) AND {voiced(base)} THEN '+' || {base} ELSE w END",
        f"""CASE WHEN NOT starts_with(w, '+') THEN w WHEN regexp_matches(w, '(at|bl|iz)$') OR ({measured('substr(w, 2)')} = 1 AND {short('substr(w, 2)')}) THEN substr(w, 2) || 'e'
          WHEN len(w) > 2 AND right(w, 1) = left(right(w, 2), 1) AND regexp_matches(w, '[^aeioulsz]$') THEN substr(left(w, -1), 2) ELSE substr(w, 2) END""",
        f"CASE WHEN ends_with(w, 'y') AND {voiced('left(w, -1)')} THEN left(w, -1) || 'i' ELSE w END",
        endings(STEP_2, 0), endings(STEP_3, 0), endings(STEP_4, 1, " AND regexp_matches({base}, '[st]$')"),
        f"CASE WHEN ends_with(w, 'e') AND ({measured('left(w, -1)')} > 1 OR ({measured('left(w, -1)')} = 1 AND NOT {short('left(w, -1)')})) THEN left(w, -1) ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND {measured('left(w, -1)')} > 1 THEN left(w, -1) ELSE w END",
    ]
    out, last = [f"st0 AS (SELECT DISTINCT w AS word, w FROM {words})"], 0
    for i, step in enumerate(steps):
        out.append(f"st{i + 1} AS MATERIALIZED (SELECT word, CASE WHEN len(word) BETWEEN 3 AND 64 THEN {step} ELSE w END AS w FROM st{i})")
        last = i + 1
    return ", ".join([*out, f"stemmed AS MATERIALIZED (SELECT word, w AS stem FROM st{last})"])


TOKENS = r"regexp_extract_all(strip_accents(lower({})), '[\p{{L}}\p{{N}}]+')"


@query(f"WITH a AS (SELECT unnest({TOKENS.format('text')}) AS w FROM documents), {stem_steps('a')} SELECT word, stem FROM stemmed")
def index_stems(spark, sf_dir):
    """Every word of the documents with its stem."""
    words = read(spark, sf_dir, "documents").select(F.explode(S.words(F.col("text"))).alias("word")).distinct()
    return words.select("word", F.get(S.stems(F.array("word")), F.lit(0)).alias("stem"))


def text_nodes(spark, sf_dir):
    """Documents as nodes: their first and last letters as names, language and source as path."""
    d = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "lang", "source", F.concat(s(F.col("doc_id")), F.lit(".txt")))
    return d.select(F.col("doc_id").alias("id"), F.substring("text", 1, 80).alias("name"), F.col("lang").alias("kind"), path.alias("file_path"), F.substring("text", -60, 60).alias("qualified_name"))


NODES = "n AS (SELECT doc_id AS id, text[1:80] AS name, lang AS kind, concat_ws('/', lang, source, doc_id || '.txt') AS path, right(text, 60) AS q3 FROM documents)"
FIELDS = "f AS (SELECT id, 0 AS field, name AS t FROM n UNION ALL SELECT id, 1, path FROM n UNION ALL SELECT id, 2, q3 FROM n)"
TERMS = r"list_sort(list_distinct(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Z][a-z0-9]+(?:[A-Z][a-z0-9]*)+|[a-z][a-z0-9]*(?:_[a-z0-9]+)+|[A-Z]{2,}[A-Z0-9]*|[A-Za-z][A-Za-z0-9]{2,}'))))[1:12]"


def search_sql(asked: str, limit: int) -> str:
    """asked: a CTE a(query_id, text, q, kinds): what is typed, its plain part and its kinds."""
    return f"""WITH {NODES}, {FIELDS}, {asked},
    ft AS MATERIALIZED (SELECT id, field, t, {TOKENS.format("coalesce(t, '')")} AS ws FROM f),
    tt AS MATERIALIZED (SELECT query_id, k, {TOKENS.format('term')} AS ws FROM (SELECT query_id, unnest(string_split(q, ' ')) AS term, generate_subscripts(string_split(q, ' '), 1) AS k FROM a)),
    every AS (SELECT unnest(ws) AS w FROM ft UNION ALL SELECT unnest(ws) FROM tt), {stem_steps('every')},
    fs AS MATERIALIZED (SELECT id, field, ' ' || string_agg(stem, ' ' ORDER BY i) || ' ' AS line FROM (SELECT id, field, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM ft) JOIN stemmed USING (word) GROUP BY id, field),
    qs AS MATERIALIZED (SELECT query_id, k, ' ' || string_agg(stem, ' ' ORDER BY i) || ' ' AS part FROM (SELECT query_id, k, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM tt) JOIN stemmed USING (word) GROUP BY query_id, k),
    hit AS (SELECT query_id, id, 1.0::DOUBLE AS score FROM qs JOIN fs ON contains(line, part) UNION ALL SELECT query_id, id, 0.6 FROM a JOIN ft ON q <> '' AND t ILIKE '%' || q || '%'),
    best AS (SELECT query_id, id, max(score) AS score, 0 AS late FROM hit JOIN a USING (query_id) JOIN n USING (id) WHERE len(kinds) = 0 OR list_contains(kinds, kind) GROUP BY query_id, id),
    near AS (SELECT DISTINCT query_id, id, 0.5::DOUBLE AS score, 1 AS late FROM (SELECT query_id, unnest({TERMS}) AS term FROM a) JOIN n ON contains(lower(name), lower(term))
      WHERE query_id NOT IN (SELECT query_id FROM best GROUP BY query_id HAVING count(*) >= {limit}) AND (query_id, id) NOT IN (SELECT (query_id, id) FROM best)),
    r AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY late, score DESC, id)::INTEGER AS rank FROM (SELECT * FROM best UNION ALL SELECT * FROM near))
    SELECT query_id, id, score, rank FROM r WHERE rank <= {limit}"""


@query(search_sql(r"a AS (SELECT item_id AS query_id, array_to_string(string_split(trim(text), ' ')[1:3], ' ') || CASE WHEN item_id % 2 = 0 THEN ' kind:fr,en' ELSE '' END AS text, trim(regexp_replace(array_to_string(string_split(trim(text), ' ')[1:3], ' '), '\s+', ' ', 'g')) AS q, CASE WHEN item_id % 2 = 0 THEN ['fr', 'en'] ELSE [] END AS kinds FROM benchmark)", 12))
def index_search(spark, sf_dir):
    """Documents for the first words of every benchmark item, some by language: whole words by stem, parts, then names that hold a term."""
    nodes = text_nodes(spark, sf_dir)
    first = F.array_join(F.slice(F.split(F.trim("text"), " "), 1, 3), " ")
    asked = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.concat(first, F.when(F.col("item_id") % 2 == 0, " kind:fr,en").otherwise("")).alias("text"))
    return X.search(asked, nodes, cut(X.postings(nodes)), X.grams(nodes), 12)


CLAIM = r"array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]{3,}')[1:6], ' ')"


@query(search_sql(f"a AS (SELECT DISTINCT ON (conv_id) conv_id AS query_id, {CLAIM} AS text, {CLAIM} AS q, []::VARCHAR[] AS kinds FROM conversations ORDER BY conv_id, turn)", 5).replace("SELECT query_id, id, score, rank FROM", "SELECT query_id AS claim_id, id, score, rank FROM"))
def index_supporting(spark, sf_dir):
    """Documents that speak of what every conversation begins with."""
    nodes = text_nodes(spark, sf_dir)
    claims = read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("claim_id")).agg(F.min_by("text", "turn").alias("claim"))
    return X.supporting(claims, nodes, cut(X.postings(nodes)), X.grams(nodes))


@query("SELECT conv_id, turn, len(p)::INTEGER AS parts, sha256(array_to_string(p, '|')) AS digest FROM (SELECT conv_id, turn, list_transform(CASE WHEN trim(list_last(string_split(text, ',')), chr(32) || chr(9) || chr(10) || chr(13)) = '' THEN string_split(text, ',')[1:-2] ELSE string_split(text, ',') END, lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(13))) AS p FROM conversations)")
def call_top_level(spark, sf_dir):
    """Texts split at commas outside brackets and quotes, which these texts don't have."""
    p = C.top_level(F.col("text"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", p.alias("p")).select("conv_id", "turn", F.size("p").alias("parts"), F.sha2(F.array_join("p", "|"), 256).alias("digest"))


@query(r"SELECT page_id, len(x)::INTEGER AS calls, array_to_string(x, '|') AS args FROM (SELECT page_id, regexp_extract_all(html, 'track\(([0-9]*)\)', 1) AS x FROM pages)")
def call_scripts(spark, sf_dir):
    """Calls in the scripts of web pages, and what they pass."""
    found = read(spark, sf_dir, "pages").select("page_id", C.calls(F.col("html"), ("track",)).alias("c"))
    return found.select("page_id", F.size("c").alias("calls"), F.array_join(F.transform("c", lambda x: x["text"]), "|").alias("args"))


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'debit→' || p_type || ', credit→B' || p_size WHEN 1 THEN 'debit→' || p_type WHEN 2 THEN 'credit→' || p_type || ', debit→B' || p_size ELSE 'credit amount=netAmount' || p_size END AS facts, CASE p_partkey % 4 WHEN 3 THEN 2 WHEN 1 THEN 2 ELSE 5 END::INTEGER AS n_args FROM part"""
)
def call_bookings(spark, sf_dir):
    """Booking facts of generated statements: nested calls, commas and brackets in strings, and a call that never ends."""
    p = read(spark, sf_dir, "part")
    k, kind, size = F.col("p_partkey"), F.col("p_type"), s(F.col("p_size"))
    lit = F.lit
    text = (
        F.when(k % 4 == 0, F.concat(lit('this.helper.createJournalEntriesForLoan(office, "a, (' ), F.col("p_name"), lit('", CashAccountsForLoan.'), kind, lit(".getValue(), map.get(x, AccrualAccountsForLoan.B"), size, lit("), t);")))
        .when(k % 4 == 1, F.concat(lit("createDebitJournalEntryForLoan(f(a, b)[1, 2], FinancialActivity."), kind, lit("); createCreditJournalEntryForLoan(AccountsForLoan.LOST, ')'")))
        .when(k % 4 == 2, F.concat(lit("populateCreditDebitMaps(a, {1, 2}, 'it\\'s, (', AccountsForSavings."), kind, lit(", (AccountsForShares.B"), size, lit("));")))
        .otherwise(F.concat(lit("helper . x; createCreditJournalEntryForLoanCharges ( office.of(1, 2),\n netAmount"), size, lit(" );")))
    )
    found = p.select("p_partkey", C.calls(text).alias("c"))
    return found.select(k.alias("k"), F.array_join(C.booking_facts(F.col("c")), ", ").alias("facts"), F.size(F.get("c", F.lit(0))["args"]).alias("n_args"))
