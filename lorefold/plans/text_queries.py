"""Queries of text functions, records, scores and searches over texts made from the tables; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import atoms as A
from ..operators import documents as D
from ..operators import edits as E
from ..operators import ledger as L
from ..operators import scoring as S
from ..operators import search as Q
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


def s(c):
    return c.cast("string")


def pick(c, *values):
    """The value of a list that a number points to."""
    return F.element_at(F.array(*map(F.lit, values)), (c % len(values) + 1).cast("int"))


def choose(c: str, *values: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][({c} % {len(values)} + 1)::INT]"


PHRASES = ("retry with backoff", "in one transaction", "@Scheduled job", "步骤 one", "you must not", "plain text", "Step 1: go", "审计 trail", "cron 定时", "严禁")


@query(
    f"""WITH t AS (SELECT p_partkey AS k, {choose('p_partkey', *PHRASES)} || ' ' || p_name AS t FROM part)
    SELECT k, regexp_matches(lower(t), 'retry|重试|backoff|退避|maxattempts|max_attempts') AS retry, regexp_matches(lower(t), 'transaction|事务|audit|审计|@auditable|audittrail') AS tx, regexp_matches(lower(t), '@scheduled|@quartz|scheduledtask|定时|cron|job') AS job,
      contains(t, '步骤') OR contains(left(lower(t), 50), 'step') AS steps, regexp_matches(t, '不得|禁止|严禁|必须|must not|must|@validate') AS bound FROM t"""
)
def text_patterns(spark, sf_dir):
    """Marks of retries, transactions, jobs, steps and constraints."""
    t = F.concat_ws(" ", pick(F.col("p_partkey"), *PHRASES), "p_name")
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), T.has_retry(t).alias("retry"), T.has_transaction(t).alias("tx"), T.has_job(t).alias("job"), T.has_steps(t).alias("steps"), T.has_constraint(t).alias("bound"))


REFS = ("src/a/OrderService.java#run", "src/dto/Money.java", "x/domain/Cart.java::add", "y/HandlerX.java", "z/PayProcessorImpl.java#p", "w/AppConfig.java", "q/controller/Web.java", "")


@query(
    f"""WITH t AS (SELECT p_partkey AS k, {choose('p_partkey', *REFS)} AS r FROM part)
    SELECT k, {choose('k', 'service', 'dto', 'domain', 'unknown', 'processor', 'configuration', 'handler_only', 'unknown')} AS role, {choose('k', 'src/a/OrderService.java', 'src/dto/Money.java', 'x/domain/Cart.java', 'y/HandlerX.java', 'z/PayProcessorImpl.java', 'w/AppConfig.java', 'q/controller/Web.java', '')} AS path,
      {choose('k', 'run', '', 'add', '', 'p', '', '', '')} AS symbol, k % 8 IN (1) AS matches FROM t"""
)
def text_refs(spark, sf_dir):
    """Roles, paths and symbols of references, and which end in a given path."""
    r = pick(F.col("p_partkey"), *REFS)
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), r.alias("r"), T.context_ref(r).alias("c"))
    return rows.select("k", A.role_of(F.col("r")).alias("role"), "c.path", "c.symbol", T.path_matches(F.col("c.path"), F.lit("./dto/Money.java")).alias("matches"))


@query("SELECT p_partkey AS k, p_partkey % 3 = 0 AS number, p_partkey % 3 <> 0 AND p_partkey % 3 <> 0 OR length(v) >= 5 AS searchable FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size || ',' || p_size ELSE 'w' || p_size END AS v FROM part)")
def text_checks(spark, sf_dir):
    """Which checks are numbers, and which a graph can be searched for."""
    k, n = F.col("p_partkey"), s(F.col("p_size"))
    v = F.when(k % 3 == 0, F.concat_ws(",", n, n)).otherwise(F.concat(F.lit("w"), n))
    return read(spark, sf_dir, "part").select(k.alias("k"), T.is_numeric(v).alias("number"), T.is_graph_searchable(v).alias("searchable"))


@query("SELECT p_partkey AS k, 'int x' || p_partkey || ' = load(a);|save(x, check' || p_size || '(y));' AS lines, 'load,save,check' || p_size AS calls FROM part")
def text_code_lines(spark, sf_dir):
    """Telling lines of snippets and what they call."""
    k, n = s(F.col("p_partkey")), s(F.col("p_size"))
    text = F.concat(F.lit("import a.b;\n\n  // note\n  int x"), k, F.lit(" = load(a);\n@Bean\nsave(x, check"), n, F.lit("(y));\n if (getX(z)) { }"))
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), text.alias("t"))
    lines = F.filter(T.effective_lines(F.col("t")), lambda x: ~x.startswith("if"))
    return rows.select("k", F.array_join(lines, "|").alias("lines"), F.array_join(T.method_calls(F.col("t")), ",").alias("calls"))


@query(
    """SELECT p_partkey AS k, array_to_string(list_sort(list_distinct(['orderservice', 'order', 'service', 'part', 'size', 'checks', '中文规则'])), ',') AS tokens, 'OrderService,part_size' || p_size AS names FROM part"""
)
def text_tokens(spark, sf_dir):
    """Tokens by which texts are aligned, and terms that a search starts from."""
    n = s(F.col("p_size"))
    t = F.concat(F.lit("the OrderService checks part_size"), n, F.lit(" 中文规则 of it"))
    number = F.filter(T.alignment_tokens(t), lambda x: ~x.rlike("^size[0-9]+$"))
    both = F.array_sort(F.array_distinct(F.concat(number, F.array(F.lit("size")))))
    named = F.filter(T.search_terms(t), lambda x: x.rlike("[A-Z_]"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.array_join(both, ",").alias("tokens"), F.array_join(named, ",").alias("names"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '{"a":' || p_size || '}' WHEN 1 THEN '[1,' || p_size || ']' WHEN 2 THEN '{"b":"' || p_size || '"}' END AS json FROM part""")
def text_fenced_json(spark, sf_dir):
    """JSON objects and lists of answers, fenced or not; null where nothing parses."""
    k, n = F.col("p_partkey"), s(F.col("p_size"))
    t = F.when(k % 4 == 0, F.concat(F.lit('so:\n```json\n{"a":'), n, F.lit("}\n```\nend"))).when(k % 4 == 1, F.concat(F.lit("[1,"), n, F.lit("]"))).when(k % 4 == 2, F.concat(F.lit('it is {"b":"'), n, F.lit('"} here'))).otherwise(F.lit("none {x"))
    return read(spark, sf_dir, "part").select(k.alias("k"), T.fenced_json(t).alias("json"))


@query("""SELECT event_id, '{"a":"Bearer ***REDACTED***","k":' || event_id || ',"u":["sk-***REDACTED***","x"]}' AS json, 'api_key=***REDACTED***' AS line FROM events""")
def text_redact_ledger(spark, sf_dir):
    """Ledger rows with secrets in the leaves of their JSON, and the rules on plain lines."""
    i = s(F.col("event_id"))
    json = F.concat(F.lit('{"a":"Bearer ab.c'), i, F.lit('","k":'), i, F.lit(',"u":["sk-abcdefghijklmnopqrstu'), i, F.lit('","x"]}'))
    return read(spark, sf_dir, "events").select("event_id", T.redact_leaves(json).alias("json"), T.redact(F.concat(F.lit('api_key="abcdefgh'), i, F.lit("")), T.LEDGER_REDACTIONS).alias("line"))


@query(r"SELECT event_id, left(sha256(trim('rule ' || event_id)), 16) AS skill, substring(regexp_replace('case ' || event_id || '-n' || event_id, '[^A-Za-z0-9]+', '-', 'g'), 1, 40) || '-' || left(sha1('case ' || event_id || '|n' || event_id), 8) AS fact, greatest(1, length('rule ' || event_id) // 4)::BIGINT AS tokens FROM events")
def text_hashes(spark, sf_dir):
    i = s(F.col("event_id"))
    rule = F.concat(F.lit("rule "), i)
    return read(spark, sf_dir, "events").select("event_id", T.content_hash(rule).alias("skill"), T.fact_id(F.concat(F.lit("case "), i), F.concat(F.lit("n"), i)).alias("fact"), T.token_estimate(rule, 1).alias("tokens"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS blocks, count(*) FILTER (regexp_matches(line, '[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]+')) > 0 AS mails FROM l WHERE regexp_replace(line, '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g') <> '' GROUP BY doc_id""")
def doc_normalise_blocks(spark, sf_dir):
    """Blocks redacted and cleaned; documents that held mail addresses."""
    blocks = D.text_blocks(read(spark, sf_dir, "documents"), "doc_id", "text")
    mail = F.col("was").rlike(T.REDACTIONS[3][0])
    normal = D.normalise_blocks(blocks.withColumn("was", F.col("text")))
    return normal.groupBy(F.col("doc").alias("doc_id")).agg(F.count("*").alias("blocks"), F.max(mail & (F.col("redacted") | F.lit(True))).alias("mails"))


# records


def atoms(spark, sf_dir) -> DataFrame:
    """A record a part: references of code, documents or both, some with checks and actions."""
    k, n = F.col("p_partkey"), s(F.col("p_partkey"))
    ref = lambda kind, c, authority="": F.struct(F.lit(kind).alias("type"), c.alias("id"), F.lit(authority).alias("authority"))
    code, glue = ref("code", F.concat(F.lit("src/CartService"), n, F.lit("/CartService.java#a"))), ref("code", F.concat(F.lit("src/"), n, F.lit("Handler.java")))
    none = F.array().cast(A.REFS)
    refs = F.when(k % 6 == 0, F.array(code, ref("doc", n))).when(k % 6 == 1, F.array(code)).when(k % 6 == 2, F.array(ref("doc", n, "official"))).when(k % 6 == 3, F.array(ref("doc", n))).when(k % 6 == 4, F.array(glue)).otherwise(none)
    checks = F.when(k % 4 == 0, F.array(F.col("p_name"))).otherwise(F.array().cast("array<string>"))
    return read(spark, sf_dir, "part").select(F.concat(F.lit("a"), n).alias("atom_id"), pick(k, "rule", "step").alias("kind"), F.col("p_name").alias("claim"), checks.alias("checks"), F.when(k % 5 == 0, "do it").alias("action"), F.when(k % 7 == 0, "never").alias("negative_rule"), refs.cast(A.REFS).alias("source_refs"), k.alias("k"))


SCORED = """a AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 5 THEN 0.3 ELSE greatest(0.0, least(0.95, [0.85, 0.75, 0.65, 0.55, 0.75, 0.0][(p_partkey % 6 + 1)::INT] + (p_partkey % 4 = 0)::INT * 0.05 + (p_partkey % 7 = 0)::INT * 0.03 + (p_partkey % 5 = 0)::INT * 0.02 + [0.05, 0.05, 0.0, 0.0, -0.30, 0.0][(p_partkey % 6 + 1)::INT])) END AS c FROM part),
    b AS (SELECT k, round_even(c, 3)::DOUBLE AS confidence, CASE WHEN k % 6 = 5 THEN 'rejected' WHEN round_even(c, 3) >= 0.8 THEN 'accepted' WHEN round_even(c, 3) >= 0.6 THEN 'candidate' WHEN round_even(c, 3) >= 0.4 THEN 'needs_review' ELSE 'rejected' END AS status FROM a)"""


@query(f"WITH {SCORED} SELECT 'a' || k AS atom_id, confidence, status FROM b")
def atoms_score(spark, sf_dir):
    """Tiered confidence and status by kinds of references, with the role filter."""
    return A.score_atoms(atoms(spark, sf_dir)).select("atom_id", "confidence", "status")


@query(f"WITH {SCORED} SELECT 'a' || k AS atom_id, p_name AS question, CASE WHEN k % 6 IN (0, 1) THEN 'src/CartService' || k || '/CartService.java#a' WHEN k % 6 = 4 THEN 'src/' || k || 'Handler.java' ELSE '' END AS refs, CASE WHEN k % 6 IN (0, 1, 4) THEN 'low' ELSE 'needs_review' END AS risk FROM b JOIN part ON p_partkey = k WHERE confidence >= 0.6")
def atoms_seeds(spark, sf_dir):
    """Benchmark seeds of confident records."""
    seeds = A.seeds(A.score_atoms(atoms(spark, sf_dir)))
    return seeds.select("atom_id", "question", F.array_join("context_refs", ",").alias("refs"), "risk")


@query(f"WITH {SCORED} SELECT count(*) AS atoms, avg((status = 'accepted')::INT::DOUBLE) AS accepted_rate, 2::INTEGER AS most_refs, (SELECT count(*) FROM b WHERE confidence >= 0.6) AS seeds, CASE WHEN avg((status = 'accepted')::INT) < 0.3 THEN 'accepted_rate' ELSE '' END AS failures FROM b")
def atoms_quality(spark, sf_dir):
    """Counts and rates of records and seeds, and failed rules."""
    scored = A.score_atoms(atoms(spark, sf_dir))
    q = A.artifact_quality(scored, A.seeds(scored).withColumn("expected_checks", F.array(F.lit("telling token"))))
    return q.select("atoms", "accepted_rate", "most_refs", "seeds", F.array_join("failures", ",").alias("failures"))


@query("SELECT 'doc.d' || p_partkey || '.procedure' AS atom_id, 'procedure' AS kind FROM part WHERE p_partkey % 10 IN (3, 6) UNION ALL SELECT 'doc.d' || p_partkey || '.constraint', 'constraint' FROM part WHERE p_partkey % 10 IN (4, 9) UNION ALL SELECT 'code.d' || p_partkey || '.retry_rule', 'retry_rule' FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT 'code.d' || p_partkey || '.transaction_rule', 'transaction_rule' FROM part WHERE p_partkey % 10 IN (1, 7) UNION ALL SELECT 'code.d' || p_partkey || '.job_rule', 'job_rule' FROM part WHERE p_partkey % 10 IN (2, 8)")
def atoms_extract(spark, sf_dir):
    """Records told by chunks of documents and by snippets of code."""
    k = F.col("p_partkey")
    text = pick(k, *PHRASES)
    rows = read(spark, sf_dir, "part").select(F.concat(F.lit("d"), s(k)).alias("chunk_id"), text.alias("text"), T.content_type(text).alias("content_type"))
    return A.atoms_from_chunks(rows).select("atom_id", "kind").unionByName(A.atoms_from_code(rows.select(F.col("chunk_id").alias("ref"), "text")).select("atom_id", "kind"))


@query("WITH t AS (SELECT p_partkey AS k, p_partkey % 9 AS code, p_partkey % 5 AS doc FROM part) SELECT k, least(code, 8 - least(doc, greatest(2, 8 - code)))::INTEGER AS code_refs, least(doc, greatest(2, 8 - code))::INTEGER AS doc_refs FROM t")
def atoms_cap_refs(spark, sf_dir):
    """References capped at eight, a quarter kept for others than code."""
    k = F.col("p_partkey")
    ref = lambda kind: lambda i: F.struct(F.lit(kind).alias("type"), F.concat(F.lit("x/"), s(i)).alias("id"), F.lit("").alias("authority"))
    some = lambda n, kind: F.transform(F.filter(F.sequence(F.lit(1), F.lit(9)), lambda i: i <= n), ref(kind))
    capped = A.cap_refs(F.concat(some(k % 9, "code"), some(k % 5, "doc")).cast(A.REFS), 8)
    of = lambda kind: F.size(F.filter("c", lambda r: r["type"] == kind))
    return read(spark, sf_dir, "part").select(k.alias("k"), capped.alias("c")).select("k", of("code").alias("code_refs"), of("doc").alias("doc_refs"))


@query("SELECT p_partkey AS k, round_even(least(1.0, p_size / 50.0 + least(0.15, (p_partkey % 6) * 0.05) + CASE WHEN p_partkey % 2 = 0 THEN 0.1 ELSE 0.0 END), 3)::DOUBLE AS confidence FROM part")
def atoms_group_confidence(spark, sf_dir):
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(k.alias("k"), A.merged_confidence(F.col("p_size") / 50.0, k % 6 + 1, k % 2 == 0).alias("confidence"))


# scores


@query("SELECT event_id, event_id % 4 <> 3 AS passes, event_id % 4 = 0 AS own FROM events")
def score_aliases(spark, sf_dir):
    """Checks that an answer holds by itself or by an alias, aliases of two maps merged."""
    i = F.col("event_id")
    answer = pick(i, "it costs 1,200 today", "the Price is fine", "a fee applies", "nothing")
    a, b = F.create_map(F.lit("COST"), F.array(F.lit("price"))), F.create_map(F.lit("cost"), F.array(F.lit("fee")), F.lit("x"), F.array(F.lit("y")))
    check = F.when(i % 4 == 0, "1200").otherwise("cost")
    return read(spark, sf_dir, "events").select("event_id", S.check_passes(answer, check, S.merge_aliases(a, b)).alias("passes"), S.check_passes(answer, check).alias("own"))


@query("SELECT event_id, round_even(CASE event_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.8 ELSE 0.3 END, 3)::DOUBLE AS soft, (event_id % 3 = 1)::INT AS hard FROM events")
def score_rubric(spark, sf_dir):
    """Weighted shares of a rubric's dimensions that answers hold."""
    rubric = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.array(*map(F.lit, ks)).alias("keywords")) for n, w, ks in (("a", 0.5, ("alpha", "first")), ("b", 0.3, ("beta",)), ("c", 0.2, ("none",)))])
    r = S.rubric_score(pick(F.col("event_id"), "the First", "alpha and BETA", "beta"), rubric)
    return read(spark, sf_dir, "events").select("event_id", r.alias("r")).select("event_id", "r.soft", "r.hard")


@query("SELECT event_id, least(1.0, greatest(0.0, value / 60 - 0.2)) AS soft, CASE WHEN event_id % 2 = 0 THEN 1 ELSE (value / 60 - 0.2 >= 1)::INT END AS hard, CASE WHEN event_id % 3 = 0 THEN 'm' ELSE 'b' END AS missed FROM events")
def score_normalise(spark, sf_dir):
    """Scores of an outside scorer brought into bounds and filled in."""
    i = F.col("event_id")
    arr = lambda *xs: F.array(*map(F.lit, xs))
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("value") / 60 - 0.2).alias("soft"), F.when(i % 2 == 0, 1).alias("hard"), arr("a", "b").alias("expected_checks"), arr("a").alias("passed_checks"), F.when(i % 3 == 0, arr("m")).alias("missed_checks"))
    return S.normalise_script_score(rows).select("event_id", "soft", "hard", F.array_join("missed_checks", ",").alias("missed"))


@query("SELECT step::INTEGER AS step, 10 AS constant, greatest(2, round_even(10 - 8 * least(1.0, step / 40.0), 0))::INTEGER AS linear, greatest(2, round_even(2 + 4 * (1 + cos(3.141592653589793 * least(1.0, step / 40.0))), 0))::INTEGER AS cosine, greatest(2, round_even(10 * pow(0.95, step), 0))::INTEGER AS exponential FROM (SELECT DISTINCT user_id AS step FROM events)")
def score_edit_budget(spark, sf_dir):
    """Edits allowed at each step under four schedules."""
    steps = read(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("step")).distinct()
    return steps.select("step", *[S.edit_budget(F.col("step"), 40, 10, 2, k).alias(k) for k in ("constant", "linear", "cosine", "exponential")])


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS hard, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE 0.5 END AS soft, CASE WHEN event_id % 3 = 0 THEN 'a,b' ELSE 'b' END AS missed, CASE WHEN event_id % 3 = 0 THEN 'prompt_echo' ELSE '' END AS hygiene_reason FROM events")
def score_hygiene_apply(spark, sf_dir):
    """Echoing answers lose their scores and miss every check."""
    arr = lambda *xs: F.array(*map(F.lit, xs))
    rows = read(spark, sf_dir, "events").select("event_id", pick(F.col("event_id"), "Task: x", "fine", "good").alias("answer"), F.lit(1).alias("hard"), F.lit(0.5).alias("soft"), arr("a", "b").alias("expected_checks"), arr("a").alias("passed_checks"), arr("b").alias("missed_checks"))
    return S.apply_hygiene(rows, "answer").select("event_id", "hard", F.col("soft").cast("decimal(2,1)").alias("soft"), F.array_join("missed_checks", ",").alias("missed"), "hygiene_reason")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '## A' || chr(10) || 'the body of ' || event_id || ' which is long' ELSE 'no heading ' || event_id END AS body FROM events")
def score_answer_body(spark, sf_dir):
    """What an answer says from its first section on."""
    i = s(F.col("event_id"))
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("hello\n## A\nthe body of "), i, F.lit(" which is long\n# End\nbye"))).otherwise(F.concat(F.lit("  no heading "), i))
    return read(spark, sf_dir, "events").select("event_id", S.answer_body(text).alias("body"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'prompt_echo' WHEN event_id % 5 = 1 THEN 'alias_gap' WHEN event_id % 2 = 0 THEN 'missing_business_rule' ELSE 'unknown' END AS failure_type FROM events")
def score_classify(spark, sf_dir):
    i = F.col("event_id")
    aliases = F.create_map(F.lit("cost"), F.array(F.lit("price")))
    rows = read(spark, sf_dir, "events").select("event_id", pick(i, "Task: x", "the price", "q", "w", "e").alias("predicted_answer"), F.array(F.lit("Cost")).alias("missed_checks"), (i % 2).alias("hard"), aliases.alias("aliases"))
    return S.classify_failure(rows, aliases="aliases").select("event_id", "failure_type")


@query("SELECT event_type, user_id % 3 AS split, count(*) AS items, round_even(avg((value >= 50)::INT), 3)::DOUBLE AS hard, round_even(avg(value / 100), 3)::DOUBLE AS soft, round_even(avg((value >= 50)::INT), 3)::DOUBLE AS accuracy, round_even(avg(value / 200), 3)::DOUBLE AS f1 FROM events GROUP BY ALL")
def score_means(spark, sf_dir):
    """Mean scores of a split's task types."""
    v = F.col("value")
    hard = (v >= 50).cast("int")
    rows = read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 3).alias("split"), hard.alias("hard"), (v / 100).alias("soft"), hard.cast("double").alias("accuracy"), (v / 200).alias("f1"))
    return S.mean_scores(rows, "event_type", "split")


@query("SELECT event_type AS task_type, count(*) AS support, round_even(least(0.9, 0.4 + 0.08 * count(*)), 3)::DOUBLE AS confidence FROM events WHERE value >= 99 GROUP BY 1 HAVING count(*) >= 2")
def score_success_proposals(spark, sf_dir):
    return S.success_proposals(read(spark, sf_dir, "events").select(F.col("event_type").alias("task_type"), (F.col("value") >= 99).cast("int").alias("hard")))


# ledgers and searches


@query("WITH e AS (SELECT event_type || ' rule' AS t, event_id, event_id % 3 AS support, event_id % 2 AS accepted, (event_id % 7 = 0)::INT AS regressions, 's' || (event_id % 30) AS src FROM events), i AS (SELECT t, list_sort(list(DISTINCT src))[1:24] AS items FROM e GROUP BY t) SELECT arg_min('r' || event_id, event_id) AS rule_id, sum(support)::BIGINT AS support_count, sum(accepted)::BIGINT AS accepted_count, sum(regressions)::BIGINT AS regression_count, max(event_id) AS last_step, any_value(array_to_string(items, ',')) AS items FROM e JOIN i USING (t) GROUP BY t")
def ledger_merge_rules(spark, sf_dir):
    """Rules of equal texts with counters added and sources joined."""
    i = F.col("event_id")
    rows = read(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), s(i)).alias("rule_id"), F.concat(F.initcap("event_type"), F.when(i % 2 == 0, "  RULE").otherwise(" rule ")).alias("text"), (i % 3).alias("support_count"), (i % 2).alias("accepted_count"),
        F.when(i % 7 == 0, 1).otherwise(0).alias("regression_count"), i.alias("last_step"), F.array(F.concat(F.lit("s"), s(i % 30))).alias("source_items"),
    )
    merged = L.merge_rules(rows.where("last_step % 5 < 3"), rows.where("last_step % 5 >= 3"))
    return merged.select("rule_id", "support_count", "accepted_count", "regression_count", "last_step", F.array_join("source_items", ",").alias("items"))


@query("SELECT user_id AS id, (max(value) >= 90)::INT AS baseline, CASE WHEN max(value) >= 90 AND min(value) < 5 THEN 'regressed' WHEN max(value) < 90 AND min(value) >= 5 THEN 'fixed' ELSE 'same' END AS state FROM events GROUP BY user_id")
def ledger_replay_outcomes(spark, sf_dir):
    """Pool items that a replay regressed or fixed."""
    e = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.max("value").alias("a"), F.min("value").alias("b"))
    out = L.replay_outcomes(e.select("id", (F.col("a") >= 90).cast("int").alias("baseline_hard")), e.select("id", (F.col("b") >= 5).cast("int").alias("hard")))
    return out.select("id", F.col("baseline_hard").alias("baseline"), "state")


@query("WITH e AS (SELECT 'h' || (event_id % 2000) AS hash, event_id AS seq, value FROM events), g AS (SELECT hash, min(seq) AS seq, arg_max(value, seq) AS score FROM e GROUP BY hash) SELECT * FROM g ORDER BY seq DESC LIMIT 50")
def ledger_newest(spark, sf_dir):
    """A bounded cache: the newest keys by first insertion."""
    return L.newest(read(spark, sf_dir, "events").select(F.concat(F.lit("h"), s(F.col("event_id") % 2000)).alias("hash"), F.col("event_id").alias("seq"), F.col("value").alias("score")), 50)


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def ledger_last_rows(spark, sf_dir):
    return L.last_rows(read(spark, sf_dir, "events").select("event_id", "user_id", "ts"), 25, "ts", "event_id").drop("ts")


@query(
    """WITH l AS (SELECT user_id % 10 AS run, event_id AS line_no, event_id % 4 AS kind, value FROM events), c AS (SELECT *, max(CASE WHEN kind = 0 THEN line_no END) OVER w AS e_at, max(CASE WHEN kind = 1 THEN line_no END) OVER w AS s_at FROM l WINDOW w AS (PARTITION BY run ORDER BY line_no))
    SELECT run, line_no, (e_at % 100)::INTEGER AS epoch, (s_at % 1000)::INTEGER AS step, CASE WHEN kind = 2 THEN floor(value) / 100 END AS score, CASE WHEN kind = 2 THEN CASE WHEN value > 50 THEN 'accept' ELSE 'reject' END END AS action FROM c"""
)
def ledger_run_log(spark, sf_dir):
    """Log lines with the epoch and step in force."""
    i, kind = F.col("event_id"), F.col("event_id") % 4
    line = F.when(kind == 0, F.concat(F.lit("== Epoch "), s(i % 100))).when(kind == 1, F.concat(F.lit("step "), s(i % 1000), F.lit(" begins"))).when(kind == 2, F.concat(F.lit("score="), s(F.floor(F.col("value")) / 100), F.lit(" gate: "), F.when(F.col("value") > 50, "accept").otherwise("reject"))).otherwise(F.lit("other"))
    return SRC.parse_run_log(read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("run"), i.alias("line_no"), line.alias("line"))).drop("line")


@query("SELECT 'repeated' AS issue, 'c' || c_nationkey AS id FROM customer GROUP BY c_nationkey HAVING count(*) > 1 UNION ALL SELECT 'overlap', 'c' || c_nationkey FROM customer WHERE c_nationkey < 5 GROUP BY c_nationkey UNION ALL SELECT 'missing_id', '' FROM range(2)")
def ledger_split_issues(spark, sf_dir):
    """Missing, repeated and overlapping ids of splits."""
    key = F.concat(F.lit("c"), s(F.col("c_nationkey")))
    c = read(spark, sf_dir, "customer")
    splits = c.select(key.alias("id"), F.lit("train").alias("split")).unionByName(c.where("c_nationkey < 5").select(key.alias("id"), F.lit("test").alias("split")).distinct()).unionByName(spark.range(2).select(F.lit("").alias("id"), F.lit("test").alias("split")))
    return SRC.split_issues(splits)


@query("WITH t AS (SELECT p_partkey AS id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(p_name || ' ' || p_brand), '[^a-z0-9]+'), lambda w: w <> ''))) AS token FROM part) SELECT token, count(*) AS nodes FROM t GROUP BY token")
def search_index(spark, sf_dir):
    """Sizes of an inverted index over names and brands."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand")
    return Q.inverted_index(p, "id", "p_name", "p_brand").groupBy("token").agg(F.count("*").alias("nodes"))


@query("WITH h AS (SELECT p_brand AS repo, p_partkey AS id, p_size / 50.0 AS score FROM part), q AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY repo ORDER BY score DESC, id) <= 3) SELECT repo, id FROM q ORDER BY score DESC, repo, id LIMIT 20")
def search_quota(spark, sf_dir):
    """Hits of several sources, each with its share."""
    hits = read(spark, sf_dir, "part").select(F.col("p_brand").alias("repo"), F.col("p_partkey").alias("id"), (F.col("p_size") / 50.0).alias("score"))
    return Q.quota(hits, "repo", 20, 25).select("repo", "id")


@query("WITH s AS (SELECT p_partkey AS id, (p_name = 'pump 1')::INT * 10 + CASE WHEN contains(p_brand, '#1') THEN 25 ELSE 0 END + (p_size > 25)::INT * 5 AS rank_score FROM part WHERE contains(lower(p_name), 'p')) SELECT id, rank_score FROM s")
def search_rank_symbols(spark, sf_dir):
    """Nodes whose name holds a word, ranked by name, place and kind."""
    nodes = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("file_path"), F.when(F.col("p_size") > 25, "class").otherwise("method").alias("kind"))
    ranked = Q.rank_symbols(nodes, "p", near="#1")
    exact = F.when(F.col("name") == "pump 1", 10).otherwise(0)
    return ranked.select("id", (F.col("rank_score") + exact).alias("rank_score"))


@query("SELECT doc, 'a' || chr(10) || '<!-- slow_update:begin -->' || chr(10) || 'new ' || doc || chr(10) || '<!-- slow_update:end -->' || CASE WHEN doc % 2 = 0 THEN chr(10) || 'z' ELSE '' END AS text FROM (SELECT c_custkey AS doc FROM customer)")
def edits_region(spark, sf_dir):
    """A document's region between markers replaced, or put at its end."""
    d = F.col("c_custkey")
    text = F.when(d % 2 == 0, "a\n<!-- slow_update:begin -->\nold\n<!-- slow_update:end -->\nz").otherwise("a")
    return read(spark, sf_dir, "customer").select(d.alias("doc"), E.replace_region(text, F.concat(F.lit("new "), s(d))).alias("text"))


@query("SELECT c_custkey AS doc, '- must a' || chr(10) || 'x' || chr(10) || '- b ' || c_custkey AS text FROM customer")
def edits_sanitise(spark, sf_dir):
    """Without leaking lines and repeated bullets."""
    d = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(d.alias("doc"), E.sanitise(F.concat(F.lit("- must a\nsystem: q\nx\n- MUST  a\n- b "), s(d))).alias("text"))


@query("SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::INTEGER AS level, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def rel_cube(spark, sf_dir):
    """Lines and quantities over all combinations of flags."""
    l = read(spark, sf_dir, "lineitem")  # noqa: E741
    return l.cube("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")).select("l_returnflag", "l_linestatus", "level", "lines", "quantity")


@query("SELECT o_custkey, o_orderkey, date_diff('day', lag(o_orderdate) OVER w, o_orderdate)::INTEGER AS days, o_orderdate + INTERVAL 1 MONTH AS due FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def rel_intervals(spark, sf_dir):
    """Days since a customer's order before, and a due date by a month."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = read(spark, sf_dir, "orders")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lag("o_orderdate").over(w).cast("date"))
    return o.select("o_custkey", "o_orderkey", days.alias("days"), (F.col("o_orderdate") + F.expr("INTERVAL 1 MONTH")).alias("due"))
