"""Queries over events as the results of an answering loop; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edits as E
from ..operators import ledger as L
from ..operators import runs as R
from ..operators import scoring as S
from ..streaming import sync

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


def results(spark, sf_dir) -> DataFrame:
    """Every event as a result: errors and small values fail, and miss two or three checks."""
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    s = lambda c: c.cast("string")
    answer = F.when(i % 6 == 0, "Task: again").when(i % 6 == 1, "").otherwise(F.concat(F.lit("seen "), F.col("event_type"), F.lit(" "), s(i)))
    checks = F.array(F.concat(F.lit("c"), s(i % 7)), s(i % 3 + 10), F.col("event_type"))
    hard = (F.col("value") >= 50).cast("int")
    return e.select(
        i.alias("id"), (i % 5).alias("step"), F.col("event_type").alias("task_type"), hard.alias("hard"), (F.floor(F.col("value")) / 100).alias("soft"), answer.alias("predicted_answer"), F.concat(F.lit("question of "), s(i)).alias("question"),
        F.when(hard == 0, checks).otherwise(F.array().cast("array<string>")).alias("missed_checks"), F.when(hard == 1, checks).otherwise(F.array().cast("array<string>")).alias("passed_checks"),
        F.when(i % 4 == 0, "output_format_error").when(i % 4 == 1, "scorer_alias_gap").alias("scorer_type"), (i % 6 == 0).alias("echo"), F.concat(F.lit("s"), s(i % 3)).alias("scorer"), (F.col("user_id") % 20).alias("run"), F.col("value"),
    )


def facts(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").where("event_id % 3 = 0").select(F.col("event_id").alias("id"), F.lit("a fact").alias("fact"))


RES = """r AS (SELECT event_id AS id, event_id % 5 AS step, event_type AS task_type, (value >= 50)::INT AS hard, floor(value) / 100 AS soft, CASE event_id % 6 WHEN 0 THEN 'Task: again' WHEN 1 THEN '' ELSE 'seen ' || event_type || ' ' || event_id END AS answer,
  ['c' || (event_id % 7), (event_id % 3 + 10)::VARCHAR, event_type] AS checks, event_id % 6 = 0 AS echo, 's' || (event_id % 3) AS scorer, user_id % 20 AS run, value, event_id % 3 = 0 AS fact FROM events)"""
DIAG = f"""{RES}, k AS (SELECT *, CASE WHEN echo THEN 'prompt_echo' WHEN id % 4 = 0 THEN 'output_format_error' WHEN id % 4 = 1 THEN 'scorer_alias_gap' ELSE 'missing_business_rule' END AS failure_type, array_to_string(checks, ', ') AS named FROM r WHERE hard = 0),
  d AS (SELECT *, CASE WHEN failure_type = 'missing_business_rule' AND NOT fact THEN 'needs_review' ELSE 'ready' END AS status, CASE failure_type WHEN 'prompt_echo' THEN 'Final answer must not repeat Task/Skill reference/Code context; output only the deliverable.' WHEN 'output_format_error' THEN 'Output format does not satisfy scorer checks: ' || named || '.'
    WHEN 'scorer_alias_gap' THEN 'Output should satisfy missed checks (and configured aliases): ' || named || '.' ELSE 'Add skill rules so output covers missed checks: ' || named || '.' END AS rule FROM k)"""


def diagnoses(spark, sf_dir) -> DataFrame:
    return R.diagnose(results(spark, sf_dir), facts(spark, sf_dir))


@query(f"WITH {DIAG} SELECT id, failure_type, fact::INT::BIGINT AS facts, status, rule, CASE failure_type WHEN 'prompt_echo' THEN 1 WHEN 'output_format_error' THEN 2 WHEN 'scorer_alias_gap' THEN 3 ELSE 4 END::INTEGER AS urgency FROM d")
def run_diagnoses(spark, sf_dir):
    """Failures with kind, facts, status, rule and urgency."""
    return R.by_urgency(diagnoses(spark, sf_dir)).select("id", "failure_type", F.col("facts").cast("bigint").alias("facts"), "status", "rule", "urgency")


@query(
    f"""WITH {DIAG}, g AS (SELECT step, list_sort(list(DISTINCT rule))[1:12] AS rules FROM d GROUP BY step)
    SELECT step, count(*) AS diagnoses, count(*) FILTER (status = 'needs_review') AS needs_review, count(*) FILTER (failure_type = 'prompt_echo') AS prompt_echo, count(*) FILTER (failure_type = 'output_format_error') AS output_format_error,
      count(*) FILTER (failure_type = 'scorer_alias_gap') AS scorer_alias_gap, count(*) FILTER (failure_type = 'missing_business_rule') AS missing_business_rule, any_value(array_to_string(rules, ';')) AS rules FROM d JOIN g USING (step) GROUP BY step"""
)
def run_diagnosis_summary(spark, sf_dir):
    return R.diagnosis_summary(diagnoses(spark, sf_dir)).withColumn("rules", F.array_join("rules", ";"))


@query(
    f"""WITH {DIAG}, f AS (SELECT count(*) AS failures FROM r WHERE hard = 0), h AS (SELECT count(*) AS n, sum((status = 'ready')::INT) AS ready, sum(fact::INT) AS facts FROM d WHERE id % 7 <> 0)
    SELECT failures, n AS diagnosed, round_even(n / failures, 4)::DOUBLE AS coverage, round_even(ready / n, 4)::DOUBLE AS ready_rate, round_even(facts / n, 4)::DOUBLE AS fact_rate FROM f, h"""
)
def run_diagnosis_metrics(spark, sf_dir):
    """Coverage of diagnoses, of which every seventh is lost."""
    return R.diagnosis_metrics(diagnoses(spark, sf_dir).where("id % 7 <> 0"), results(spark, sf_dir))


@query(f"WITH {RES} SELECT id, task_type, 'question of ' || id AS question, answer, array_to_string(checks, ',') AS missed FROM r WHERE hard = 0")
def run_failure_records(spark, sf_dir):
    return R.failure_records(results(spark, sf_dir)).withColumn("missed", F.array_join("missed_checks", ",")).drop("missed_checks")


@query(f"WITH {RES}, m AS (SELECT task_type, CASE WHEN regexp_full_match(c, '[0-9.,]+') THEN '<number>' ELSE c END AS k FROM (SELECT task_type, unnest(checks) AS c FROM r WHERE hard = 0)), n AS (SELECT task_type, k AS missed, count(*) AS times FROM m GROUP BY ALL) SELECT task_type, missed, times, row_number() OVER (PARTITION BY task_type ORDER BY times DESC, missed)::INTEGER AS rank FROM n QUALIFY rank <= 5")
def run_missed_counts(spark, sf_dir):
    return R.missed_counts(results(spark, sf_dir)).withColumnRenamed("check", "missed")


@query(f"WITH {RES} SELECT c AS missed, count(*) AS times FROM (SELECT unnest(checks) AS c FROM r WHERE hard = 0) GROUP BY c")
def run_missed_summary(spark, sf_dir):
    return S.missed_summary(results(spark, sf_dir)).toDF("missed", "times")


@query(f"WITH {DIAG} SELECT lower(trim(rule)) AS key, arg_min(rule, id) AS text, min(id) AS first_id, count(*) AS support FROM d WHERE status = 'ready' AND (failure_type <> 'missing_business_rule' OR fact) GROUP BY 1")
def run_candidate_rules(spark, sf_dir):
    return R.candidate_rules(diagnoses(spark, sf_dir))


# the rule bank: a rule a part, by its type


def bank(spark, sf_dir) -> DataFrame:
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    s = k.cast("string")
    items = F.array(F.concat(F.lit("i"), (k % 50).cast("string")), F.concat(F.lit("i"), (k % 13 + 100).cast("string")))
    return p.select(
        F.concat(F.lit("r"), s).alias("rule_id"), F.concat(F.lit("always check "), F.col("p_name"), F.lit(" "), s, F.lit(".")).alias("text"), F.when(k % 9 == 0, "retired").otherwise("active").alias("status"), (k % 6).alias("support_count"), (k % 4).alias("accepted_count"),
        F.when(k % 5 == 0, 1).otherwise(0).alias("regression_count"), (F.col("p_size") / 50.0).alias("code_confidence"), F.array_sort(items).alias("source_items"), F.array(F.lit("run1"), F.lit("run2")).alias("source_runs"), F.lit(0).alias("last_accept_step"),
    )


BANK = """b AS (SELECT 'r' || p_partkey AS rule_id, 'always check ' || p_name || ' ' || p_partkey || '.' AS text, p_partkey % 9 = 0 AS retired, p_partkey % 6 AS support, p_partkey % 4 AS accepted, (p_partkey % 5 = 0)::INT AS regressions, p_size / 50.0 AS confidence,
  list_sort(['i' || (p_partkey % 50), 'i' || (p_partkey % 13 + 100)]) AS items, p_partkey AS k FROM part)"""


@query(f"WITH {BANK}, s AS (SELECT rule_id, support AS support_count, round_even(0.4 * confidence + 0.4 * least(1.0, accepted / greatest(support, 1)) + 0.2, 3)::DOUBLE AS score FROM b WHERE NOT retired AND support >= 2 AND regressions = 0) SELECT * FROM s WHERE score >= 0.5 ORDER BY support_count DESC, rule_id LIMIT 25")
def rules_active(spark, sf_dir):
    """Active rules: four filters, most supported first."""
    return R.active_rules(bank(spark, sf_dir), 25, least_support=2, least_score=0.5).select("rule_id", "support_count", "score")


@query(
    r"""WITH t AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN '  Rule ' WHEN 2 THEN 'ab ' || p_size ELSE 'the very long text of a rule about ' || p_brand END AS text FROM part),
    n AS (SELECT k, lower(trim(regexp_replace(text, '[ \t\r\n\f\v]+', ' ', 'g'))) AS key FROM t), h AS (SELECT *, left(sha1(key), 10) AS h, regexp_replace(left(regexp_replace(regexp_replace(key, '[^a-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 40), '^_+|_+$', '', 'g') AS slug FROM n)
    SELECT k, h AS hash, CASE WHEN slug IN ('', 'rule', 'rules', 'unknown', 'none', 'null', 'id') THEN 'rule_' || h WHEN length(slug) < 8 THEN slug || '_' || h ELSE slug END AS rule_id, slug IN ('rule') OR length(slug) < 2 AS weak FROM h"""
)
def rules_ids(spark, sf_dir):
    """Ids of rules by their text, hashes and weak ids."""
    k = F.col("p_partkey")
    text = F.when(k % 4 == 0, F.col("p_type")).when(k % 4 == 1, "  Rule ").when(k % 4 == 2, F.concat(F.lit("ab "), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit("the very long text of a rule about "), F.col("p_brand")))
    return read(spark, sf_dir, "part").select(k.alias("k"), R.rule_hash(text).alias("hash"), R.rule_id_of(text).alias("rule_id"), R.is_weak_id(F.trim(text)).alias("weak"))


@query("WITH t AS (SELECT p_partkey AS k, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n, lower(p_brand) AS b, left(sha1('use ' || lower(p_brand) || ' now'), 10) AS h FROM part), s AS (SELECT *, trim(regexp_replace('use_' || b || '_now', '[^a-z0-9._-]+', '_', 'g'), '_') AS slug FROM t) SELECT k, CASE n WHEN 1 THEN slug WHEN 2 THEN slug || '_' || h ELSE slug || '_' || h || '_' || (n - 1) END AS rule_id FROM s")
def rules_unique_ids(spark, sf_dir):
    """Distinct ids of rules of equal texts."""
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat(F.lit("use "), F.col("p_brand"), F.lit(" now")).alias("text"))
    return R.unique_ids(rows, "k").select("k", "rule_id")


@query(
    f"""WITH {BANK}, d AS (SELECT k % 40 AS doc, string_agg(text, chr(10)) AS text FROM b WHERE k % 3 = 0 GROUP BY 1), m AS (SELECT rule_id, count(*) AS n, max(doc) AS step FROM b JOIN d ON contains(d.text, b.text) GROUP BY rule_id)
    SELECT rule_id, support + coalesce(n, 0) AS support_count, accepted + coalesce(n, 0) AS accepted_count, coalesce(step, 0) AS last_accept_step, CASE WHEN n IS NULL THEN 'run1,run2' ELSE 'run1,run2,now' END AS runs,
      array_to_string(CASE WHEN n IS NULL THEN items ELSE list_sort(list_distinct(list_concat(items, ['f1', 'f2']))) END, ',') AS items FROM b LEFT JOIN m USING (rule_id)"""
)
def rules_acceptance(spark, sf_dir):
    """Counters, runs and items of rules whose text accepted documents hold."""
    b = bank(spark, sf_dir)
    k = F.substring("rule_id", 2, 20).cast("long")
    docs = b.where(k % 3 == 0).groupBy((k % 40).alias("step")).agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
    fixed = spark.createDataFrame([("f1",), ("f2",), ("",)], "id string")
    out = R.record_acceptance(b, docs, fixed, "now")
    return out.select("rule_id", "support_count", "accepted_count", "last_accept_step", F.array_join("source_runs", ",").alias("runs"), F.array_join("source_items", ",").alias("items"))


@query(f"WITH {BANK} SELECT rule_id, regressions + list_has_any(items, ['i3', 'i101'])::INT AS regression_count FROM b")
def rules_regressions(spark, sf_dir):
    return R.record_regressions(bank(spark, sf_dir), spark.createDataFrame([("i3",), ("i101",), ("i3",)], "id string")).select("rule_id", "regression_count")


@query(f"WITH {RES} SELECT id, NOT echo AND id % 4 < 2 AND (id % 3 = 0 OR id % 3 = id % 2) AS record FROM r")
def rules_may_record(spark, sf_dir):
    """Which replay regressions are the accepted candidate's own."""
    i = F.col("id")
    action = F.when(i % 4 == 0, "accept").when(i % 4 == 1, "accept_new_best").otherwise("reject")
    regressed = F.when(~F.col("echo"), F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    h = lambda c: F.concat(F.lit("h"), c.cast("string"))
    return results(spark, sf_dir).select("id", R.may_record_regression(action, regressed, F.when(i % 3 == 0, "").otherwise(h(i % 3)), h(i % 2)).alias("record"))


@query(f"WITH {DIAG} SELECT id FROM d WHERE failure_type <> 'missing_business_rule' OR fact")
def rules_with_evidence(spark, sf_dir):
    """Rules left once missing ones without evidence are removed."""
    d = diagnoses(spark, sf_dir).withColumn("code_facts", F.when(F.col("facts") > 0, F.array(F.lit("a fact")))).withColumn("evidence_refs", F.array().cast("array<string>"))
    return R.with_evidence(d).select("id")


def rule_docs(spark, sf_dir) -> DataFrame:
    """(doc, text): a document a brand with the bullets of its parts under headings, the third repeated."""
    k = F.col("p_partkey")
    bullets = read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("doc")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.concat(F.lit("- must check "), "p_name", F.lit(" "), k.cast("string")).alias("t")))).alias("bs"))
    lines = F.transform("bs", lambda b: b["t"])
    return bullets.select("doc", F.concat(F.lit("# Title\n\n"), F.lit(R.HEADING), F.lit("\n\n"), F.array_join(lines, "\n"), F.lit("\n"), F.get(lines, F.lit(0)), F.lit("\n\n## Other\n\n- else "), "doc").alias("text"))


DOCS = """b AS (SELECT p_brand AS doc, p_partkey AS k, 'must check ' || p_name || ' ' || p_partkey AS rule FROM part), o AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY k) AS i, count(*) OVER (PARTITION BY doc) AS n FROM b)"""


@query(f"WITH {DOCS} SELECT doc, rule, left(regexp_replace(lower(rule), '[^a-z0-9._-]+', '_', 'g'), 40) AS rule_id FROM o")
def rules_promote(spark, sf_dir):
    """Bullets under the verified heading, as rules."""
    return R.promote(rule_docs(spark, sf_dir))


@query(f"WITH {DOCS} SELECT doc, (3 + i)::INTEGER AS pos, rule FROM o UNION ALL SELECT doc, (4 + n)::INTEGER, rule FROM o WHERE i = 1 UNION ALL SELECT doc, (8 + n)::INTEGER, 'else ' || doc FROM o WHERE i = 1")
def rules_lines(spark, sf_dir):
    """Bullets of rule documents with their lines."""
    return E.rule_lines(rule_docs(spark, sf_dir)).select("doc", "pos", "rule")


@query(f"WITH {DOCS} SELECT doc, 0::INTEGER AS pos, 'Title' AS heading, '' AS body FROM o WHERE i = 1 UNION ALL SELECT doc, 1, 'Verified Rules', string_agg('- ' || rule, chr(10) ORDER BY k) || chr(10) || '- ' || arg_min(rule, k) FROM o GROUP BY doc UNION ALL SELECT doc, 2, 'Other', '- else ' || doc FROM o WHERE i = 1")
def rules_sections(spark, sf_dir):
    return E.sections(rule_docs(spark, sf_dir))


@query(f"WITH {DOCS} SELECT doc, (n + 2)::INTEGER AS rules, 1::INTEGER AS duplicates, 0::INTEGER AS leaks, n + 2 <= 12 AND false AS passed FROM o WHERE i = 1")
def rules_quality(spark, sf_dir):
    """Scan of rule documents: rules, duplicates, leaks."""
    return E.quality(rule_docs(spark, sf_dir), most_rules=12).select("doc", "rules", "duplicates", "leaks", "passed")


@query(f"WITH {DOCS} SELECT doc, true AS sanitised, sha256('# Title' || chr(10) || chr(10) || '## Verified Rules' || chr(10) || chr(10) || string_agg('- ' || rule, chr(10) ORDER BY k) || chr(10) || chr(10) || '## Other' || chr(10) || chr(10) || '- else ' || doc) AS kept, CASE WHEN count(*) + 1 > 9 THEN 'size' END AS refused FROM o GROUP BY doc")
def rules_quality_gate(spark, sf_dir):
    """Scan, clean, scan again: repeated bullets go, what is still too long is refused."""
    return R.quality_gate(rule_docs(spark, sf_dir), most_rules=9).select("doc", "sanitised", F.sha2("kept", 256).alias("kept"), "refused")


@query(f"WITH {DOCS}, c AS (SELECT doc, rule, i AS pos, CASE WHEN k % 10 = 0 THEN 'regressed' END AS why FROM o UNION ALL SELECT doc, rule, n + 1, 'repeated' FROM o WHERE i = 1), f AS (SELECT doc, rule, why, row_number() OVER (PARTITION BY doc ORDER BY pos) AS r FROM c WHERE why IS NOT NULL) SELECT doc, rule, why FROM f WHERE r <= 3")
def rules_hygiene(spark, sf_dir):
    """Bullets to delete: repeated ones and those that regressed twice, three a document."""
    rules = E.rule_lines(rule_docs(spark, sf_dir)).withColumn("rule_id", F.regexp_extract("rule", r" ([0-9]+)$", 1))
    counts = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("rule_id"), F.lit(0).alias("uses"), F.when(F.col("p_partkey") % 10 == 0, 2).otherwise(1).alias("regressions"))
    return R.hygiene_pass(rules, counts).select("doc", "rule", "why")


@query(f"WITH {DOCS} SELECT doc, n + 2 > 9 OR length(doc) % 3 >= 2 AS due FROM o WHERE i = 1")
def rules_hygiene_due(spark, sf_dir):
    return R.hygiene_due(rule_docs(spark, sf_dir), F.length("doc") % 3, most_rules=9).select("doc", "due")


@query(f"WITH {DOCS} SELECT doc, sha256('# Title' || chr(10) || chr(10) || '## Verified Rules' || chr(10) || chr(10) || '- new rule' ) AS with_heading, sha256('## Verified Rules' || chr(10) || chr(10) || '- new rule' || chr(10) || chr(10) || 'holds known one') AS without, 'a' || chr(10) || '- b' AS stripped FROM o WHERE i = 1")
def rules_inject(spark, sf_dir):
    """A block of rules put before a text that lacks them, and rule comments taken out."""
    docs = rule_docs(spark, sf_dir).select("doc")
    rules = F.array(F.lit("known one"), F.lit("new rule"))
    headed, plain = F.lit("# Title\n\n" + R.HEADING + "\n\n- new rule"), F.lit("holds known one")
    return docs.select("doc", F.sha2(R.inject_rules(headed, rules), 256).alias("with_heading"), F.sha2(R.inject_rules(plain, rules), 256).alias("without"), R.strip_ids(R.inject_ids(F.lit("a\n- b"))).alias("stripped"))


@query(
    f"""WITH {RES}, v AS (SELECT *, 'skill with rule ' || (id % 4) || ' and rule ' || (id % 3 + 4) || '!' AS skill FROM r), u AS (SELECT 'rule ' || i AS rule_id, v.* FROM range(8) t(i) JOIN v ON contains(skill, 'rule ' || i)), c AS (SELECT rule_id, list_sort(list(DISTINCT x)) AS cs FROM (SELECT rule_id, unnest(checks) AS x FROM u WHERE hard = 1) GROUP BY rule_id)
    SELECT rule_id, count(*) AS uses, sum(hard)::BIGINT AS helped, sum(1 - hard)::BIGINT AS failed, any_value(array_to_string(cs, ',')) AS helped_checks FROM u JOIN c USING (rule_id) GROUP BY rule_id"""
)
def rules_attribution(spark, sf_dir):
    """Uses of each rule by the documents its text stands in, and the checks passed then."""
    i = F.col("id")
    r = results(spark, sf_dir).withColumn("skill", F.concat(F.lit("skill with rule "), (i % 4).cast("string"), F.lit(" and rule "), (i % 3 + 4).cast("string"), F.lit("!")))
    rules = spark.range(8).select(F.concat(F.lit("rule "), F.col("id").cast("string")).alias("rule_id")).withColumn("text", F.col("rule_id"))
    return R.attribute(rules, r).withColumn("helped_checks", F.array_join("helped_checks", ","))


# replay, proposals, edits


@query(f"WITH {RES} SELECT step, count(*) AS total, round_even(avg(hard), 3)::DOUBLE AS hard, round_even(avg(soft), 3)::DOUBLE AS soft, count(*) FILTER (echo AND step = 0) AS echoes, count(*) FILTER (id % 2 = 1 AND hard = 0 AND step <> 2 AND id % 3 = 0) AS regressed, count(*) FILTER (id % 2 = 0 AND hard = 1 AND id % 3 = 0) AS fixed, CASE WHEN step = 0 THEN 'prompt_echo_in_replay' WHEN count(*) FILTER (id % 2 = 1 AND hard = 0 AND step <> 2 AND id % 3 = 0) > 0 THEN 'replay_regression' WHEN avg(hard) < 0.5 THEN 'hard_pass_rate_below_threshold' ELSE 'ok' END AS reason, step <> 0 AND avg(hard) >= 0.5 AND count(*) FILTER (id % 2 = 1 AND hard = 0 AND step <> 2 AND id % 3 = 0) = 0 AS passed FROM r GROUP BY step")
def replay_gate(spark, sf_dir):
    """The replay gate's report and reasons of each step."""
    r = results(spark, sf_dir).withColumn("echo", F.col("echo") & (F.col("step") == 0))
    pool = results(spark, sf_dir).where("id % 3 = 0 and not (step = 2 and id % 2 = 1)").select("id", (F.col("id") % 2).alias("baseline_hard"))
    return R.replay_report(pool, r)


@query(f"WITH {RES} SELECT id FROM r WHERE NOT echo ORDER BY value, id LIMIT 10")
def replay_filter(spark, sf_dir):
    pool = results(spark, sf_dir).select("id", "echo", F.struct("value", "id").alias("place"))
    return R.filter_pool(pool, 10).select("id")


@query(
    """WITH p AS (SELECT 'e' || event_id AS id, event_id % 7 = 0 AS echo, event_id % 2 AS baseline_hard, event_id % 100 AS last_step FROM events), o AS (SELECT 'e' || (event_id * 3) AS id, event_id % 5 = 0 AS echo, 1 AS baseline_hard, event_id % 50 AS last_step, event_id FROM events),
    m AS (SELECT id, coalesce(o.echo, p.echo) AS echo, coalesce(o.baseline_hard, p.baseline_hard) AS baseline_hard, coalesce(o.last_step, p.last_step) AS last_step FROM p FULL JOIN o USING (id)) SELECT id, echo, baseline_hard, last_step FROM m ORDER BY echo DESC, baseline_hard <> 0, last_step DESC, id LIMIT 12"""
)
def replay_merge(spark, sf_dir):
    """Pools of other runs merged into one."""
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    pool = e.select(F.concat(F.lit("e"), i.cast("string")).alias("id"), (i % 7 == 0).alias("echo"), (i % 2).alias("baseline_hard"), (i % 100).alias("last_step"))
    others = e.select(F.concat(F.lit("e"), (i * 3).cast("string")).alias("id"), (i % 5 == 0).alias("echo"), F.lit(1).cast("bigint").alias("baseline_hard"), (i % 50).alias("last_step"), F.lit("p1").alias("source"))
    return R.merge_pools(pool, others)


@query(f"WITH {BANK}, p AS (SELECT 'i' || i AS id, i % 2 = 0 AS echo, i % 3 AS baseline_hard, i AS last_step FROM range(5) t(i)), x AS (SELECT DISTINCT unnest(items) AS id FROM b), n AS (SELECT id FROM x WHERE try_cast(substring(id, 2) AS INT) < 106 AND id NOT IN (SELECT id FROM p)), a AS (SELECT * FROM p UNION ALL SELECT id, false, 1, 0 FROM n) SELECT id, echo, baseline_hard, last_step FROM a ORDER BY echo DESC, baseline_hard <> 0, last_step DESC, id LIMIT 30")
def replay_exemplars(spark, sf_dir):
    """Source items of rules that a registry knows, put into the pool."""
    i = F.col("id")
    pool = spark.range(5).select(F.concat(F.lit("i"), i.cast("string")).alias("id"), (i % 2 == 0).alias("echo"), (i % 3).cast("int").alias("baseline_hard"), i.cast("int").alias("last_step"))
    registry = spark.range(106).select(F.concat(F.lit("i"), i.cast("string")).alias("id"))
    return R.merge_exemplars(pool, bank(spark, sf_dir), registry, 30)


@query(
    """WITH p AS (SELECT event_id AS proposal_id, CASE WHEN event_id % 3 = 0 THEN 'needs_review' ELSE 'ready' END AS status, event_id % 40 AS support, (event_id % 9) / 10.0 AS confidence, 'Rule of ' || (event_id % 17) || ' kinds' AS rule FROM events),
    t AS (SELECT * FROM p WHERE status = 'ready' ORDER BY support DESC, confidence DESC, proposal_id LIMIT 40), f AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY support DESC, confidence DESC, proposal_id) AS n FROM t WHERE rule <> 'Rule of 3 kinds')
    SELECT proposal_id, rule FROM f WHERE n = 1 ORDER BY support DESC, confidence DESC, proposal_id LIMIT 6"""
)
def proposals_select(spark, sf_dir):
    i = F.col("event_id")
    p = read(spark, sf_dir, "events").select(i.alias("proposal_id"), F.when(i % 3 == 0, "needs_review").otherwise("ready").alias("status"), (i % 40).alias("support"), (i % 9 / 10.0).alias("confidence"), F.concat(F.lit("Rule of "), (i % 17).cast("string"), F.lit(" kinds")).alias("rule"))
    return R.select_proposals(p, "we hold Rule of 3 kinds already", 40, 6).select("proposal_id", "rule")


def edits(spark, sf_dir) -> DataFrame:
    i = F.col("event_id")
    return read(spark, sf_dir, "events").select(i.alias("edit_id"), F.when(i % 3 == 0, "failure").otherwise("success").alias("source_type"), F.when(i % 2 == 0, "append").otherwise("replace").alias("op"), F.concat(F.lit("Must  check c"), (i % 7).cast("string"), F.lit(" of "), (i % 50).cast("string")).alias("content"), F.array((i % 9).cast("string")).alias("items"))


ED = "e AS (SELECT event_id AS edit_id, event_id % 3 = 0 AS failure, CASE WHEN event_id % 2 = 0 THEN 'append' ELSE 'replace' END AS op, 'Must  check c' || (event_id % 7) || ' of ' || (event_id % 50) AS content, (event_id % 9)::VARCHAR AS item FROM events)"


@query(f"WITH {ED} SELECT edit_id, op, content, (NOT failure)::INT::INTEGER AS urgency FROM e QUALIFY row_number() OVER (PARTITION BY op, content ORDER BY NOT failure, edit_id) = 1")
def edits_merge_patches(spark, sf_dir):
    """Failure edits before success edits, one of each fingerprint."""
    return R.merge_patches(edits(spark, sf_dir), "edit_id").select("edit_id", "op", "content", "urgency")


@query(f"WITH {ED} SELECT min(edit_id) AS edit_id, op, any_value(content) AS content, count(*) AS merged, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM e GROUP BY op, content")
def edits_dedupe(spark, sf_dir):
    return E.dedupe_edits(edits(spark, sf_dir)).select("edit_id", "op", "content", "merged", F.array_join("items", ",").alias("items"))


@query(f"WITH {ED}, {RES}, f AS (SELECT DISTINCT id, unnest(checks) AS c FROM r WHERE hard = 0), d AS (SELECT edit_id, lower(regexp_replace(content, ' +', ' ', 'g')) AS t FROM e), m AS (SELECT d.edit_id, c FROM d JOIN (SELECT DISTINCT c FROM f) k ON contains(t, lower(c))) SELECT edit_id, count(DISTINCT f.id) AS failures, min(f.id) AS first_id, array_to_string(list_sort(list(DISTINCT f.c)), ',') AS checks FROM m JOIN f USING (c) GROUP BY edit_id")
def edits_infer_traces(spark, sf_dir):
    """Which failures the edits speak of."""
    out = R.infer_traces(edits(spark, sf_dir), results(spark, sf_dir).where("hard = 0"))
    return out.withColumn("checks", F.array_join("checks", ","))


@query(f"WITH {ED}, {RES}, t AS (SELECT count(DISTINCT c) AS n FROM (SELECT unnest(checks) AS c FROM r WHERE hard = 0)), k AS (SELECT DISTINCT c FROM (SELECT unnest(checks) AS c FROM r WHERE hard = 0)), s AS (SELECT edit_id, round_even(count(c) / any_value(n) + 0.15 * (edit_id % 2), 4)::DOUBLE AS coverage FROM e LEFT JOIN k ON contains(lower(regexp_replace(content, ' +', ' ', 'g')), lower(c)), t GROUP BY edit_id) SELECT edit_id, coverage FROM s ORDER BY coverage DESC, edit_id LIMIT 20")
def edits_rank(spark, sf_dir):
    """Edits by the share of missed checks they name."""
    missed = results(spark, sf_dir).where("hard = 0").select(F.explode("missed_checks").alias("check"))
    ranked = E.rank_edits(edits(spark, sf_dir).withColumn("target", F.when(F.col("edit_id") % 2 == 1, "x")), missed, 20)
    return ranked.select("edit_id", "coverage")


@query("WITH c AS (SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN 'short' WHEN 1 THEN 'You must always verify item ' || event_id WHEN 2 THEN 'As an AI i must add a thing here' WHEN 3 THEN '- must keep the known rule here' ELSE 'plain words of no great meaning ' || event_id END AS c FROM events) SELECT id, CASE id % 5 WHEN 0 THEN 'too_short' WHEN 2 THEN 'leakage' WHEN 3 THEN 'duplicate' WHEN 4 THEN 'not_actionable' END AS problem, id % 5 = 1 AS valid FROM c")
def edits_validate(spark, sf_dir):
    """Valid edits and why others are refused."""
    i = F.col("event_id")
    c = F.when(i % 5 == 0, "short").when(i % 5 == 1, F.concat(F.lit("You must always verify item "), i.cast("string"))).when(i % 5 == 2, "As an AI i must add a thing here").when(i % 5 == 3, "- must keep the known rule here").otherwise(F.concat(F.lit("plain words of no great meaning "), i.cast("string")))
    rows = read(spark, sf_dir, "events").select(i.alias("id"), c.alias("content"), F.lit("# A\n- Must keep  the known rule here\n- other").alias("current"))
    return R.split_edits(rows).select("id", "problem", "valid")


# curves, evaluations, epochs


@query(
    f"""WITH {RES}, p AS (SELECT run, id AS seq, value AS selection_score, CASE WHEN id % 2 = 0 THEN soft END AS train_score, NULL::DOUBLE AS test_score, greatest(0, max(value) OVER (PARTITION BY run ORDER BY id)) AS best_score FROM r)
    SELECT run, seq, metric, value FROM (UNPIVOT p ON selection_score, train_score, test_score, best_score INTO NAME metric VALUE value)"""
)
def curve_series(spark, sf_dir):
    """Every metric's points and the best score so far."""
    points = results(spark, sf_dir).select("run", F.col("id").alias("seq"), F.col("value").alias("selection_score"), F.when(F.col("id") % 2 == 0, F.col("soft")).alias("train_score"), F.lit(None).cast("double").alias("test_score"))
    return R.curve_series(points)


@query(f"WITH {RES} SELECT run, count(*) AS items, round_even(avg(hard), 4)::DOUBLE AS pass_rate, round_even(avg(echo::INT), 4)::DOUBLE AS echo_rate, round_even(avg((answer = '')::INT), 4)::DOUBLE AS empty_rate, round_even(avg(soft), 4)::DOUBLE AS avg_soft FROM r GROUP BY run")
def curve_rollouts(spark, sf_dir):
    return R.rollout_metrics(results(spark, sf_dir), "run")


@query(f"WITH {RES}, l AS (SELECT run, id, value < lag(value) OVER (PARTITION BY run ORDER BY id) AS falls FROM r) SELECT run, NOT coalesce(bool_or(falls), false) AS monotonic, min(CASE WHEN falls THEN id END) AS first_fall FROM l GROUP BY run")
def curve_monotonic(spark, sf_dir):
    """Runs whose recorded best falls."""
    return R.best_never_falls(results(spark, sf_dir), "run", "id", "value")


@query(f"WITH {RES} SELECT count(*) AS points, count(*) FILTER (id % 3 = 0) AS rollouts, count(*) FILTER (id % 3 = 1) AS skips, count(*) FILTER (id % 4 = 0) AS rejects, count(*) FILTER (id % 4 IN (1, 2)) AS accepts, max(value) AS best FROM r")
def curve_summary(spark, sf_dir):
    i = F.col("id")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (i % len(xs) + 1).cast("int"))
    points = results(spark, sf_dir).select(pick("rollout", "skip", "init").alias("event"), pick("reject", "accept", "accept_new_best", "none").alias("gate_action"), F.col("value").alias("selection_score"))
    return L.curve_summary(points)


@query(
    f"""WITH {RES}, f AS (SELECT step, list_sort(list(id))[1:20] AS ids FROM r WHERE hard = 0 GROUP BY step), s AS (SELECT step, string_agg(scorer || '=' || n, ',' ORDER BY scorer) AS scorers FROM (SELECT step, scorer, count(*) AS n FROM r GROUP BY ALL) GROUP BY step)
    SELECT step, count(*) AS items, sum(hard)::BIGINT AS passed, round_even(avg(hard), 3)::DOUBLE AS hard, round_even(avg(soft), 3)::DOUBLE AS soft, any_value(array_to_string(ids, ',')) AS failed_ids, any_value(scorers) AS scorers FROM r JOIN f USING (step) JOIN s USING (step) GROUP BY step"""
)
def eval_summary(spark, sf_dir):
    out = R.eval_summary(results(spark, sf_dir), "step")
    return out.withColumn("failed_ids", F.array_join(F.transform("failed_ids", lambda x: x.cast("string")), ","))


@query(f"WITH {RES} SELECT id, CASE WHEN id % 2 = 0 THEN 'own' WHEN id % 3 = 0 THEN 'item' ELSE '' END AS question, task_type, hard, CASE WHEN id % 5 = 0 THEN 'late' ELSE '' END AS trace FROM r")
def eval_item_report(spark, sf_dir):
    """Results with their items' fields and last traces."""
    i, r = F.col("id"), results(spark, sf_dir)
    items = r.where("id % 3 = 0").select("id", F.lit("item").alias("question"), F.lit("t").alias("task_type"))
    traces = r.where("id % 5 = 0").select("id", F.explode(F.array(F.struct(F.lit(1).alias("seq"), F.lit("early").alias("trace")), F.struct(F.lit(2).alias("seq"), F.lit("late").alias("trace")))).alias("t")).select("id", "t.*")
    return R.item_report(r.withColumn("question", F.when(i % 2 == 0, "own")), items, traces)


@query(f"WITH {RES} SELECT run, count(*) FILTER (value < 25) AS improved, count(*) FILTER (value >= 25 AND value < 30) AS regressed, count(*) FILTER (value >= 30 AND value < 31) AS persistent_fail, count(*) FILTER (value >= 31) AS stable_success, bool_or(value < 31) AS actionable, bool_and(value >= 31) AS stable_only FROM r GROUP BY run")
def epoch_pair_counts(spark, sf_dir):
    v = F.col("value")
    pairs = results(spark, sf_dir).withColumn("state", F.when(v < 25, "improved").when(v < 30, "regressed").when(v < 31, "persistent_fail").otherwise("stable_success"))
    return R.pair_counts(pairs, "run")


@query("WITH b AS (SELECT event_id + 1 AS batch, 1 + event_id % 3 AS edits FROM events) SELECT (batch - 1) // 8 AS update, count(DISTINCT batch) AS batches, sum(edits)::BIGINT AS edits, count(DISTINCT batch) < 8 AS left_over FROM b GROUP BY 1")
def epoch_buffered(spark, sf_dir):
    """Updates of eight batches each, and what is left at an epoch's end."""
    i = F.col("event_id")
    return R.buffered(read(spark, sf_dir, "events").select((i + 1).alias("batch"), (i % 3 + 1).alias("edits")), 8)


@query(f"WITH {DIAG}, l AS (SELECT run, failure_type, id // 50 AS s, dense_rank() OVER (PARTITION BY run ORDER BY id // 50 DESC) AS p FROM d) SELECT run, failure_type, count(*) AS rejected, max(s) AS last_step FROM l WHERE p <= 5 GROUP BY ALL")
def epoch_buffer_summary(spark, sf_dir):
    """Failures of each kind in the last five steps of a run."""
    return R.buffer_summary(diagnoses(spark, sf_dir).select("run", "failure_type", F.floor(F.col("id") / 50).alias("step")))


@query(f"WITH {RES}, c AS (SELECT run, max(value) AS best, arg_max('h' || id, (value, -id)) AS hash FROM r GROUP BY run), o AS (SELECT r.run, arg_max('h' || r.id, (r.value, -r.id)) AS hash FROM r JOIN c ON r.run = c.run AND 'h' || r.id <> c.hash AND r.value >= c.best - 0.5 GROUP BY r.run) SELECT run, coalesce(o.hash, c.hash) AS parent FROM c LEFT JOIN o USING (run)")
def epoch_parent(spark, sf_dir):
    """The best other candidate within tolerance of each run's best."""
    r = results(spark, sf_dir).select("run", F.concat(F.lit("h"), F.col("id").cast("string")).alias("hash"), F.col("value").alias("score"), "id")
    current = r.groupBy("run").agg(F.max("score").alias("best_score"), F.min(F.struct(-F.col("score"), "id", "hash")).alias("b")).select("run", "best_score", F.col("b.hash").alias("current_hash"))
    return R.select_parent(r, current, 0.5)


@query(f"WITH {RES}, l AS (SELECT run, max(id) AS s FROM r GROUP BY run) SELECT run, s // 100 + (s % 5 = 4)::INT AS epoch, CASE WHEN s % 5 = 4 THEN 0 ELSE s % 5 + 1 END AS batch, s + 1 AS step FROM l")
def epoch_resume(spark, sf_dir):
    """Where each run goes on after its last checkpoint."""
    i = F.col("id")
    return R.resume_offsets(results(spark, sf_dir).select("run", i.alias("seq"), F.floor(i / 100).alias("epoch"), (i % 5).alias("batch"), i.alias("step"), F.lit(5).alias("batches")))


@query("WITH a AS (SELECT p_partkey AS k, p_size / 50.0 AS c, CASE WHEN p_partkey % 2 = 0 THEN 'accepted' ELSE 'candidate' END AS s, p_type AS t FROM part) SELECT k FROM a WHERE c >= 0.8 AND s = 'accepted' AND NOT contains(lower(t), 'steel') AND (contains(lower(t), 'brass') OR contains(lower(t), 'a'))")
def items_bootstrap(spark, sf_dir):
    """Confident accepted records that keywords admit."""
    a = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") / 50.0).alias("confidence"), F.when(F.col("p_partkey") % 2 == 0, "accepted").otherwise("candidate").alias("status"), "p_type")
    return R.confident_items(a).where(R.admitted(F.col("p_type"), ("Brass", "a"), ("STEEL",))).select("k")


@query("SELECT c_custkey AS id, 'old' AS origin FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 2 <> 0")
def items_merge(spark, sf_dir):
    """New training items beside the old ones of other ids."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return R.merge_items(c.where("id % 2 = 0").withColumn("origin", F.lit("old")), c.withColumn("origin", F.lit("new")))


@query("WITH m AS (SELECT event_type AS metric, max(value) FILTER (user_id % 2 = 0) AS baseline, max(value) FILTER (user_id % 2 = 1) AS candidate FROM events GROUP BY 1) SELECT metric, baseline, candidate, candidate - baseline AS change FROM m")
def runs_compare(spark, sf_dir):
    """Metrics of two runs side by side."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), F.concat(F.lit("run"), (F.col("user_id") % 2).cast("string")).alias("run"), "value")
    return R.compare_metrics(e, "run0", "run1")


@query("SELECT event_id, (event_id // 7)::BIGINT AS update FROM events WHERE event_id > 0")
def stream_batches(spark, sf_dir):
    """The update that a batch belongs to."""
    return read(spark, sf_dir, "events").where("event_id > 0").select("event_id", sync.batches_of(F.col("event_id") + 1, 7).cast("bigint").alias("update"))


@query("SELECT event_id, 'a x2 b' || event_id || chr(10) || 'end' AS text, 2 AS applied, 1 AS missed FROM events")
def edits_apply_batch(spark, sf_dir):
    """Edits in order on each text; one has no target there."""
    i = F.col("event_id").cast("string")
    edit = lambda op, target, content: F.struct(F.lit(op).alias("op"), target.alias("target"), content.alias("content"))
    batch = F.array(edit("replace", F.lit("x1"), F.lit("x2")), edit("delete", F.lit("gone"), F.lit("")), edit("append", F.lit(None).cast("string"), F.lit("end")))
    out = E.apply_edits(F.concat(F.lit("a x1 b"), i), batch)
    return read(spark, sf_dir, "events").select("event_id", out.alias("r")).select("event_id", "r.text", "r.applied", "r.missed")


@query("SELECT c_custkey AS doc, '# A|## Pay ' || c_custkey || '|## Last' AS headings, CASE WHEN c_custkey % 2 = 0 THEN '## Pay ' || c_custkey ELSE '## Last' END AS target, '# A' || chr(10) || '## Pay ' || c_custkey || chr(10) || 'x' || chr(10) || '## Last' AS bare, 'a,b,c' || c_custkey AS merged FROM customer")
def edits_sections(spark, sf_dir):
    """Headings of documents, where a rule goes, texts without code, and joined traces."""
    k = F.col("c_custkey")
    n = k.cast("string")
    text = F.concat(F.lit("# A\n## Pay "), n, F.lit("\n```java\n# no\n```\nx\n## Last"))
    bare = E.without_fences(text)
    merged = E.merge_traces(F.array(F.lit("b"), F.concat(F.lit("c"), n)), F.array(F.lit("a"), F.lit("b")))
    return read(spark, sf_dir, "customer").select(k.alias("doc"), F.array_join(E.headings(bare), "|").alias("headings"), E.insert_target(bare, F.when(k % 2 == 0, "PAY").otherwise("none")).alias("target"), bare.alias("bare"), F.array_join(merged, ",").alias("merged"))


@query(f"WITH {ED} SELECT edit_id FROM e WHERE NOT failure AND edit_id % 10 >= 6")
def edits_knowledge(spark, sf_dir):
    """Success edits of enough support."""
    return R.knowledge_edits(edits(spark, sf_dir).withColumn("support_count", F.col("edit_id") % 10), 6).select("edit_id")


@query(f"WITH {RES} SELECT step, CASE WHEN echo THEN 'prompt_echo' ELSE '' END AS reason, count(*) AS results FROM r GROUP BY ALL")
def run_hygiene_summary(spark, sf_dir):
    return R.hygiene_summary(results(spark, sf_dir).withColumn("hygiene_reason", F.when(F.col("echo"), "prompt_echo")), "step")


@query(f"WITH {RES}, f AS (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY id) AS n FROM r WHERE hard = 0) SELECT task_type, n::INTEGER AS place, id, '- When asked: question of ' || id || '; cover ' || array_to_string(checks, ', ') AS line FROM f WHERE n <= 5")
def run_scenario_lines(spark, sf_dir):
    return R.scenario_lines(results(spark, sf_dir).where("hard = 0"), "task_type")


@query("WITH f AS (SELECT user_id AS id, event_type || ' ' || event_id AS st, (event_id % 20) / 20.0 AS c FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, st) AS n FROM f) SELECT id, string_agg('- ' || st || ' (' || printf('%.2f', c) || ')', chr(10) ORDER BY n) AS text FROM n WHERE n <= 5 GROUP BY id")
def run_fact_texts(spark, sf_dir):
    """Each user's surest facts as text."""
    i = F.col("event_id")
    return R.fact_texts(read(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.concat_ws(" ", "event_type", i.cast("string")).alias("statement"), (i % 20 / 20.0).alias("confidence")))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Context:' || chr(10) || event_type WHEN 1 THEN 'Read before answering: a, ' || event_type ELSE '' END AS context, 'b,' || event_type AS checks FROM events")
def run_context_texts(spark, sf_dir):
    """What items are given to read, and the checks that say something."""
    i = F.col("event_id")
    mode = F.when(i % 3 == 0, "inline").when(i % 3 == 1, "agent_read").otherwise("none")
    checks = R.semantic_checks(F.array(F.lit("1,200"), F.lit("b"), F.lit("Format"), F.col("event_type"), F.lit("b")), ("format",))
    return read(spark, sf_dir, "events").select("event_id", R.context_text(mode, F.array(F.lit("a"), F.col("event_type")), F.col("event_type")).alias("context"), F.array_join(checks, ",").alias("checks"))


@query("WITH m AS (SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM events), a AS (SELECT *, value > greatest(coalesce(p, 0), 0) AS accept FROM m), l AS (SELECT user_id, max(CASE WHEN accept THEN event_id END) AS last FROM a GROUP BY user_id) SELECT user_id, count(*) FILTER (accept) AS accepts, count(*) FILTER (NOT accept) AS rejects, (count(*) FILTER (event_id > coalesce(last, -1)))::INTEGER AS in_a_row FROM a JOIN l USING (user_id) GROUP BY user_id")
def event_gate_stats(spark, sf_dir):
    """Accepts and rejects of each user's gate, and rejects in a row at its end."""
    steps = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return R.gate_stats(S.gate_fold(steps, "user_id", "event_id", "value"), "user_id", "event_id")


@query("SELECT p_brand AS repo, ['java', 'go', ''][(p_partkey % 3 + 1)::INT] AS language, 'source' AS kind, count(*) AS files, sum(p_size)::BIGINT AS bytes FROM part GROUP BY ALL")
def run_static_counts(spark, sf_dir):
    k = F.col("p_partkey")
    language = F.when(k % 3 == 0, "java").when(k % 3 == 1, "go").otherwise("")
    return R.static_counts(read(spark, sf_dir, "part").select(F.col("p_brand").alias("repo"), language.alias("language"), F.lit("source").alias("kind"), F.col("p_size").cast("bigint").alias("size_bytes")))


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN 'general' ELSE p_brand END AS domain, count(*) AS records, round_even(avg(p_size / 50.0), 3)::DOUBLE AS confidence FROM part GROUP BY 1")
def atoms_by_domain(spark, sf_dir):
    a = read(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 4 > 0, F.create_map(F.lit("domain"), F.col("p_brand"))).alias("applicability"), (F.col("p_size") / 50.0).alias("confidence"))
    return R.by_domain(a)
