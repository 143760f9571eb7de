"""Queries of samples, slow updates, checkpoints and evidence under a budget; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import epochs as P
from ..operators import evidence as V
from ..operators.graph import shared_folder
from .text_queries import read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


SAMPLED = "s AS (SELECT * FROM (SELECT o_custkey AS epoch, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('7:' || o_custkey || ':' || o_orderkey), o_orderkey) AS rn FROM orders) WHERE rn <= 5)"


@query(f"WITH {SAMPLED} SELECT epoch, id FROM s")
def epoch_samples(spark, sf_dir):
    """Five orders of every customer, drawn by keyed hash."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("epoch"), F.col("o_orderkey").alias("id"))
    return P.epoch_sample(orders, 7, 5)


@query(
    f"""WITH {SAMPLED}, h AS (SELECT o_custkey AS epoch, o_orderkey AS id, (o_orderstatus = 'F')::INT AS a, (o_totalprice > 150000 OR o_custkey % 9 = 0)::INT AS b FROM orders),
    c AS (SELECT epoch, count(*) AS sampled, count(*) FILTER (a = 0 AND b = 1) AS improved, count(*) FILTER (a = 1 AND b = 0) AS regressed, count(*) FILTER (a = 0 AND b = 0) AS persistent_fail, count(*) FILTER (a = 1 AND b = 1) AS stable_success FROM s JOIN h USING (epoch, id) GROUP BY epoch),
    k AS (SELECT c_custkey AS epoch, 'skill ' || c_name AS previous, CASE WHEN c_custkey % 4 = 0 THEN 'skill ' || c_name || ' ' ELSE 'new skill ' || c_mktsegment END AS current, CASE c_custkey % 5 WHEN 0 THEN 'Check totals of ' || c_name WHEN 1 THEN 'No changes needed for ' || c_name END AS suggestion FROM customer),
    d AS (SELECT k.*, coalesce(sampled, 0) AS sampled, coalesce(improved, 0) AS improved, coalesce(regressed, 0) AS regressed, coalesce(persistent_fail, 0) AS persistent_fail, coalesce(stable_success, 0) AS stable_success FROM k LEFT JOIN c USING (epoch)),
    x AS (SELECT *, CASE WHEN sampled = 0 THEN 'skip' WHEN stable_success = sampled THEN 'skip_stable_success_only' WHEN epoch % 5 = 0 THEN 'suggested' WHEN epoch % 5 = 1 THEN 'skip_non_actionable' WHEN epoch % 4 = 0 THEN 'skip_no_change' ELSE 'rule_based' END AS action FROM d)
    SELECT epoch, sampled, improved, regressed, persistent_fail, stable_success, action, CASE action WHEN 'suggested' THEN suggestion WHEN 'rule_based' THEN '## Epoch Transition Summary' || chr(10) || 'Skill evolved from ' || len(previous) || ' → ' || len(current) || ' chars.' || chr(10) || 'Evaluated on ' || sampled || ' sampled tasks.' || chr(10) || 'Review the differences for regression and improvement patterns.' ELSE '' END AS content FROM x"""
)
def epoch_slow_update(spark, sf_dir):
    """What the sampled orders of every customer say about going on with a new skill."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    results = lambda hard: o.select(F.col("o_custkey").alias("epoch"), F.col("o_orderkey").alias("id"), hard.cast("int").alias("hard"))
    before, after = results(F.col("o_orderstatus") == "F"), results((F.col("o_totalprice") > 150000) | (F.col("o_custkey") % 9 == 0))
    k = F.col("c_custkey")
    previous = F.concat(F.lit("skill "), F.col("c_name"))
    current = F.when(k % 4 == 0, F.concat(previous, F.lit(" "))).otherwise(F.concat(F.lit("new skill "), F.col("c_mktsegment")))
    suggestion = F.when(k % 5 == 0, F.concat(F.lit("Check totals of "), F.col("c_name"))).when(k % 5 == 1, F.concat(F.lit("No changes needed for "), F.col("c_name")))
    skills = c.select(k.alias("epoch"), previous.alias("previous"), current.alias("current"), suggestion.alias("suggestion"))
    return P.slow_update(P.epoch_sample(before, 7, 5), before, after, skills)


@query(
    """WITH e AS (SELECT 'run' || user_id AS run, event_id, value, 'skill_v' || lpad(event_id::VARCHAR, 9, '0') AS name, 'text ' || event_id AS text, event_id % 5 <> 0 AS kept FROM events), l AS (SELECT run, max(event_id) AS step, arg_max(name, event_id) AS cur FROM e GROUP BY run),
    b AS (SELECT run, arg_max(name, (value, event_id)) AS best FROM e GROUP BY run), v AS (SELECT run, arg_max(text, name) AS last FROM e WHERE kept GROUP BY run), i AS (SELECT 'run' || u AS run, 'start ' || u AS skill FROM (SELECT DISTINCT user_id AS u FROM events UNION SELECT -1)),
    j AS (SELECT i.run, coalesce(eb.text, skill) AS best, coalesce(ec.text, v.last, eb.text, skill) AS current, coalesce(step, 0) AS step FROM i LEFT JOIN l USING (run) LEFT JOIN b USING (run) LEFT JOIN v USING (run) LEFT JOIN e eb ON eb.run = i.run AND eb.name = b.best AND eb.kept LEFT JOIN e ec ON ec.run = i.run AND ec.name = l.cur AND ec.kept)
    SELECT run, current, best, step, step // 100 AS epoch, step % 100 AS next_batch FROM j"""
)
def epoch_resume_runs(spark, sf_dir):
    """Where every user's run goes on after three checkpoints, some of whose skills are missing; and a run that never began."""
    e = read(spark, sf_dir, "events").withColumn("run", F.concat(F.lit("run"), s(F.col("user_id")))).withColumn("name", F.concat(F.lit("skill_v"), F.lpad(s(F.col("event_id")), 9, "0")))
    store = P.checkpoints(spark, f"{shared_folder(spark)}/runs")
    third = F.floor(F.col("event_id") * 3 / (e.agg(F.max("event_id")).first()[0] + 1))
    for number in range(3):
        so_far = e.where(third <= number)
        best = F.max_by(F.struct("name", "value", "event_id"), F.struct("value", "event_id"))
        rows = so_far.groupBy("run").agg(F.max("event_id").alias("step"), F.max_by(F.struct("name", "value"), "event_id").alias("c"), best.alias("b"))
        rows = rows.join(e.where(third == number).select("run").distinct(), "run", "left_semi")
        states = rows.select("run", "step", F.col("c.value").alias("current_score"), F.col("b.value").alias("best_score"), F.col("b.event_id").alias("best_step"), F.col("c.name").alias("current_skill"), F.col("b.name").alias("best_skill"), F.floor(F.col("step") / 100).alias("epoch"), (F.col("step") % 100).alias("next_batch"), F.lit("{}").alias("internal"))
        P.save_states(store, number, states, e.where((third == number) & (F.col("event_id") % 5 != 0)).select("run", "name", F.concat(F.lit("text "), s(F.col("event_id"))).alias("text")))
    users = e.select("user_id").distinct().unionByName(e.select(F.lit(-1).cast("bigint").alias("user_id")).limit(1))
    initial = users.select(F.concat(F.lit("run"), s(F.col("user_id"))).alias("run"), F.concat(F.lit("start "), s(F.col("user_id"))).alias("skill"))
    return P.resume(store, initial)


@query(
    r"""WITH f AS (SELECT conv_id AS step, turn AS id, text, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations), c AS (SELECT * FROM f WHERE n <= 5),
    r AS (SELECT step, id, place, (conv + place) % 60 AS doc FROM (SELECT step, id, n, step * 7 + id AS conv, unnest([0, 1]) AS place FROM c) WHERE id % 4 <> 3),
    d AS (SELECT doc_id AS doc, text FROM documents),
    p AS (SELECT step, id, 0 AS src, place, 'index ' || doc AS t FROM r WHERE doc % 10 = 0 UNION ALL
      SELECT step, id, 1, place, CASE WHEN doc % 3 = 0 THEN '**Symbol** `S' || doc || '`' ELSE '**File** `d/' || doc || '`:' END || chr(10) || '```' || chr(10) || left(text, CASE WHEN doc % 3 = 0 THEN 600 ELSE 1200 END) || chr(10) || '```' FROM r JOIN d USING (doc) WHERE text <> ''),
    q AS (SELECT * FROM p UNION ALL SELECT step, id, 2, 0, left('found ' || id, 800) FROM c WHERE (step, id) NOT IN (SELECT (step, id) FROM p)),
    b AS (SELECT step, id, string_agg(t, chr(10) ORDER BY src, place) AS body FROM q GROUP BY step, id),
    k AS (SELECT c.step, c.id, n, '### Case ' || c.id || ': ' || left(text, 120) || chr(10) || 'missed checks: ' || role || ', ' || c.id || coalesce(chr(10) || body, '') AS block FROM c LEFT JOIN b USING (step, id)),
    u AS (SELECT *, sum(len(block)) OVER (PARTITION BY step ORDER BY n) AS used FROM k)
    SELECT step, sha256('## Code Evidence (from project graph)' || chr(10) || chr(10) || string_agg(block, chr(10) || chr(10) ORDER BY n)) AS digest, count(*) AS blocks FROM u WHERE used <= 4500 GROUP BY step"""
)
def reflect_reports(spark, sf_dir):
    """Evidence reports of all conversations as failed cases, with references into the documents, up to the first block over the budget."""
    t, d = read(spark, sf_dir, "conversations"), read(spark, sf_dir, "documents")
    doc = lambda place: (F.col("conv_id") * 7 + F.col("turn") + place) % 60
    ref = lambda place: F.concat(F.lit("d/"), s(doc(place)), F.when(doc(place) % 3 == 0, F.concat(F.lit("#S"), s(doc(place)))).otherwise(""))
    refs = F.when(F.col("turn") % 4 != 3, F.array(ref(0), ref(1))).otherwise(F.array().cast("array<string>"))
    failed = t.select(F.col("conv_id").alias("step"), F.col("turn").alias("id"), F.col("turn").alias("place"), F.col("text").alias("question"), F.array(F.col("role"), s(F.col("turn"))).alias("missed_checks"), refs.alias("context_refs"))
    path = F.concat(F.lit("d/"), s(F.col("doc_id")))
    files, cards = d.select(path.alias("path"), "text"), d.select(path.alias("file_path"), F.concat(F.lit("S"), s(F.col("doc_id"))).alias("symbol"), "text").where("text <> ''")
    index = d.where("doc_id % 10 = 0").select(F.concat(path, F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("#S"), s(F.col("doc_id")))).otherwise("")).alias("ref"), F.concat(F.lit("index "), s(F.col("doc_id"))).alias("text"))
    found = t.select("turn").distinct().select(F.col("turn").alias("id"), F.lit(0).alias("place"), F.concat(F.lit("found "), s(F.col("turn"))).alias("text"))
    texts, _ = V.reflect_evidence(failed, index, files, cards, found)
    return texts.select("step", F.sha2("text", 256).alias("digest"), (F.size(F.split("text", "### Case ")) - 1).cast("bigint").alias("blocks"))
