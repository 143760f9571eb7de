"""Queries of proposals and patches, run reports, files that are written and read back, and retrieval; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import proposals as P
from ..operators import reports as Q
from ..operators import retrieval as V
from ..operators import surface as U
from ..sources import files as SRC
from .code_queries import java_files, java_graph
from .text_queries import read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Orders as traces: a step a customer, a task a priority


def traces(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    points = F.array(F.col("o_orderstatus"), F.concat(F.lit("p"), s(k % 3)), s(F.floor("o_totalprice")))
    return o.select(F.col("o_custkey").alias("step"), k.alias("id"), F.col("o_orderpriority").alias("task_type"), (F.col("o_orderstatus") != "F").cast("int").alias("hard"), F.concat(F.lit("order "), s(k), F.when(k % 2 == 0, " with a longer question about its items and totals").otherwise("")).alias("question"), F.when(k % 4 != 1, points).alias("passed_checks"), F.array(F.lit("Total"), F.lit("note")).alias("expected_checks"), F.when(k % 5 == 0, F.array(F.concat(F.lit("r"), s(k)))).alias("context_refs"))


TRACES = "t AS (SELECT o_custkey AS step, o_orderkey AS id, o_orderpriority AS task, o_orderstatus AS st, o_totalprice AS price FROM orders)"
LINE = """'- 对于「' || left('order ' || id || CASE WHEN id % 2 = 0 THEN ' with a longer question about its items and totals' ELSE '' END, 48) || CASE WHEN id % 2 = 0 THEN '...' ELSE '' END || '」这类场景，保留成功输出模式：业务要点包括「' || CASE WHEN id % 4 = 1 THEN 'Total' ELSE st || '、p' || (id % 3) END || '」' || CASE WHEN id % 5 = 0 THEN '; ref r' || id ELSE '' END || '.'"""
SUCCESS = f"""m AS (SELECT *, row_number() OVER (PARTITION BY step, task ORDER BY id) AS n, {LINE} AS line FROM t WHERE st <> 'F'),
    sp AS (SELECT step, 'prop-step' || lpad(step::VARCHAR, greatest(4, len(step::VARCHAR))::INTEGER, '0') || '-success-' || task AS pid, 'success' AS src, count(*) AS support, '### Scenario rules' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY n) FILTER (n <= 5) AS rule, round_even(least(0.9, 0.4 + 0.08 * count(*)), 3)::DOUBLE AS conf, 'ready' AS status FROM m GROUP BY step, task HAVING count(*) >= 2)"""
FAILURE = """fp AS (SELECT step, 'prop-step' || lpad(step::VARCHAR, greatest(4, len(step::VARCHAR))::INTEGER, '0') || '-f' || task AS pid, 'failure' AS src, count(*) AS support, 'When handling ' || task || ' tasks, ensure the answer satisfies: ' || array_to_string(list_sort(list(DISTINCT 'p' || (id % 3))), ', ') || '.' AS rule, round_even(least(0.95, 0.5 + 0.1 * count(*)), 3)::DOUBLE AS conf, CASE WHEN count(*) >= 2 THEN 'ready' ELSE 'needs_review' END AS status FROM t WHERE st = 'F' GROUP BY step, task)"""


def clusters(spark, sf_dir):
    t = traces(spark, sf_dir).where("hard = 0")
    missed = F.array_sort(F.collect_set(F.concat(F.lit("p"), s(F.col("id") % 3))))
    return t.groupBy("step", "task_type").agg(F.count("*").alias("support"), missed.alias("missed_checks"), F.array_sort(F.collect_list(s(F.col("id")))).alias("trace_ids")).withColumn("cluster_id", F.concat(F.lit("f"), F.col("task_type")))


def proposed(spark, sf_dir):
    return P.from_failures(clusters(spark, sf_dir)).unionByName(P.from_successes(traces(spark, sf_dir), ignored=("note",)))


@query(f"WITH {TRACES}, {SUCCESS}, {FAILURE} SELECT pid AS proposal_id, support, rule, conf AS confidence, status FROM sp UNION ALL SELECT pid, support, rule, conf, status FROM fp")
def proposals_of_steps(spark, sf_dir):
    """Rules proposed from every customer's failed and passed orders."""
    return proposed(spark, sf_dir).select("proposal_id", "support", "rule", "confidence", "status")


EDITS = f"""{TRACES}, {SUCCESS}, {FAILURE}, a AS (SELECT * FROM sp UNION ALL SELECT * FROM fp), r AS (SELECT *, row_number() OVER (PARTITION BY step, src ORDER BY support DESC, conf DESC, pid) AS n FROM a WHERE status = 'ready'),
    k AS (SELECT * FROM r WHERE n <= 3 AND NOT (src = 'failure' AND step % 7 = 0 AND contains(pid, '-f1-'))), e AS (SELECT *, row_number() OVER (PARTITION BY step, src ORDER BY n) AS place FROM k QUALIFY place <= 2)"""


def edits(spark, sf_dir):
    """Edits for skills that hold the rule of urgent failures already for some customers."""
    all_ = proposed(spark, sf_dir)
    known = all_.where("step % 7 = 0 and proposal_id like '%-f1-%'").select("step", F.concat(F.lit("# Skill\n"), F.col("rule"), F.lit("\n")).alias("skill"))
    return all_, P.to_edits(all_, known, 3, 2)


@query(
    f"""WITH {EDITS}, g AS (SELECT step, src, count(*) AS given FROM a GROUP BY ALL) SELECT e.step, e.src AS source_type, 'trace_cluster_merge (' || count(*) || ' edits from ' || any_value(given) || ' proposals)' AS reasoning, sha256(string_agg(rule, '|' ORDER BY place)) AS digest
    FROM e JOIN g ON e.step = g.step AND e.src = g.src GROUP BY e.step, e.src"""
)
def proposals_to_patches(spark, sf_dir):
    """Patches of every customer's proposals."""
    all_, made = edits(spark, sf_dir)
    return P.to_patches(made, all_).select("step", "source_type", "reasoning", F.sha2(F.array_join("contents", "|"), 256).alias("digest"))


@query(
    f"""WITH {EDITS}, f AS (SELECT step, src, place, upper(rule) || '  ' AS rule, 0 AS o FROM e WHERE place = 2 UNION ALL SELECT o_custkey, 'failure', 9, 'Look at ' || max(o_orderkey), 0 FROM orders GROUP BY o_custkey),
    b AS (SELECT * FROM f UNION ALL SELECT step, src, place, rule, 1 FROM e WHERE (step, src, place) NOT IN (SELECT (step, src, 2) FROM f WHERE place = 2))
    SELECT step, src AS source_type, CASE o WHEN 0 THEN 'reflected' ELSE 'proposed' END AS origin, row_number() OVER (PARTITION BY step, src ORDER BY o, place)::INTEGER AS place, sha256(rule) AS digest FROM b"""
)
def proposals_beside_reflected(spark, sf_dir):
    """Proposed edits beside reflected ones, some of which say the same in capitals."""
    _, made = edits(spark, sf_dir)
    own = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("step")).agg(F.concat(F.lit("Look at "), s(F.max("o_orderkey"))).alias("content"))
    reflected = made.where("place = 2").select("step", "source_type", "place", F.concat(F.upper("content"), F.lit("  ")).alias("content")).unionByName(own.select("step", F.lit("failure").alias("source_type"), F.lit(9).alias("place"), "content"))
    return P.beside_reflected(reflected, made).select("step", "source_type", "origin", "place", F.sha2("content", 256).alias("digest"))


# Run reports


@query(
    """WITH l AS (SELECT user_id AS run, event_id AS step, event_id // 50 AS epoch, value, event_type AS t FROM events), a AS (SELECT *, CASE WHEN step % 10 = 1 THEN 'accept' WHEN step % 4 = 0 THEN 'reject' WHEN t = 'purchase' THEN 'accept_new_best' END AS action, CASE WHEN step % 10 = 1 THEN value + 1 WHEN step % 4 = 0 THEN value / 2 ELSE value END AS score FROM l)
    SELECT run, step, epoch, CASE WHEN action IS NULL THEN 'skip' ELSE 'gate' END AS event, action AS gate_action, round_even(score, 4) AS selection_gate, round_even(max(CASE WHEN starts_with(action, 'accept') THEN score END) OVER w, 4) AS best_score, round_even(last_value(CASE WHEN starts_with(action, 'accept') THEN score END IGNORE NULLS) OVER w, 4) AS current_score,
      CASE WHEN step % 4 = 0 THEN step % 5 END AS edit_count FROM a WINDOW w AS (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING)"""
)
def curve_backfill(spark, sf_dir):
    """Curves of all users from the lines their runs logged, with histories and gate reports of some steps."""
    e = read(spark, sf_dir, "events")
    i = F.col("event_id")
    lines = F.array(F.concat(F.lit("epoch "), s(F.floor(i / 50)), F.lit(" step "), s(i)), F.concat(F.lit("done; score="), s(F.col("value")), F.when(F.col("event_type") == "purchase", " gate=accept_new_best").otherwise("")))
    log = e.select(F.col("user_id").alias("run"), i.alias("_i"), F.posexplode(lines).alias("n", "line")).select("run", (F.col("_i") * 2 + F.col("n")).alias("line_no"), "line")
    history = e.where(i % 4 == 0).select(F.col("user_id").alias("run"), i.alias("step"), F.lit("reject").alias("action"), (F.col("value") / 2).alias("score"), (i % 5).alias("edit_count"))
    gates = e.where(i % 10 == 1).select(F.col("user_id").alias("run"), i.alias("step"), F.lit("accept").alias("action"), (F.col("value") + 1).alias("score"))
    found = Q.backfilled(SRC.parse_run_log(log), history, gates)
    return found.select("run", F.col("step").cast("bigint").alias("step"), F.col("epoch").cast("bigint").alias("epoch"), "event", "gate_action", "selection_gate", "best_score", "current_score", "edit_count")


@query("SELECT user_id AS run, concat_ws('|', ts::VARCHAR, event_type, event_id, '', '', '', '', '', '', '', '', value, '', '', CASE WHEN event_id % 3 = 0 THEN 'accept' ELSE '' END, '', '', '', '', '', '', '') AS line FROM events")
def curve_columns(spark, sf_dir):
    """All events as curve points, in the columns that a curve has."""
    e = read(spark, sf_dir, "events")
    points = e.select(F.col("user_id").alias("run"), "ts", F.col("event_type").alias("event"), F.col("event_id").alias("step"), F.col("value").alias("selection_gate"), F.when(F.col("event_id") % 3 == 0, "accept").alias("gate_action"), F.col("props").alias("not_a_column"))
    return Q.curve_table(points).select("run", F.concat_ws("|", *Q.CURVE).alias("line"))


@query(
    """WITH e AS (SELECT user_id AS run, event_id AS i, event_type AS t, value FROM events), n AS (SELECT run, t, count(*) AS n FROM e GROUP BY ALL), p AS (SELECT run, string_agg(t || '=' || n, ',' ORDER BY n DESC, t) AS top FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY run ORDER BY n DESC, t) <= 5) GROUP BY run)
    SELECT run, count(*) AS steps, count(*) FILTER (i % 2 = 0) AS query_plans, sum(i % 7)::BIGINT AS candidates, sum(i % 3)::BIGINT AS facts, sum(i % 2)::BIGINT AS cases_with_facts, round_even(sum(i % 2) / greatest(sum(i % 4), 1), 3)::DOUBLE AS facts_rate, round_even(sum(i % 7) / greatest(sum(i % 4), 1), 1)::DOUBLE AS candidates_per_case,
      any_value(top) AS top_sources, round_even(sum((i % 5 = 0)::INT) / count(*), 3)::DOUBLE AS glue_first_rate FROM e JOIN p USING (run) GROUP BY run"""
)
def report_retrieval(spark, sf_dir):
    """Retrieval totals and rates of every user's steps."""
    e = read(spark, sf_dir, "events")
    i = F.col("event_id")
    steps = e.select(F.col("user_id").alias("run"), F.when(i % 2 == 0, 1).alias("plans"), (i % 7).alias("candidates"), (i % 3).alias("facts"), (i % 4).alias("cases"), (i % 2).alias("cases_with_facts"), (i % 5 == 0).cast("int").alias("glue_first"))
    found = Q.retrieval_metrics(steps, e.select(F.col("user_id").alias("run"), F.col("event_type").alias("source"), F.lit(1).alias("n")))
    return found.drop("facts_per_case")


@query(
    """WITH c AS (SELECT c_custkey AS run, 'start ' || c_name AS initial, '# ' || c_name || chr(10) || chr(10) || '- rule of ' || c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || '- rule of ' || c_mktsegment ELSE '' END AS best, c_acctbal FROM customer),
    f AS (SELECT run, NOT coalesce(bool_or(falls), false) AS monotonic FROM (SELECT o_custkey AS run, o_totalprice < lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS falls FROM orders) GROUP BY run),
    t AS (SELECT o_custkey AS run, round_even(avg((o_orderstatus = 'O')::INT), 3)::DOUBLE AS test_hard, count(*) FILTER (o_orderstatus <> 'O') AS hard_failures FROM orders GROUP BY 1),
    g AS (SELECT run, string_agg(id::VARCHAR, ', ' ORDER BY id) AS ids FROM (SELECT o_custkey AS run, o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 5) GROUP BY run)
    SELECT run, len(initial)::INTEGER AS initial_chars, len(best)::INTEGER AS best_chars, round_even(c_acctbal, 3) AS best_score, coalesce(test_hard, 0) AS test_hard, coalesce(monotonic, true) AS monotonic, (run % 3 = 0)::INTEGER AS duplicate_rules, coalesce(hard_failures, 0) AS hard_failures,
      concat_ws('|', 'Replay regression on: ' || ids, CASE WHEN NOT monotonic THEN 'Do not overwrite best during knowledge_accept.' END) AS recommendations FROM c LEFT JOIN f USING (run) LEFT JOIN t USING (run) LEFT JOIN g USING (run)"""
)
def report_quality(spark, sf_dir):
    """A quality report for every customer as a run, its orders as points, tests and replays."""
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    rule = F.concat(F.lit("- rule of "), F.col("c_mktsegment"))
    best = F.concat(F.lit("# "), F.col("c_name"), F.lit("\n\n"), rule, F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("\n"), rule)).otherwise(""))
    runs = c.select(F.col("c_custkey").alias("run"), F.concat(F.lit("start "), F.col("c_name")).alias("initial"), best.alias("best"), F.col("c_acctbal").alias("best_score"))
    run = F.col("o_custkey").alias("run")
    points = o.select(run, F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("best"))
    tested = o.select(run, F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").cast("int").alias("hard"), F.lit(0.5).alias("soft"))
    replayed = o.select(run, F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "P").alias("regressed"))
    found = Q.quality_report(runs, points, tested, replayed)
    return found.select("run", "initial_chars", "best_chars", "best_score", "test_hard", "monotonic", "duplicate_rules", "hard_failures", F.array_join("recommendations", "|").alias("recommendations"))


# Files that are written and read back


@query("SELECT 'lang=' || lang AS folder, 'doc' AS kind, sum(strlen(text) + 1)::BIGINT AS bytes FROM documents WHERE text IS NOT NULL GROUP BY lang")
def files_scanned(spark, sf_dir):
    """A tree of text files, a folder a language, by folder and kind; what a scan leaves out is put beside."""
    base = G.shared_folder(spark)
    texts = read(spark, sf_dir, "documents").where("text is not null").select("lang", "text")
    out = texts.select("lang", F.col("text").alias("value"))
    out.write.partitionBy("lang").text(f"{base}/tree")
    for folder in ("node_modules", "build"):
        out.select("value").write.text(f"{base}/tree/{folder}")
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/tree").count()
    found = SRC.scan_repository(spark, base.removeprefix("file:") + "/tree", include=("lang=*",)) if parts else None
    return found.groupBy(F.split("path", "/")[0].alias("folder"), "kind").agg(F.sum("size_bytes").alias("bytes"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def ledger_jsonl(spark, sf_dir):
    """All events from a ledger of JSON lines, among lines that are cut off."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    base = G.shared_folder(spark)
    whole = e.select("event_id", F.to_json(F.struct(*e.columns)).alias("value"))
    cut = whole.where("event_id % 5 = 0").select("event_id", F.expr("substring(value, 1, length(value) - 7)").alias("value"))
    whole.unionByName(cut).select("value").write.text(f"{base}/ledger")
    return SRC.read_jsonl(spark, f"{base}/ledger", e.schema.simpleString()[7:-1].replace(":", " "))


@query("SELECT 'i' || item_id AS id, left(text, 40) AS question, ['train', 'selection', 'test'][(item_id % 3 + 1)::INT] AS split FROM benchmark")
def splits_loaded(spark, sf_dir):
    """Benchmark items from the files of three splits."""
    base = G.shared_folder(spark)
    items = read(spark, sf_dir, "benchmark").select((F.col("item_id") % 3).alias("part"), F.struct(F.concat(F.lit("i"), s(F.col("item_id"))).alias("id"), F.substring("text", 1, 40).alias("question")).alias("item"))
    out = None
    for part, split in enumerate(("train", "selection", "test")):
        items.where(F.col("part") == part).agg(F.to_json(F.struct(F.collect_list("item").alias("items"))).alias("value")).write.text(f"{base}/{split}/items.json")  # a split is one file
        one = SRC.read_split(spark, base, split, "id string, question string")
        out = one if out is None else out.unionByName(one)
    return out


# Retrieval over the generated repository

AT = "p AS (SELECT p_partkey AS k, 'src/m' || (p_partkey % 10) || '/Part' || p_partkey || '.java' AS path FROM part)"


def asked(spark, sf_dir):
    """Items that refer to every part's method, and evidence for some of these references."""
    k = F.col("p_partkey")
    path = F.concat(F.lit("src/m"), s(k % 10), F.lit("/Part"), s(k), F.lit(".java"))
    p = read(spark, sf_dir, "part")
    ref = F.concat(path, F.lit("#run"), s(k))
    items = p.select(s(k).alias("id"), F.lit("how so").alias("question"), F.array(ref).alias("context_refs"), F.array().cast("array<string>").alias("expected_checks"))
    evidence = p.where(k % 2 == 0).select(ref.alias("ref"), F.concat(path, F.lit("::Part"), s(k)).alias("node_id"))
    return items, evidence


@query(
    f"""WITH {AT}, c AS (SELECT k, path || '::run' || k AS candidate_id, 0.585::DOUBLE AS score, 'context_ref' AS source FROM p UNION ALL SELECT a.k, b.path || '::run' || b.k, 0.275, 'trace' FROM p a JOIN p b ON b.k = a.k + 1 UNION ALL SELECT k, path || '::Part' || k, 0.175, 'evidence_index' FROM p WHERE k % 2 = 0)
    SELECT k::VARCHAR AS query_id, candidate_id, source, score, row_number() OVER (PARTITION BY k ORDER BY score DESC)::INTEGER AS rank FROM c"""
)
def retrieval_ranked(spark, sf_dir):
    """Candidates for every item by anchors, calls and evidence, ranked."""
    items, evidence = asked(spark, sf_dir)
    files, nodes, edges = java_graph(spark, sf_dir)
    return V.retrieve(items, files, nodes, edges, evidence)[0].select("query_id", "candidate_id", "source", "score", "rank")


@query(f"WITH {AT} SELECT k::VARCHAR AS id, 'run' || k || ' calls run' || k || ', run' || (k + 1) AS statement, 0.95::DOUBLE AS confidence FROM p")
def retrieval_facts(spark, sf_dir):
    """What the best candidate's body says of every item."""
    items, evidence = asked(spark, sf_dir)
    files, nodes, edges = java_graph(spark, sf_dir)
    return V.retrieve(items, files, nodes, edges, evidence)[1].select("id", "statement", "confidence")


@query(f"WITH {AT} SELECT k AS query_id, CASE WHEN k % 2 = 0 THEN path || '::GetMapping' ELSE CASE WHEN (k // 3) * 3 = k THEN path || '::GetMapping' END END AS start FROM p WHERE k % 3 = 0")
def code_entry_starts(spark, sf_dir):
    """Entry points that every part's hint names, or that its file has."""
    k = F.col("p_partkey")
    path = F.concat(F.lit("src/m"), s(k % 10), F.lit("/Part"), s(k), F.lit(".java"))
    hints = read(spark, sf_dir, "part").select(k.alias("query_id"), F.when(k % 2 == 0, F.concat(F.lit("/PART"), s(k), F.lit(".java"))).otherwise("").alias("hint"), F.when(k % 2 == 1, path).otherwise("none").alias("file"))
    _, nodes, _ = java_graph(spark, sf_dir)
    return U.entry_starts(nodes, hints)
