"""Proposals, patches and run reports on cases: nulls, ties, repeats, and groups that are absent."""

from pyspark.sql import functions as F

from lorefold.operators import proposals as P
from lorefold.operators import reports as Q
from lorefold.operators import surface as U
from lorefold.sources import files as SRC


def test_rule_texts(spark):
    rows = [("pay", ["a", "b"], "Q" * 50, ["x", " y ", "1,200", "x", "skip"], None, ["r1", "r2"]), (None, None, None, None, ["e"], []), ("", [], "short", [], None, None)]
    df = spark.createDataFrame(rows, "task string, missed array<string>, q string, passed array<string>, expected array<string>, refs array<string>")
    got = df.select(P.failure_rule(F.col("task"), F.col("missed")).alias("f"), P.success_line(F.col("q"), F.col("passed"), F.col("expected"), F.col("refs"), ("Skip",), "end so").alias("s")).collect()
    assert [r.f for r in got] == ["When handling pay tasks, ensure the answer satisfies: a, b.", "Review general handling against benchmark expected checks.", "Review general handling against benchmark expected checks."]
    assert [r.s for r in got] == [
        "- 对于「" + "Q" * 48 + "...」这类场景，保留成功输出模式：业务要点包括「x、y」; end so; ref r1.", "- 对于同类场景，保留成功输出模式：业务要点包括「e」; end so.", "- 对于「short」这类场景，保留成功输出模式：业务要点包括「verified task-specific requirements」; end so."
    ]


PROPOSALS = "step long, proposal_id string, source string, support long, rule string, risk string, confidence double, status string, trace_ids array<string>"


def proposal(step, name, source, support, rule, status="ready"):
    return (step, name, f"{source}_cluster", support, rule, "low", 0.5, status, [str(i) for i in range(12)])


def test_edits_and_patches(spark):
    rows = [
        proposal(1, "a", "failure", 5, "Check the totals always"), proposal(1, "b", "failure", 4, " check  THE totals always "), proposal(1, "c", "failure", 9, "short"), proposal(1, "d", "failure", 3, "Known rule in the skill"),
        proposal(1, "e", "failure", 2, "Another rule that is fine"), proposal(1, "f", "failure", 8, "Not ready but supported", "needs_review"), proposal(1, "g", "success", 1, "- line of a success"), proposal(2, "h", "failure", 1, "Known rule in the skill"), proposal(3, "i", "failure", 1, None),
    ]
    proposals, skills = spark.createDataFrame(rows, PROPOSALS), spark.createDataFrame([(1, "x\nKnown rule in the skill\n"), (2, None)], "step long, skill string")
    edits = P.to_edits(proposals, skills, 20, 5)
    assert {(r.step, r.source_type, r.place, r.content, len(r.trace_ids)) for r in edits.collect()} == {(1, "failure", 1, "Check the totals always", 8), (1, "failure", 2, "Another rule that is fine", 8), (1, "success", 1, "- line of a success", 8), (2, "failure", 1, "Known rule in the skill", 8)}
    assert P.to_edits(proposals, skills, 20, 1).count() == 3 and P.to_edits(proposals, skills, 2, 5).where("source_type = 'failure' and step = 1").count() == 1
    patches = {(r.step, r.source_type): (r.reasoning, r.contents) for r in P.to_patches(edits, proposals).collect()}
    assert patches[1, "failure"] == ("trace_cluster_merge (2 edits from 6 proposals)", ["Check the totals always", "Another rule that is fine"]) and set(patches) == {(1, "failure"), (1, "success"), (2, "failure")}
    reflected = spark.createDataFrame([(1, "failure", 1, "ANOTHER rule that is  fine"), (1, "failure", 2, "another rule that is fine"), (4, "success", 1, "own")], "step long, source_type string, place int, content string")
    got = sorted((r.step, r.source_type, r.place, r.origin, r.content) for r in P.beside_reflected(reflected, edits).collect())
    assert got == [(1, "failure", 1, "reflected", "ANOTHER rule that is  fine"), (1, "failure", 2, "reflected", "another rule that is fine"), (1, "failure", 3, "proposed", "Check the totals always"), (1, "success", 1, "proposed", "- line of a success"), (2, "failure", 1, "proposed", "Known rule in the skill"), (4, "success", 1, "reflected", "own")]


def test_success_proposals(spark):
    rows = [(1, i, "t" if i % 2 else None, int(i < 9), f"q{i}", None, ["c"], None) for i in range(10)] + [(12345, 1, "t", 1, "q", None, None, None), (12345, 2, "t", 1, "q", None, None, None)]
    traces = spark.createDataFrame(rows, "step long, id long, task_type string, hard int, question string, passed_checks array<string>, expected_checks array<string>, context_refs array<string>")
    got = {r.proposal_id: (r.support, r.rule.count("\n- "), r.confidence, r.trace_ids[:2]) for r in P.from_successes(traces).collect()}
    assert got == {"prop-step0001-success-t": (4, 4, 0.72, ["1", "3"]), "prop-step0001-success-general": (5, 5, 0.8, ["0", "2"]), "prop-step12345-success-t": (2, 2, 0.56, ["1", "2"])}


def test_backfilled_curve(spark):
    log = [(1, "epoch 1"), (2, "step 1 of 4"), (3, "score=0.5 gate=accept"), (4, "step 2"), (5, "nothing"), (6, "step 3"), (7, "score=0.9 gate=reject"), (8, "step 4"), (9, "score=0.4")]
    lines = spark.createDataFrame([("r", n, t) for n, t in log], "run string, line_no long, line string")
    history = spark.createDataFrame([("r", 4, "accept_new_best", 0.7, 3)], "run string, step int, action string, score double, edit_count int")
    gates = spark.createDataFrame([("r", 1, "accept", 0.6), ("r", 9, "accept", 1.0)], "run string, step int, action string, score double")
    got = [(r.step, r.event, r.gate_action, r.selection_gate, r.best_score, r.current_score, r.edit_count, r.reason) for r in Q.backfilled(SRC.parse_run_log(lines), history, gates).orderBy("seq").collect()]
    assert got == [(1, "gate", "accept", 0.6, 0.6, 0.6, None, None), (2, "skip", None, None, 0.6, 0.6, None, "no_valid_edits"), (3, "gate", "reject", 0.9, 0.6, 0.6, None, None), (4, "gate", "accept_new_best", 0.7, 0.7, 0.7, 3, None)]
    table = Q.curve_table(spark.createDataFrame([("r", 1, None)], "run string, step int, event string"))
    assert table.columns == ["run", *Q.CURVE] and table.first()["step"] == "1" and table.first()["event"] == "" and len(Q.CURVE) == 22


def test_quality_report(spark):
    runs = spark.createDataFrame([("a", "i", "- x\n- x", 0.5), ("b", "", "word " * 9000, 0.1239), ("c", "i", "fine", None)], "run string, initial string, best string, best_score double")
    points = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.4), ("b", 1, 0.1), ("b", 2, 0.1)], "run string, seq long, best double")
    tested = spark.createDataFrame([("a", 1, 0, 0.5), ("a", 2, 1, 1.0)], "run string, id long, hard int, soft double")
    replayed = spark.createDataFrame([("a", i, True) for i in range(7)] + [("b", 1, False)], "run string, id long, regressed boolean")
    got = {r.run: r for r in Q.quality_report(runs, points, tested, replayed).collect()}
    assert got["a"].recommendations == ["Replay regression on: 0, 1, 2, 3, 4", "Do not overwrite best during knowledge_accept."] and (got["a"].test_hard, got["a"].hard_failures, got["a"].duplicate_rules) == (0.5, 1, 1)
    assert got["b"].recommendations == ["Reduce skill size below 4000 tokens."] and got["b"].monotonic and got["b"].best_score == 0.124
    assert got["c"].recommendations == [] and got["c"].test_soft == 0 and got["c"].best_score is None


def test_entry_starts(spark):
    nodes = spark.createDataFrame([("a::Pay", "Pay", "route", "a"), ("b::Job", "Job", "job", "b"), ("c::Run", "Run", "method", "c")], "id string, name string, kind string, file_path string")
    hints = spark.createDataFrame([(1, "PAY", "b"), (2, "", "b"), (3, None, "c"), (4, "run", "none")], "query_id long, hint string, file string")
    assert {r.query_id: r.start for r in U.entry_starts(nodes, hints).collect()} == {1: "a::Pay", 2: "b::Job"}
