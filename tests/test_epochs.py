"""Samples under other partitionings, every action of a slow update, checkpoints that are cut off, and budgets."""

from pyspark.sql import functions as F

from lorefold.operators import epochs as P
from lorefold.operators import evidence as V


def test_sample_does_not_hang_on_partitions(spark):
    items = spark.range(300).select(F.col("id"), (F.col("id") % 3).alias("epoch"))
    drawn = [sorted(map(tuple, P.epoch_sample(df, seed).collect())) for df, seed in ((items.repartition(7), 1), (items.coalesce(1).orderBy(F.desc("id")), 1), (items, 2))]
    assert drawn[0] == drawn[1] != drawn[2] and len(drawn[0]) == 60
    assert P.epoch_sample(items.where("id < 5"), 1).count() == 5


def test_slow_update_actions(spark):
    skills = [("none", "a", "b", None), ("stable", "a", "b", "do it"), ("told", "a", "b", " do it "), ("idle", "a", "b", "No changes needed"), ("same", "a", " a", ""), ("rule", "aa", "b", None), ("apart", "a", "b", None)]
    rows = [(e, i, b, a) for e, pairs in {"stable": [(1, 1)], "told": [(0, 1)], "idle": [(1, 0), (1, 1)], "same": [(0, 0)], "rule": [(0, 1), (1, 0), (0, 0), (1, 1)]}.items() for i, (b, a) in enumerate(pairs)]
    frame = lambda column: spark.createDataFrame([(r[0], r[1], r[column]) for r in rows], "epoch string, id long, hard int")
    sample = spark.createDataFrame([(r[0], r[1]) for r in rows] + [("apart", 9)], "epoch string, id long")
    found = P.slow_update(sample, frame(2), frame(3), spark.createDataFrame(skills, "epoch string, previous string, current string, suggestion string"))
    got = {r.epoch: (r.action, r.content.split("\n")[0], r.sampled, r.improved, r.regressed, r.persistent_fail, r.stable_success) for r in found.collect()}
    assert got == {
        "none": ("skip", "", 0, 0, 0, 0, 0), "stable": ("skip_stable_success_only", "", 1, 0, 0, 0, 1), "told": ("suggested", "do it", 1, 1, 0, 0, 0), "idle": ("skip_non_actionable", "", 2, 0, 1, 0, 1),
        "same": ("skip_no_change", "", 1, 0, 0, 1, 0), "rule": ("rule_based", "## Epoch Transition Summary", 4, 1, 1, 1, 1), "apart": ("rule_based", "## Epoch Transition Summary", 1, 0, 0, 0, 0),
    }


def test_resume_after_a_kill(spark, tmp_path):
    """A run stopped between its files and its commit goes on from the step before, and the step can be done again."""
    store = P.checkpoints(spark, str(tmp_path / "runs"), 4)
    state = lambda run, step, current, best: (run, step, 0.5, 0.6, step, current, best, step // 2, step % 2, "{}")
    states = lambda *rows: spark.createDataFrame(list(rows), P.STATES["states"])
    skills = lambda *rows: spark.createDataFrame(list(rows), P.STATES["skills"])
    initial = spark.createDataFrame([("a", "i"), ("b", "i"), ("c", "i")], "run string, skill string")
    P.save_states(store, 0, states(state("a", 1, "skill_v1", "skill_v1"), state("b", 1, "gone", "gone")), skills(("a", "skill_v1", "one"), ("b", "best", "named"), ("b", "skill_v7", "seven"), ("b", "skill_v3", "three")))
    held = lambda: {r.run: (r.current, r.best, r.step, r.epoch, r.next_batch) for r in P.resume(store, initial).collect()}
    first = {"a": ("one", "one", 1, 0, 1), "b": ("seven", "named", 1, 0, 1), "c": ("i", "i", 0, 0, 0)}
    assert held() == first
    commit, store.commit = store.commit, lambda *_: (_ for _ in ()).throw(RuntimeError("killed"))
    try:
        P.save_states(store, 1, states(state("a", 2, "skill_v2", "skill_v1")), skills(("a", "skill_v2", "two")))
    except RuntimeError:
        pass
    store.commit = commit
    assert held() == first
    P.save_states(store, 1, states(state("a", 2, "skill_v2", "skill_v1")), skills(("a", "skill_v2", "two"), ("a", "skill_v1", "one again")))
    assert held() == first | {"a": ("two", "one again", 2, 1, 0)}


def test_cascade_and_budget(spark):
    cases = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    source = lambda *rows: spark.createDataFrame(list(rows), "id long, place int, text string")
    parts = V.cascade(cases, [(source((1, 0, "a"), (9, 0, "x")), True), (source((1, 0, "b"), (2, 0, "c")), False), (source((1, 1, "d"), (3, 0, "e")), True), (source((2, 0, "f"), (3, 0, "g")), False)])
    assert {(r.id, r.text) for r in parts.collect()} == {(1, "a"), (2, "c"), (1, "d"), (3, "e")}
    blocks = spark.createDataFrame([("g", k, "x" * n) for k, n in enumerate([4, 3, 9, 1])] + [("h", 0, "x" * 11), ("h", 1, "x"), ("i", 0, "x" * 10)], "g string, k int, t string")
    assert {(r.g, r.k) for r in V.within_budget(blocks, "t", ["k"], 10, ["g"]).collect()} == {("g", 0), ("g", 1), ("i", 0)}


def test_reflect_evidence(spark):
    refs = "array<string>"
    failed = spark.createDataFrame([(1, i, i, q, m, c) for i, q, m, c in [(0, "why " * 50, ["x"] * 8, ["a.py#f", "b.py", "c.py"]), (1, None, None, None), (2, "q", [], ["gone.py", "a.py#g"])]] + [(2, i, i, "q", ["m"], []) for i in range(7)], f"step long, id long, place long, question string, missed_checks {refs}, context_refs {refs}")
    evidence = spark.createDataFrame([("b.py", "proof")], "ref string, text string")
    files = spark.createDataFrame([("a.py", "head"), ("b.py", "B" * 2000), ("e.py", "")], "path string, text string")
    cards = spark.createDataFrame([("a.py", "f", "F" * 700)], "file_path string, symbol string, text string")
    found = spark.createDataFrame([(1, 0, "hit"), (0, 0, "unused")], "id long, place int, text string")
    texts, metrics = V.reflect_evidence(failed, evidence, files, cards, found)
    got = {r.step: r.text for r in texts.collect()}
    one = got[1]
    assert one.startswith("## Code Evidence (from project graph)\n\n### Case 0: " + ("why " * 50)[:120] + "\nmissed checks: x, x, x, x, x, x\nproof\n**Symbol** `f`\n```\n" + "F" * 600 + "\n```\n**File** `b.py`:\n```\n" + "B" * 1200)
    assert "### Case 1: \nhit\n" in one and one.endswith("### Case 2: q\n**File** `a.py`:\n```\nhead\n```") and got[2].count("### Case") == 5
    assert {r.step: (r.cases, r.refs, r.resolved, r.with_evidence) for r in metrics.collect()} == {1: (3, 4, 3, 3), 2: (5, 0, 0, 2)}
