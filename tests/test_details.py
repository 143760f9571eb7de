"""Smaller steps on odd rows: nulls, absent groups, ties and repeats."""

from pyspark.sql import functions as F

from lorefold.operators import code as C
from lorefold.operators import edits as E
from lorefold.operators import evidence as V
from lorefold.operators import runs as R
from lorefold.operators import surface as U
from lorefold.sources import artifacts as AR


def test_snippets(spark):
    text = "class A {\n  // public void pay(int a) {\n  private void pay(int x) {\n  }\n  protected void pay(long x)\n  {\n    if (x) { pay(1); }\n  }\n  public abstract Map<K, V> pay(int x);\n  void other() {\n    y();\n"
    rows = [(text, "pay"), (text, "other"), (text, "none"), (None, "pay"), (text, None), (text, ""), ("void a.b(int x) {}", "a.b"), ("int f(int x) { }\nint f(int y) { }", "f")]
    got = [r.s for r in spark.createDataFrame(rows, "t string, n string").select(C.symbol_snippet(F.col("t"), F.col("n")).alias("s")).collect()]
    assert got == ["  public abstract Map<K, V> pay(int x);", "  void other() {\n    y();\n", "", "", "", "", "void a.b(int x) {}", "int f(int x) { }"]
    long = "void f(int x) {\n" + "  y();\n" * 200 + "}"
    assert spark.createDataFrame([(long,)], "t string").select(C.symbol_snippet(F.col("t"), F.lit("f"), 5).alias("s")).first().s.count("\n") == 4


def test_imports_redundance_and_look_ups(spark):
    files = spark.createDataFrame([("a.java", "java", "import a.B;\nimport static c.d.B;\nimport x.Y ;"), ("b.py", "python", "import a.B;"), ("c.java", "java", None)], "path string, language string, text string")
    assert {(r.path, r.name, r.qualified) for r in C.java_import_map(files).collect()} == {("a.java", "B", "c.d.B"), ("a.java", "Y", "x.Y")}
    edits = spark.createDataFrame([(1, "add", "Do  this"), (2, "drop", "do this"), (3, "add", None)], "id long, op string, content string")
    assert {r.id: r.redundant for r in E.flag_redundant(edits, edits.where("id = 1").withColumn("content", F.lit("do THIS "))).collect()} == {1: True, 2: False, 3: False}
    nodes = spark.createDataFrame([("r1", "i1", "Pay"), ("r2", "i2", "Pay"), ("r2", "i3", "RepayLater"), ("r2", "i4", None)], "repo string, id string, name string")
    wanted = spark.createDataFrame([(1, "Pay"), (2, "PAY"), (3, None)], "query_id long, symbol string")
    assert {(r.query_id, r.id) for r in U.find_in_repositories(nodes, wanted).collect()} == {(1, "i1"), (1, "i2")}
    assert {(r.query_id, r.id) for r in U.find_in_repositories(nodes, wanted, exact=False).collect()} == {(q, i) for q in (1, 2) for i in ("i1", "i2", "i3")}
    assert U.fresh(nodes) and not U.fresh(nodes.where("false"))


def test_searches_and_roles(spark):
    rows = [("Why does LoanService fail in LoanService?  ", [" x1 ", "12", "12345", None, "x1"]), (None, None), ("", []), ("a " * 100, ["k"] * 9)]
    got = [r.q for r in spark.createDataFrame(rows, "q string, m array<string>").select(V.graph_queries(F.col("q"), F.col("m")).alias("q")).collect()]
    assert got == [["x1", "12345", "Why does LoanService fail in LoanService?", "LoanService"], [], [], ["k", ("a " * 60).strip()]]
    items = spark.createDataFrame([(1, "t", " own ", None), (2, "t", None, "f"), (3, "u", "", ""), (4, None, None, None), (5, "w", None, None)], "id long, task_type string, graph_role string, graph_framework string")
    hints = spark.createDataFrame([("t", "spring", ["a", "b"]), ("u", None, []), ("w", "x", None)], "task_type string, framework string, roles array<string>")
    assert {r.id: (r.framework, r.role) for r in V.resolve_roles(items, hints).collect()} == {1: ("", "own"), 2: ("spring", "a"), 3: ("", ""), 4: ("", ""), 5: ("x", "")}


def test_trace_index_and_suggestions(spark):
    records = [(2, '{"request": {"request_id": "a"}, "call_index": 2, "response": {"tool_calls": ["x"], "status": "ok"}}'), (1, '{"response": {"request_id": "a"}, "call_file": "f.json"}'), (3, "{}"), (4, "not json"), (5, None), (6, '{"request": {"request_id": ""}}')]
    got = AR.trace_index(spark.createDataFrame(records, "seq long, value string")).collect()
    assert len(got) == 1 and [(c.seq, c.call_index, c.call_file, c.status, c.tool_calls) for c in got[0].calls] == [(1, None, "f.json", "", 0), (2, 2, "", "ok", 1)]
    skills = spark.createDataFrame([("p", "# S\n\n### Auto-suggested rules\nold"), ("q", "same  ")], "project string, skill string")
    atoms = spark.createDataFrame([("p", i, f" claim {i:02d} ", 0.9, "accepted") for i in range(40)] + [("q", 1, "x", 0.7, "accepted"), ("q", 2, "x", 0.9, "candidate"), ("q", 3, " ", 0.9, "accepted"), ("q", 4, None, 0.9, "accepted")], "project string, seq long, claim string, confidence double, status string")
    new = {r.project: r.skill for r in R.append_suggestions(skills, atoms).collect()}
    assert new["q"] == "same  " and new["p"].startswith("# S\n\n### Auto-suggested rules\n\n_From M3 atoms (review before gate)._\n\n- claim 00\n- claim 01\n") and new["p"].endswith("- claim 29\n")
    assert R.append_suggestions(skills, atoms, include=("claim 39",)).where("project = 'p'").first().skill.endswith("_\n\n- claim 39\n")
