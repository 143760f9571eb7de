"""Work that grows with its input: rows that meet on the way, and what a fold over one long text costs."""

import time

from pyspark.sql import functions as F

from lorefold.functions import text as T
from lorefold.operators import atoms as A
from lorefold.operators import edits as E
from lorefold.operators import graph as G
from lorefold.operators import index as X
from lorefold.operators import scoring as S
from lorefold.operators import surface as U


def most_rows(df):
    """Rows of df, and the most rows that any step of its plan gave out."""
    rows = df.collect()

    def steps(plan):
        yield plan
        name = plan.getClass().getSimpleName()
        inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
        for one in inner:
            yield from steps(one)

    found = [s.metrics().apply("numOutputRows").value() for s in steps(df._jdf.queryExecution().executedPlan()) if s.metrics().contains("numOutputRows")]
    return rows, max(found)


def test_queries_of_one_name_do_not_meet_all_its_nodes(spark):
    nodes = spark.range(2000).select(F.concat(F.lit("f"), "id", F.lit("::Get")).alias("id"), F.lit("Get").alias("name"), F.lit("route").alias("kind"), F.concat(F.lit("src/f"), "id", F.lit(".java")).alias("file_path"))
    wanted = spark.range(2000).select(F.col("id").alias("query_id"), F.when(F.col("id") % 2 == 0, "Get").otherwise("get").alias("symbol"), F.when(F.col("id") % 4 < 3, F.concat(F.lit("/f"), "id", F.lit("."))).alias("near"))
    rows, most = most_rows(U.best_symbols(nodes, wanted))
    got = {r.query_id: (r.id, r.rank_score) for r in rows}
    assert got == {i: (f"f{i}::Get" if i % 4 < 3 else "f0::Get", (10 if i % 2 == 0 else 0) + (25 if i % 4 < 3 else 0)) for i in range(2000)}
    assert most < 200_000  # 4,000,000 if each met all


def test_needles_with_a_common_beginning_meet_only_what_holds_them(spark, monkeypatch):
    monkeypatch.setattr(S, "NEEDLES", 3)
    monkeypatch.setattr(S, "PIECE", 64)
    needles = spark.range(1500).select(F.col("id").alias("n"), F.concat(F.lit("always check "), (F.col("id") * 7919).cast("string"), F.lit(".")).alias("needle"))
    texts = [(d, "\n".join(f"always check {i * 7919}." for i in range(d, 1500, 31))) for d in range(31)] + [(99, None), (98, "always check")]
    rows, most = most_rows(S.contained(spark.createDataFrame(texts, "d int, t string"), "t", needles, "needle").select("d", "n"))
    want = {(d, i) for d, t in texts for i in range(1500) if t and f"always check {i * 7919}." in t}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert most < 46_500  # each text meets each needle
    keyed = S.contained(spark.createDataFrame([("a", "xyz-1"), ("b", "xyz-1"), ("a", None)], "g string, t string"), "t", spark.createDataFrame([("a", "z-1"), ("b", "yz"), ("c", "x"), (None, "x"), ("b", "")], "h string, w string"), "w", ("g", "h"))
    assert {(r.g, r.w) for r in keyed.collect()} == {("a", "z-1"), ("b", "yz")}


def test_clean_up_of_a_long_document(spark):
    n = 4000
    lines = ["# Rules", "as an AI I say", *[f"- must check {i}" for i in range(n)], "- MUST  check 7", "text", "text", "- must check 0"]
    began = time.time()
    got = spark.createDataFrame([("\n".join(lines),)], "t string").select(E.sanitise(F.col("t"))).first()[0]
    assert got.split("\n") == ["# Rules", *[f"- must check {i}" for i in range(n)], "text", "text"]
    assert time.time() - began < 15


def test_owners_of_one_large_file_and_of_rows_without_file(spark):
    """One file's lines fall into several parts; owners are carried from one to the next."""
    types = spark.range(0, 3000, 100).select(F.col("id"), F.lit("f").alias("file"), F.col("id").alias("line")).unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit("g").alias("file"), F.lit(5).cast("long").alias("line")))
    members = spark.range(-20, 3000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "f").otherwise("g").alias("file"), F.col("id").alias("line"))
    got = {r.id: r.owner for r in G.owners(members, types).collect()}
    assert got == {i: (i // 100 * 100 if i >= 0 else None) if i % 2 == 0 else (-1 if i >= 5 else None) for i in range(-20, 3000)}


def test_as_of_groups_are_those_of_the_first_sql():
    """The query's groups were once made as small as single keys; they are 100 again."""
    from lorefold.plans import registry

    assert "l_partkey % 100 AS file" in registry.ORACLES["graph_asof_owner"] and "o_custkey % 100 AS file" in registry.ORACLES["graph_asof_owner"]


def test_claims_of_common_words_meet_their_first_nodes(spark):
    nodes = spark.range(3000).select("id", F.concat(F.lit("common w"), "id").alias("name"), F.lit("k").alias("kind"), F.concat(F.lit("p"), "id").alias("file_path"), F.lit("").alias("qualified_name"))
    asked = spark.range(500).select(F.col("id").alias("query_id"), F.concat(F.lit("common w"), F.col("id") + 100).alias("text"))
    hits = X.word_hits(X.parse(asked), X.postings(nodes), first=5)
    rows, most = most_rows(hits)
    assert {(r.query_id, r.id) for r in rows} == {(q, i) for q in range(500) for i in (0, 1, 2, 3, 4, q + 100)}
    assert most < 20_000  # 1,500,000 if each met all
    got = X.search(asked, nodes, X.postings(nodes), X.grams(nodes), 5).where("query_id = 7").orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(i, 1.0) for i in range(5)]


def test_sets_that_share_too_little_do_not_leave_their_task(spark):
    import random

    rng = random.Random(5)
    sets = [(i, "g", sorted({*(f"all{c}" for c in range(5)), *(f"t{c}" for c in rng.sample(range(20), 5))})) for i in range(600)]
    rows, most = most_rows(A.overlap_pairs(spark.createDataFrame(sets, "k long, g string, ts array<string>"), "k", "g", "ts", 9))
    first = {}
    for k, _, ts in sets:
        first.setdefault(tuple(ts), (k, set(ts)))
    reps = list(first.values())
    want = {(a, b, len(x & y)) for a, x in reps for b, y in reps if a < b and len(x & y) >= 9}
    assert {(r.a, r.b, r.shared) for r in rows} == want and len(rows) == len(want) > 0
    assert most < 5_000  # 15,000 and more when all that share a rare token meet


def test_alignment_keeps_no_pairs_of_atoms_that_follow(spark, monkeypatch):
    import random

    monkeypatch.setattr(A, "ALIGNED_FIRST", 16, raising=False)
    held, cut = [], A.cut
    monkeypatch.setattr(A, "cut", lambda df: held.append(cut(df)) or held[-1])
    rng = random.Random(9)
    atoms = [(i, "g", rng.sample([f"t{c}" for c in range(14)], 5)) for i in range(300)]
    monkeypatch.setattr(A, "drop", lambda *frames: None)
    got = {r.key: r.leader for r in A.align_greedy(spark.createDataFrame(atoms, "k long, g string, ts array<string>"), "k", "g", "ts", 3).collect()}
    leaders, want = [], {}
    for k, _, ts in atoms:
        want[k] = next((n for n, other in leaders if len(other & set(ts)) >= 3), k)
        if want[k] == k:
            leaders.append((k, set(ts)))
    assert got == want
    assert max(df.count() for df in held) < 1_000  # some 13,000 when all pairs that share enough are held


def test_redaction_reads_texts_without_secrets_once(spark):
    """Words of local parts of addresses are not tried from each of their letters where there is no @; secrets are found as ever."""
    long = "a" * 150_000
    spark.createDataFrame([("ab",)], "t string").select(T.redacted(F.col("t")), T.redact(F.col("t"))).collect()
    began = time.time()
    texts = [long, None, "", "PassWord : x y", "aPi_Key=q", "sk-" + "Z" * 32, "Basic " + "q" * 20, f"{long[:100]}@b.c+d@e.f", "MYSQL://u", "no://thing: token"]
    got = [tuple(r) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.redacted(F.col("t")).alias("r"), T.redact(F.col("t")).alias("t")).select("r.text", "r.n", "t").orderBy("i").collect()]
    want = [(long, 0), (None, None), ("", 0), ("PassWord =<REDACTED> y", 1), ("aPi_Key=<REDACTED>", 1), ("<REDACTED_API_KEY>", 1), ("<REDACTED_AUTH>", 1), ("<REDACTED_EMAIL><REDACTED_EMAIL>", 2), ("<REDACTED_DB_URL>", 1), ("no://thing: token", 0)]
    assert got == [(t, n, t) for t, n in want]
    assert time.time() - began < 10


def test_references_read_symbols_that_were_found_once(spark):
    from lorefold.plans import registry

    found = registry.QUERIES["code_resolve"](spark, "/root/testdata/sf0.001")
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def java_repository(spark):
    text = F.concat(F.lit("class A"), "id", F.lit(" {\n  public int run"), "id", F.lit("(int x) {\n    return run"), F.col("id") + 1, F.lit("(x);\n  }\n}"))
    return spark.range(20).select(F.concat(F.lit("A"), "id", F.lit(".java")).alias("path"), F.lit("java").alias("language"), text.alias("text"))


def test_edges_read_nodes_that_were_found_once(spark):
    from lorefold.operators import code as C

    files = java_repository(spark)
    nodes, edges = C.build(files)
    assert "Generate" in C.symbols(files)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in nodes._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(named_struct(pos" not in edges._jdf.queryExecution().optimizedPlan().toString()
    assert edges.where("kind = 'calls'").count() == 19 and edges.where("kind = 'contains'").count() == 40


def test_texts_and_nodes_are_not_broadcast(spark):
    """A generated or compressed table reads as small; its texts don't go through the driver for that."""
    from lorefold.operators import code as C

    files = java_repository(spark)
    nodes, edges = C.build(files)
    for df in (C.bodies(files, nodes), C.entry_points(files, nodes), U.with_source(nodes, files, 5), edges):
        assert "Broadcast" not in plan_of(df)


def test_walks_read_neighbours_that_were_found_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(G, "reach", lambda pairs, start, depth, reach=G.reach: seen.append(pairs) or reach(pairs, start, depth))
    edges = spark.range(30).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"), F.lit("calls").alias("kind"))
    found = G.impact(edges, spark.createDataFrame([("5",)], "node string"), 2).collect()
    assert {(r.direction, r.node, r.depth) for r in found} == {("callees", "6", 1), ("callees", "7", 2), ("callers", "4", 1), ("callers", "3", 2)}
    assert len(seen) == 2 and all("Aggregate" not in p._jdf.queryExecution().optimizedPlan().toString() for p in seen)


def test_references_and_dispatch_broadcast_nothing(spark):
    from lorefold.operators import search as Q

    nodes = spark.range(40).select(F.concat(F.lit("n"), "id").alias("id"), F.concat(F.lit("m"), F.col("id") % 20).alias("name"), F.concat(F.lit("f"), F.col("id") % 5).alias("file_path"))
    items = spark.createDataFrame([(1, ["f1#m1", "f1#m2", "g#x"])], "id int, context_refs array<string>")
    found = Q.resolve_refs(items, nodes)
    assert {(r.ref, r.outcome) for r in found.collect()} == {("f1#m1", "symbol_hit"), ("f1#m2", "file_hit"), ("g#x", "miss")}
    edges = spark.createDataFrame([("c", "n1", "calls"), ("face", "n1", "contains"), ("impl", "n21", "contains"), ("impl", "face", "implements")], "src string, dst string, kind string")
    reached = G.interface_dispatch(edges, nodes)
    assert [(r.src, r.dst) for r in reached.collect()] == [("c", "n21")]
    for df in (found, reached):
        assert "Broadcast" not in plan_of(df)


def test_module_paths_are_brought_together_once(spark):
    from lorefold.operators import frontend as J

    asked = spark.createDataFrame([("a/b/c.js", "X", "../d"), ("a/b/c.js", "Y", "./e"), ("a/b/c.js", "Z", "react")], "path string, name string, module string")
    files = spark.createDataFrame([("a/d/index.ts",), ("a/d.js",), ("a/b/e",)], "path string")
    found = J.resolve_modules(asked, files)
    assert {(r.name, r.file) for r in found.collect()} == {("X", "a/d.js"), ("Y", "a/b/e"), ("Z", None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("aggregate(concat(") <= 2  # seven when each ending has its own
