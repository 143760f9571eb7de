"""Operators on small fixtures of our own."""

import json

import pytest
from pyspark.sql import functions as F

from lorefold.functions import text as T
from lorefold.operators import atoms as A
from lorefold.operators import documents as D
from lorefold.operators import graph as G
from lorefold.operators import ledger as L
from lorefold.operators import scoring as S
from lorefold.operators import search as Q
from lorefold.sources import files as SRC


def one(spark, expr, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(expr.alias("x")).first().x


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


MARKDOWN = "# Top\nintro\n\n```\ncode 1\n\ncode 2\n```py\n## Part\n- item\n2. second\n| a | b |\n|---|---|\n| 1 | 2 |\n### Deep\n# Next\nend\n```\nnever closed"


def test_markdown(spark):
    df = spark.createDataFrame([(1, MARKDOWN), (2, None), (3, "")], "doc long, text string")
    blocks = D.markdown_blocks(df, "doc", "text")
    got = [(r.type, r.level, r.text) for r in blocks.where("doc = 1").orderBy("pos").collect()]
    assert got == [
        ("heading", 1, "Top"), ("paragraph", 0, "intro"), ("code", 0, "code 1\n\ncode 2"), ("heading", 2, "Part"), ("list_item", 0, "item"), ("list_item", 0, "second"), ("table_row", 0, "| a | b |"),
        ("table_row", 0, "|---|---|"), ("table_row", 0, "| 1 | 2 |"), ("heading", 3, "Deep"), ("heading", 1, "Next"), ("paragraph", 0, "end"),
    ]
    assert blocks.where("type = 'code'").first().language == "py"
    tree = {r.title: r.parent for r in D.heading_tree(blocks).collect()}
    at = {r.text: r.pos for r in blocks.where("type = 'heading'").collect()}
    assert tree == {"Top": None, "Part": at["Top"], "Deep": at["Part"], "Next": None}
    table = D.tables(blocks).first()
    assert table.columns == ["a", "b"] and table.rows == [["1", "2"]]
    chunks = D.chunk_blocks(blocks, 1000).where("doc = 1").orderBy("chunk").collect()
    assert [c.heading for c in chunks] == ["Top", "Part", "Next"] and "```\ncode 1" in chunks[0].text


def test_chunks(spark):
    lines = ["x" * 40, "y" * 40, "z" * 500, "w" * 8]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, "\n \n")], "doc long, text string")
    got = [(r.chunk, r.text) for r in D.chunk_text(df, "doc", "text", 25).orderBy("chunk").collect()]
    assert got == [(1, "\n".join(lines[:2])), (2, lines[2]), (3, lines[3])]


def test_redaction(spark):
    text = f"key sk-{'a' * 40} password: hunter2 me@x.org jdbc://h/db Bearer {'b' * 24}"
    assert one(spark, T.redact(F.col("t")), t=text) == "key <REDACTED_API_KEY> password=<REDACTED> <REDACTED_EMAIL> <REDACTED_DB_URL> <REDACTED_AUTH>"
    assert one(spark, T.redaction_count(F.col("t")), t=text) == 5
    assert one(spark, T.clean(F.col("t")), t=" a　b\n\n\n\nc \n") == "a b\n\nc"


def test_tokens_and_refs(spark):
    got = one(spark, T.alignment_tokens(F.col("t")), t="OrderService must retry_on_fail when loading 订单数据")
    assert got == ["fail", "loading", "order", "orderservice", "retry", "service", "订单数据"]
    assert one(spark, T.seed_tokens(F.col("t"), 2), t="OrderService loading") == ["orderservice", "loading"]
    ref = one(spark, T.context_ref(F.col("t")), t="a/b.java#C")
    assert (ref.path, ref.symbol) == ("a/b.java", "C")
    assert one(spark, T.path_matches(F.col("a"), F.col("b")), a="x/y/z.py", b="y/z.py") and not one(spark, T.path_matches(F.col("a"), F.col("b")), a="xy.py", b="y.py")
    assert one(spark, T.fenced_json(F.col("t")), t='so: ```json\n{"a": 1}\n``` done') == '{"a": 1}'
    assert one(spark, T.fenced_json(F.col("t")), t='text {"a": [1]} end') == '{"a": [1]}'
    assert one(spark, T.fenced_json(F.col("t")), t="none") is None
    assert one(spark, T.method_calls(F.col("t")), t="if (x) { save(getName()); save(1); load (2) }") == ["save", "load"]
    assert one(spark, T.content_type(F.col("t")), t="不得 delete") == "constraint"


def test_keyword_score(spark):
    df = spark.createDataFrame([("debit 1,000 to cash", ["1000", "Cash", "rent"], {"rent": ["lease", "to"]}), (None, [], {})], "a string, checks array<string>, aliases map<string,array<string>>")
    plain, with_alias = (S.keyword_score(df, "a", "checks", x).collect() for x in (None, "aliases"))
    assert (plain[0].hard, plain[0].soft, plain[0].missed_checks) == (0, 0.667, ["rent"]) and with_alias[0].hard == 1
    assert (plain[1].hard, plain[1].soft, plain[1].f1) == (0, 0.0, 0.0)
    assert one(spark, S.rubric_score(F.lit("alpha beta"), F.expr("array(named_struct('name','a','weight',3.0D,'keywords',array('alpha')), named_struct('name','b','weight',1.0D,'keywords',array('gamma')))")), x=1).soft == 0.75


def test_gate_and_streak(spark):
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate([0.2, 0.1, 0.5, 0.4, 0.3, 0.2])], "run string, step int, score double")
    got = S.gate_fold(df, "run", "step", "score", patience=3).orderBy("step").collect()
    assert [r.action for r in got] == ["accept_new_best", "reject", "accept_new_best", "reject", "reject", "reject"] and [r.stopped for r in got][-1]
    streak = S.reject_streaks(df, "run", "step", F.col("score") < 0.45, 3).first()
    assert (streak.longest, streak.stop_at) == (3, 5)
    assert S.effective_metric(4, "hard") == "soft" and S.effective_metric(10, "hard") == "mixed" and S.effective_metric(30, "hard") == "hard"
    budgets = [one(spark, S.edit_budget(F.lit(5), 10, 8, 2, k), x=1) for k in ("constant", "linear", "cosine", "exponential")]
    assert budgets == [8, 5, 5, 6]


def test_clusters(spark):
    df = spark.createDataFrame([(i, "t", 0 if i < 4 else 1, 0.5, ["b", "a"] if i % 2 else ["c"], f"Task: {i}" if i == 0 else "fine") for i in range(6)], "id int, task_type string, hard int, soft double, missed_checks array<string>, predicted_answer string")
    got = S.cluster_failures(df, ["task_type", "missed_checks"]).collect()
    assert [(r["rank"], r.support, r.missed, r.sample_ids) for r in got] == [(1, 2, ["a", "b"], [1, 3]), (2, 2, ["c"], [0, 2])]
    kinds = {r.id: r.failure_type for r in S.classify_failure(df).collect()}
    assert kinds[0] == "prompt_echo" and kinds[1] == "missing_business_rule" and kinds[5] == "unknown"
    clean = S.apply_hygiene(df.withColumn("expected_checks", F.array(F.lit("z"))), "predicted_answer").where("id = 0").first()
    assert clean.hygiene_reason == "prompt_echo" and clean.soft == 0 and clean.missed_checks == ["z"]
    assert one(spark, S.answer_body(F.col("t")), t="chat\n## Answer\nbody that is long enough\n# Other\nx") == "## Answer\nbody that is long enough"
    assert S.success_proposals(df).first().support == 2 and S.missed_summary(df).first()["count"] == 2


REF = "array<struct<type:string,id:string,authority:string>>"


def test_atoms(spark):
    df = spark.createDataFrame([
        ("a1", "rule", "OrderService retries payment loading", [("code", "src/service/OrderService.java#pay", ""), ("doc", "d1", "")], 0.5), ("a2", "rule", "OrderService retries payment saving", [("code", "src/PayHandler.java", "")], 0.9),
        ("a3", "rule", "", [], 0.9), ("a4", "rule", "OrderService retries payment loading", [("doc", "d2", "official")], 0.7),
    ], f"atom_id string, kind string, claim string, source_refs {REF}, confidence double")
    scored = {r.atom_id: (r.confidence, r.status) for r in A.score_atoms(df).collect()}
    assert scored == {"a1": (0.9, "accepted"), "a2": (0.45, "needs_review"), "a3": (0.3, "rejected"), "a4": (0.65, "candidate")}
    merged = {r.atom_id: (r.merged, r.confidence, len(r.source_refs)) for r in A.merge_by_prefix(df).collect()}
    assert merged["a1"] == (2, 0.7, 3) and merged["a3"] == (1, 0.9, 0)
    tokens = df.withColumn("ts", T.alignment_tokens(F.col("claim")))
    assert rows(A.align_greedy(tokens, "atom_id", "kind", "ts")) == [("a1", "a1"), ("a2", "a1"), ("a3", "a3"), ("a4", "a1")]
    assert rows(A.overlap_pairs(tokens, "atom_id", "kind", "ts", least=5)) == [("a1", "a2", 5, 2, 1)]
    seeds = A.seeds(df)
    assert seeds.where("atom_id = 'a2'").first().context_refs == ["src/PayHandler.java"] and seeds.where("atom_id = 'a4'").first().risk == "needs_review"
    quality = A.artifact_quality(A.score_atoms(df), seeds).first()
    assert quality.atoms == 4 and quality.accepted_rate == 0.25 and quality.failures == ["accepted_rate"] and not quality.passed
    roles = [one(spark, A.role_of(F.col("r")), r=x) for x in ("a/OrderProcessorImpl.java#x", "a/controller/X.java", "", "q.py")]
    assert roles == ["processor", "handler_only", "unknown", "unknown"]
    kept = one(spark, A.cap_refs(F.expr("array(" + ",".join(f"named_struct('type','code','id','p/{i}','authority','')" for i in range(9)) + ",named_struct('type','doc','id','d','authority',''))"), 4), x=1)
    assert [r.type for r in kept] == ["code"] * 3 + ["doc"]
    assert {r.ref for r in A.evidence_index(df).collect()} == {"src/service/OrderService.java#pay", "src/service/OrderService.java", "pay", "src/PayHandler.java"}
    chunks = spark.createDataFrame([("c", "step one: you must not stop", "procedure"), ("d", "plain", "concept")], "chunk_id string, text string, content_type string")
    assert {r.kind for r in A.atoms_from_chunks(chunks).collect()} == {"procedure", "constraint"}
    assert A.atoms_from_code(spark.createDataFrame([("r", "@Scheduled retry")], "ref string, text string")).count() == 2


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b", "calls"), ("b", "c", "calls"), ("c", "a", "calls"), ("a", "d", "references"), ("d", "c", "calls"), ("impl", "iface", "implements"), ("b", "iface", "calls"), ("m", "x", "imports")], "src string, dst string, kind string")
    start = spark.createDataFrame([("a",)], "node string")
    assert rows(G.callees(edges, start, 2).select("node", "depth")) == [("b", 1), ("c", 2), ("d", 1), ("iface", 2)]
    assert rows(G.callers(edges, start, 1).select("node")) == [("c",)]
    paths = G.shortest_paths(G.neighbours(edges, paths=True), start, spark.createDataFrame([("c",), ("impl",), ("zz",)], "node string"))
    assert rows(paths.select("target", G.format_path(F.col("path")))) == [("c", "a → b → c"), ("c", "a → d → c"), ("impl", "a → b → iface → impl")]
    nodes = spark.createDataFrame([("n1", "pay", "q.pay"), ("n2", "pay", "r.pay"), ("n3", "load", "q.load")], "id string, name string, qualified_name string")
    found, missing = G.resolve(spark.createDataFrame([("s", "q.pay"), ("s", "pay"), ("s", "z.load"), ("s", "none")], "src string, name string"), nodes)
    assert {(r.dst, r.confidence) for r in found.collect()} == {("n1", 0.8), ("n2", 0.65), ("n3", 0.55)} and missing.count() == 1
    more = spark.createDataFrame([("caller", "im", "calls"), ("iface", "im", "contains"), ("impl", "rm", "contains"), ("impl", "iface", "implements")], "src string, dst string, kind string")
    named = spark.createDataFrame([("im", "run"), ("rm", "run")], "id string, name string")
    assert rows(G.interface_dispatch(more, named).select("src", "dst")) == [("caller", "rm")]
    owned = G.owners(spark.createDataFrame([(1, "f", 5), (2, "f", 1), (3, "g", 9)], "id int, file string, line int"), spark.createDataFrame([("T1", "f", 2), ("T2", "f", 5)], "id string, file string, line int"))
    assert rows(owned.select("id", "owner")) == [(1, "T2"), (2, None), (3, None)]
    tree = G.module_tree(spark.createDataFrame([(i, f"a/{'x' if i < 3 else 'y'}/f{i}.py") for i in range(6)] + [(9, "b/f.py")], "id int, file_path string"), most=4)
    assert {r.module for r in tree.collect()} == {"a/x", "a/y", "b"}
    packed = G.pack_snippets(spark.createDataFrame([("m", 1, 60), ("m", 2, 50), ("m", 3, 30)], "m string, o int, t int"), "m", "o", "t", 100)
    assert rows(packed.select("o", "taken")) == [(1, True), (2, False), (3, True)]
    old = spark.createDataFrame([("n1", "f1"), ("n2", "f2")], "id string, file_path string")
    links = spark.createDataFrame([("n1", "n2", "calls"), ("n2", "n1", "calls")], "src string, dst string, kind string")
    kept, left = G.save(old, links, spark.createDataFrame([("n3", "f1")], old.schema), spark.createDataFrame([("n3", "n2", "calls")], links.schema), spark.createDataFrame([("f1",)], "file_path string"))
    assert rows(kept) == [("n2", "f2"), ("n3", "f1")] and rows(left) == [("n3", "n2", "calls")]


def test_search(spark):
    q = Q.parse_query("kind:method,class file:*.java 'place' order")
    assert (q.kinds, q.files, q.terms) == (["method", "class"], ["*.java"], ["place", "order"])
    nodes = spark.createDataFrame([("1", "placeOrder", "method", "a/A.java", "x.placeOrder"), ("2", "Order", "class", "a/Order.java", "x.Order"), ("3", "order", "field", "a/A.java", "x"), ("4", "Order", "class", "gen/generated/Order.py", "y")], "id string, name string, kind string, file_path string, qualified_name string")
    assert [(r.id, r.score) for r in Q.search(nodes, q, 9).collect()] == [("2", 1.0), ("1", 0.6)]
    assert [(r.id, r.score) for r in Q.search(nodes, Q.parse_query("kind:field"), 9).collect()] == [("3", 0.4)]
    assert [r.id for r in Q.rank_symbols(nodes, "Order").collect()] == ["2", "4", "1", "3"]
    assert one(spark, Q.read_lines(F.col("t"), 2, 3), t="a\nb\nc\nd") == "b\nc"
    files = spark.createDataFrame([("f", "x\nneedle here"), ("g", "none")], "path string, text string")
    assert rows(Q.search_content(files, "needle", 5)) == [("f", 2, "needle here")]
    refs = Q.resolve_refs(spark.createDataFrame([("i", ["a/A.java#placeOrder", "a/A.java#nope", "z.py"])], "id string, context_refs array<string>"), nodes)
    assert [r[2] for r in rows(refs)] == ["file_hit", "symbol_hit", "miss"]
    assert Q.inverted_index(nodes, "id", "name").where("token = 'order'").count() == 3


def test_ledgers(spark):
    bank = spark.createDataFrame([("r1", "Check  X", 2, 1, 0, 3, ["a"])], "rule_id string, text string, support_count int, accepted_count int, regression_count int, last_step int, source_items array<string>")
    new = spark.createDataFrame([("r9", "check x", 1, 1, 0, 5, ["b", "a"]), ("r2", "Other", 1, 0, 1, 5, [])], bank.schema)
    merged = {r.rule_id: (r.support_count, r.last_step, r.source_items) for r in L.merge_rules(bank, new).collect()}
    assert merged == {"r1": (3, 5, ["a", "b"]), "r2": (1, 5, None)}
    assert [r.rule_id for r in L.active_rules(L.merge_rules(bank, new), 5).collect()] == ["r1"]
    old, now = (spark.createDataFrame(x, "k string, h string") for x in ([("a", "1"), ("b", "2"), ("c", "3")], [("a", "1"), ("b", "9"), ("d", "4")]))
    assert rows(L.changed_keys(old, now, "k", "h")) == [("b", "changed"), ("c", "deleted"), ("d", "added")]
    assert rows(L.upsert(old, now, "k")) == [("a", "1"), ("b", "9"), ("c", "3"), ("d", "4")]
    top = L.frontier(spark.createDataFrame([("x", 0.5, 1), ("y", 0.5, 2), ("x", 0.9, 3), ("z", 0.1, 4)], "hash string, score double, seq int"), 2)
    assert [r.hash for r in top.collect()] == ["x", "y"]
    pool = spark.createDataFrame([("p", 1, False, 1), ("q", 2, False, 0)], "id string, last_step int, echo boolean, baseline_hard int")
    out = {r.id: r.state for r in L.replay_outcomes(pool, spark.createDataFrame([("p", 0), ("q", 1)], "id string, hard int")).collect()}
    assert out == {"p": "regressed", "q": "fixed"}
    assert L.call_costs(spark.createDataFrame([("m", 1000, None)], "model string, prompt_tokens int, completion_tokens int")).first().total_cost == 0.001
    used = L.rule_attribution(spark.createDataFrame([("r", 1), ("r", 2)], "rule_id string, version int"), spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "version int, hard int"))
    assert rows(used) == [("r", 3, 2, 1)]
    assert L.curve_summary(spark.createDataFrame([("gate", "reject", 0.1), ("rollout", None, None)], "event string, gate_action string, selection_score double")).first().rejects == 1


def test_sources(spark, tmp_path):
    (tmp_path / "src" / "node_modules").mkdir(parents=True)
    (tmp_path / "src" / "A.java").write_text("class A {}")
    (tmp_path / "src" / "node_modules" / "x.js").write_text("x")
    (tmp_path / "src" / "gen.py").write_text("# Code generated by tool")
    (tmp_path / "readme.md").write_text("# hi")
    (tmp_path / "big.py").write_text("x" * 3_000)
    got = {r.path: (r.language, r.kind, bool(r.source_hash)) for r in SRC.scan_repository(spark, str(tmp_path), max_mb=0.002).collect()}
    assert got == {"src/A.java": ("java", "source", True), "src/gen.py": ("python", "generated", False), "readme.md": ("markdown", "doc", True), "big.py": ("python", "source", False)}
    assert SRC.read_documents(spark, str(tmp_path)).select("type", "text").first() == ("markdown", "# hi")
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbroken\n\n{"a": 2}\n')
    assert SRC.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int").count() == 2
    (tmp_path / "set" / "train").mkdir(parents=True)
    (tmp_path / "set" / "train" / "items.json").write_text(json.dumps({"items": [{"id": "i1"}, {"id": "i1"}, {"id": ""}]}))
    split = SRC.read_split(spark, str(tmp_path / "set"), "train", "id:string")
    assert rows(SRC.split_issues(split)) == [("missing_id", ""), ("repeated", "i1")]
    log = spark.createDataFrame([("r", i, x) for i, x in enumerate(["epoch 1", "step 3 begins", "score=0.5 gate: accept", "step 4", "gate=reject"])], "run string, line_no int, line string")
    assert [(r.epoch, r.step, r.action) for r in SRC.parse_run_log(log).orderBy("line_no").collect()] == [(1, None, None), (1, 3, None), (1, 3, "accept"), (1, 4, None), (1, 4, "reject")]
    SRC.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), str(tmp_path / "t"), "k", kind="csv")
    assert spark.read.csv(str(tmp_path / "t"), header=True).count() == 2


def test_strict_jsonl_fails(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbroken\n')
    with pytest.raises(Exception):  # noqa: B017
        SRC.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int", strict=True).collect()
