"""Source files and rule documents on small fixtures of our own."""

from pyspark.sql import functions as F

from lorefold.operators import code as C
from lorefold.operators import edits as E

JAVA = """package shop.core;
import shop.util.Clock;
@Service
public class Cart extends Base implements Payable, Closeable {
  @Autowired
  private Ledger ledger;
  public void pay(int x) {
    total(x);
    ledger.post(x);
  }
  private int total(int x) {
    return x;
  }
}
"""
LEDGER = "package shop.core;\npublic class Ledger {\n  public void post(int x) {\n  }\n  @GetMapping(\"/all\")\n  public String all() {\n  }\n}\n"
PYTHON = 'class Tool:\n    def run(self):\n        """Runs it."""\n        helper()\n\ndef helper():\n    pass\n\ndef main():\n    helper()\n'
BASE = "public class Base {\n}\ninterface Payable {\n}\n"
XML = '<mapper namespace="shop.CartMapper"><select id="find">x</select><insert parameterType="a" id="put">y</insert></mapper>'


def files(spark):
    rows = [("a/Cart.java", "java", JAVA), ("a/Ledger.java", "java", LEDGER), ("t/tool.py", "python", PYTHON), ("a/Base.java", "java", BASE), ("m.xml", "xml", XML), ("x.bin", "", None)]
    return spark.createDataFrame(rows, "path string, language string, text string")


def pairs(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_symbols_and_edges(spark):
    nodes, edges = C.build(files(spark))
    names = {r.id: (r.kind, r.qualified_name, r.docstring) for r in nodes.collect()}
    assert names["a/Cart.java::Cart"] == ("class", "shop.core.Cart", "") and names["a/Cart.java::pay"][:2] == ("method", "shop.core.Cart.pay")
    assert names["t/tool.py::run"] == ("function", "t.tool.Tool.run", "Runs it.")
    got = pairs(edges, "src", "dst", "kind")
    assert ("a/Cart.java::Cart", "a/Cart.java::pay", "contains") in got and ("a/Cart.java", "a/Cart.java::Cart", "contains") in got
    assert ("a/Cart.java::pay", "a/Cart.java::total", "calls") in got and ("a/Cart.java::pay", "a/Ledger.java::post", "calls") in got
    assert ("a/Cart.java::Cart", "a/Base.java::Base", "extends") in got and ("a/Cart.java::Cart", "a/Base.java::Payable", "implements") in got
    assert ("a/Cart.java::Cart", "a/Ledger.java::Ledger", "references") in got and ("t/tool.py::run", "t/tool.py::helper", "calls") in got


def test_imports_entries_mappers(spark):
    f = files(spark)
    nodes = C.symbols(f)
    assert ("a/Cart.java", "Clock") in pairs(C.imports(f), "path", "name")
    entries = {(r.kind, r.handler): (r.path, r.protocol) for r in C.entry_points(f, nodes).collect()}
    assert entries[("rest", "a/Ledger.java::all")] == ("/all", "http") and ("cli", "t/tool.py::main") in entries
    assert pairs(C.mapper_statements(f), "namespace", "id", "kind") == {("shop.CartMapper", "find", "select"), ("shop.CartMapper", "put", "insert")}
    jsx = spark.createDataFrame([("App.js", "javascript", "function App() {\n  return <Nav x/>;\n}\nfunction Nav() {\n}\n")], f.schema)
    assert pairs(C.rendered(jsx, C.symbols(jsx)), "src", "dst") == {("App.js::App", "App.js::Nav")}


RULES = "# Rules\n<!-- rule_id: r1 -->\n- Always check the total\n- always  check the total\n## More\n<tool>\n- Use the ledger\ntext"


def test_rule_documents(spark):
    df = spark.createDataFrame([("d", RULES)], "doc string, text string")
    assert [(r.rule, r.rule_id) for r in E.rule_lines(df).orderBy("pos").collect()] == [("Always check the total", "r1"), ("always  check the total", "r1"), ("Use the ledger", "r1")]
    assert [(r.heading, r.body.split("\n")[-1]) for r in E.sections(df).orderBy("pos").collect()] == [("Rules", "- always  check the total"), ("More", "text")]
    q = E.quality(df).first()
    assert (q.rules, q.duplicates, q.leaks, q.passed) == (3, 1, 1, False)
    clean = df.select(E.sanitise(F.col("text")).alias("text"))
    assert clean.first().text.count("\n- ") == 2 and E.quality(clean).first().passed


def test_edits(spark):
    df = spark.createDataFrame(
        [("append", None, "- New rule"), ("insert_after", "## More", "- Inserted"), ("insert_after", "nowhere", "- Appended"), ("replace", "the ledger", "a book"), ("delete", "text", None), ("replace", "nowhere", "x")], "op string, target string, content string"
    )
    got = [r.t for r in df.select(E.apply_edit(F.lit(RULES), F.col("op"), F.col("target"), F.col("content")).alias("t")).collect()]
    assert got == [RULES + "\n- New rule", RULES.replace("## More", "## More\n- Inserted"), RULES + "\n- Appended", RULES.replace("the ledger", "a book"), RULES[:-4], RULES]
    content = spark.createDataFrame([("short",), ("- Always check the total",), ("- <tool> must be used here",), ("- Blue water under a bridge",), ("- Verify that sums must match",)], "c string")
    assert [r.p for r in content.select(E.edit_problem(F.col("c"), F.lit(RULES)).alias("p")).collect()] == ["too_short", "duplicate", "leakage", "not_actionable", None]
    once = spark.range(1).select(E.replace_region(F.lit("a"), F.lit("one")).alias("t"))
    assert once.select(E.replace_region(F.col("t"), F.lit("two")).alias("t")).first().t == "a\n<!-- slow_update:begin -->\ntwo\n<!-- slow_update:end -->"
    edits = spark.createDataFrame([("e1", "append", "Check totals", "", ["i1"]), ("e2", "append", "check  totals", "", ["i2"]), ("e3", "append", "cash and rent", "x", [])], "edit_id string, op string, content string, target string, items array<string>")
    assert {r.edit_id: r["items"] for r in E.dedupe_edits(edits).collect()} == {"e1": ["i1", "i2"], "e3": None}
    ranked = E.rank_edits(edits, spark.createDataFrame([("cash",), ("rent",), ("totals",)], "check string"), 2).collect()
    assert [(r.edit_id, r.coverage) for r in ranked] == [("e3", 0.8167), ("e1", 0.3333)]
