"""Masked parsing, JavaScript edges, framework patterns and containment joins on cases."""

import random

from pyspark.sql import functions as F

from lorefold.functions import lexical as X
from lorefold.operators import code as C
from lorefold.operators import edits as E
from lorefold.operators import frameworks as W
from lorefold.operators import frontend as J
from lorefold.operators import scoring as S


def frame(spark, rows):
    return spark.createDataFrame([(p, X_LANG[p.rpartition(".")[2]], t) for p, t in rows], "path string, language string, text string")


X_LANG = {"java": "java", "py": "python", "js": "javascript", "jsx": "javascript", "ts": "typescript", "tsx": "typescript"}


def test_blanks():
    cases = {
        'a = "x // y"; // class B': ('a = "      ";            ', "c"), "/* class\nA */ class B {": ("        \n     class B {", "c"), 'c = "a\\"b" + \'d\'': ('c = "    " + \' \'', "c"), "x /* open": ("x        ", "c"),
        'd = """def f(\n""" # class': ('d = """      \n"""        ', "hash"), "'it' # don't\ndef f(": ("'  '        \ndef f(", "hash"), 'e = "open\nclass C': ('e = "    \nclass C', "c"), "`a\n//b` //c": ("` \n   `    ", "c"), '""': ('""', "c"),
    }
    for text, (want, family) in cases.items():
        got = X.blank(text, family)
        assert len(got) == len(text) and [x.rstrip() for x in got.split("\n")] == [x.rstrip() for x in want.split("\n")], text
    assert X.unclosed("a /* b") and X.unclosed("/*/") and not X.unclosed('"/*" // /*') and not X.unclosed("/**/ x")


JAVA = """package shop;
// class Wrong {
/* public class Old {
   public void gone(int x) { */
public class Cart { static class Item {} enum Kind { A }
  String s = "class Text { public void no(int x) {";
  public void pay(int x) { // public void never() {
  }
}
"""


def test_parse_sees_code_alone(spark):
    rows = [("a/Cart.java", JAVA), ("b/None.java", None), ("c/Bin.java", "class X {\0}"), ("d/Open.java", "package p;\npublic class Open {\n/* public class Hidden {\n"), ("e/t.py", 'def run():\n    """def doc():\n    class No"""\n# def skip():\nclass Tool:\n    x = "def y():"\n')]
    rows += [("f/S.java", "@Service\npublic class Service {\n}\npublic class Real {\n}\n"), ("g/P.java", "public class Path {\n}\n")]
    nodes, errors = C.parse(frame(spark, rows))
    got = {r.id: (r.kind, r.start_line, r.signature) for r in nodes.collect()}
    assert set(got) == {"a/Cart.java::Cart", "a/Cart.java::Item", "a/Cart.java::Kind", "a/Cart.java::pay", "d/Open.java::Open", "e/t.py::run", "e/t.py::Tool", "f/S.java::Real", "g/P.java::Path"}
    assert got["a/Cart.java::pay"] == ("method", 7, "public void pay(int x) { // public void never() {") and got["a/Cart.java::Item"][1] == 5
    assert {r.id: r.qualified_name for r in nodes.collect()}["a/Cart.java::Kind"] == "shop.Kind"
    assert {r.id: r.docstring for r in nodes.collect()}["e/t.py::run"].startswith("def doc")
    assert {(r.path, r.error) for r in errors.collect()} == {("b/None.java", "no text"), ("c/Bin.java", "binary content"), ("d/Open.java", "unclosed comment")}


APP = """import Nav from './nav/Nav';
import { Box as Panel, List } from "../lib/widgets";
import Lone from '../shared';
import Gone from './missing/Card';
import React from 'react';
function App() {
  el.addEventListener('click', onHit); fetch(u).then(load).catch(function () {});
  return <React.Fragment><Nav/><Panel x={1}/><Lone/><Gone/><Local/><Twice/><Nobody/></React.Fragment>;
}
function onHit(e) { }
function load(x) { setTimeout(later, 5); }
const Local = () => 1;
function Local2() { return <b onClick={onHit} onChange={elsewhere}/>; }
"""


def test_javascript_edges(spark):
    rows = [("src/app/App.jsx", APP), ("src/app/nav/Nav.tsx", "export function Navigation() { }\nexport function Other() { }\n"), ("src/app/nav/Nav.js", "function Wrong() { }\n"), ("src/lib/widgets/index.ts", "export function Frame() { }\n")]
    rows += [("src/shared.ts", "export class Shared { }\n"), ("x/Card.js", "function Card() { }\n"), ("y/a.js", "function Twice() { }\nfunction elsewhere() { }\n"), ("y/b.js", "function Twice() { }\n"), ("y/c.js", "function Twice() { return <Nav/> }\n"), ("src/app/App2.js", "function later() { }\n")]
    files = frame(spark, rows)
    nodes = C.symbols(files)
    assert {(r.name, r.module) for r in J.import_map(files).where("path like '%App.jsx'").collect()} == {("Nav", "./nav/Nav"), ("Panel", "../lib/widgets"), ("List", "../lib/widgets"), ("Lone", "../shared"), ("Gone", "./missing/Card"), ("React", "react")}
    got = {(r.src, r.dst) for r in J.renders(files, nodes).collect()}
    app = "src/app/App.jsx"
    assert got == {(app, "src/app/nav/Nav.tsx::Navigation"), (app, "src/lib/widgets/index.ts::Frame"), (app, "src/shared.ts::Shared"), (app, "x/Card.js::Card"), (app, f"{app}::Local"), (app, "y/a.js::Twice"), (app, "y/b.js::Twice")}
    known = spark.createDataFrame([(app, "x/Card.js::Card", "calls"), (app, f"{app}::load", "calls")], "src string, dst string, kind string")
    assert J.renders(files, nodes, known).count() == 6
    assert {(r.src, r.dst) for r in J.callbacks(files, nodes).collect()} == {(app, f"{app}::onHit"), (app, f"{app}::load")}
    assert {r.dst for r in J.callbacks(files, nodes, known).collect()} == {f"{app}::onHit"}


def test_relative_paths(spark):
    cases = [("a/b/c.js", "./d", "a/b/d"), ("a/b/c.js", "../d/./e", "a/d/e"), ("c.js", "./d", "d"), ("c.js", "../../d", "../../d"), ("a/c.js", "../../x/../d", "../d"), ("a/b.js", ".", "a")]
    got = spark.createDataFrame(cases, "p string, m string, want string").select("want", J.joined_path(F.col("p"), F.col("m")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_framework_patterns(spark):
    project = '{"jobs": {" @Job ": "runner", "@Old": "x", "": "y", "@N": 3, "@True": "true"}, " ": {"a": "b"}, "bad": [1], "core": {"extends Base": "entity"}}'
    settings = spark.createDataFrame([("p", project), ("r", '{"jobs": {"@Old": "keeper"}, "own": {"#[x]": "rusty"}}'), ("n", None), ("q", "not json"), ("l", "[1]")], "origin string, settings string")
    parsed = W.parse_patterns(settings)
    assert {(r.origin, r.framework, r.pattern, r.role) for r in parsed.collect()} == {("p", "jobs", "@Job", "runner"), ("p", "jobs", "@Old", "x"), ("p", "jobs", "@True", "true"), ("p", "core", "extends Base", "entity"), ("r", "jobs", "@Old", "keeper"), ("r", "own", "#[x]", "rusty")}
    merged = W.merge_patterns(parsed.where("origin = 'p'"), parsed.where("origin = 'r'"))
    assert {(r.framework, r.pattern): r.role for r in merged.collect()}[("jobs", "@Old")] == "keeper" and merged.count() == 5
    files = frame(spark, [("a.java", "package p.q;\n@Job @Old class A extends Base {}"), ("b.java", "#[x] class B"), ("c.java", "nothing"), ("d.java", None)])
    got = {(r.id, r.qualified_name, r.pattern) for r in W.custom_nodes(files, merged).collect()}
    assert got == {("a.java::jobs::runner", "p.q.runner", "@Job"), ("a.java::jobs::keeper", "p.q.keeper", "@Old"), ("a.java::core::entity", "p.q.entity", "extends Base"), ("b.java::own::rusty", "rusty", "#[x]")}


def test_contained_both_ways(spark, monkeypatch):
    """Few needles and many give the same pairs, with needles of every length, repeats, overlaps and long texts."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    rows = [(i, text(rng.randrange(60))) for i in range(60)] + [(60, None), (61, ""), (62, text(5000)), (63, "ab"), (63, "ab")]
    needles = [(i, text(1 + i % 14)) for i in range(80)] + [(80, ""), (81, None), (82, rows[5][1] or "x")]
    left, right = spark.createDataFrame(rows, "id long, t string"), spark.createDataFrame(needles, "n long, s string")
    want = sorted((i, n) for i, t in rows if t is not None for n, s in needles if s and s in t)
    for most in (1000, 1):
        monkeypatch.setattr(S, "NEEDLES", most)
        assert sorted((r.id, r.n) for r in S.contained(left, "t", right, "s").collect()) == want
        ranked = E.rank_edits(spark.createDataFrame([(1, "pay cash and rent", None), (2, "rent", "x"), (3, "none", "")], "edit_id long, content string, target string"), spark.createDataFrame([("Cash",), ("rent",), ("rent",)], "check string"), 2)
        assert [(r.edit_id, r.coverage) for r in ranked.collect()] == [(1, 1.0), (2, 0.65)]
