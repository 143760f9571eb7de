"""Queries over generated sources in several languages and shapes, with their SQL; what they hold follows from keys of part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import code as C
from ..operators import frameworks as W
from ..operators import frontend as J
from ..operators.graph import cut, dealt
from .text_queries import read, s

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def text(*parts):
    """Parts in a row; columns and plain strings alike."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def masked_files(spark, sf_dir):
    """A Java file a part: nested and repeated types, overloads, and declarations in comments and strings; some are broken, some Python."""
    k, n = F.col("p_partkey"), F.col("p_size")
    java = text(
        "package m", k % 10, ";\n// class Gone", k, " {\n/* public class Old", k, " {\n   public void lost(int x) { */\npublic class Part", k, " { static class Inner", n, " {} enum Kind", n, " { A }\n",
        '  String s = "class Text', k, ' { public int no(int x) {";\n  public int run(int x) { // public int never() {\n  }\n  public int run', n, "(String y, int z) {\n  }\n", F.when(k % 6 == 0, F.lit("/* public class Tail {\n")).otherwise(F.lit("")), "}\n",
    )
    python = text("def run", k, '():\n    """class Doc', k, "\n    def inner():\n    \"\"\"\n# def gone():\nclass Tool", n, ":\n    def act(self):\n        pass\n")
    body = F.when(k % 11 == 5, F.lit(None).cast("string")).when(k % 13 == 7, text("class Bin", k, " \0")).when(k % 4 == 1, python).otherwise(java)
    path = text("src/", k, F.when(k % 4 == 1, ".py").otherwise(".java"))
    return dealt(read(spark, sf_dir, "part"), "p_partkey").select(path.alias("path"), F.when(k % 4 == 1, "python").otherwise("java").alias("language"), body.alias("text"))


MASKED = """p AS (SELECT p_partkey AS k, p_size AS n, 'src/' || p_partkey || CASE WHEN p_partkey % 4 = 1 THEN '.py' ELSE '.java' END AS path, p_partkey % 4 = 1 AS py, p_partkey % 11 <> 5 AND p_partkey % 13 <> 7 AS good FROM part)"""


@query(
    f"""WITH {MASKED}, j AS (SELECT * FROM p WHERE good AND NOT py), y AS (SELECT * FROM p WHERE good AND py)
    SELECT path || '::Part' || k AS id, 'class' AS kind, 5 AS start_line, 'm' || (k % 10) || '.Part' || k AS qualified_name FROM j UNION ALL SELECT path || '::Inner' || n, 'class', 5, 'm' || (k % 10) || '.Inner' || n FROM j UNION ALL SELECT path || '::Kind' || n, 'class', 5, 'm' || (k % 10) || '.Kind' || n FROM j
    UNION ALL SELECT path || '::run', 'method', 7, 'm' || (k % 10) || '.Part' || k || '.run' FROM j UNION ALL SELECT path || '::run' || n, 'method', 9, 'm' || (k % 10) || '.Part' || k || '.run' || n FROM j
    UNION ALL SELECT path || '::run' || k, 'function', 1, 'src.' || k || '.run' || k FROM y UNION ALL SELECT path || '::Tool' || n, 'class', 6, 'src.' || k || '.Tool' || n FROM y UNION ALL SELECT path || '::act', 'function', 7, 'src.' || k || '.Tool' || n || '.act' FROM y"""
)
def code_parse(spark, sf_dir):
    """Symbols of sources whose comments and strings hold declarations too."""
    return C.parse(masked_files(spark, sf_dir))[0].select("id", "kind", "start_line", "qualified_name")


@query(f"WITH {MASKED} SELECT path, CASE WHEN k % 11 = 5 THEN 'no text' WHEN k % 13 = 7 THEN 'binary content' ELSE 'unclosed comment' END AS error FROM p WHERE NOT good OR (NOT py AND k % 6 = 0)")
def code_parse_errors(spark, sf_dir):
    """Files that can't be read whole, one row each."""
    return C.parse(masked_files(spark, sf_dir))[1].select("path", "error")


def script_files(spark, sf_dir):
    """Components that import each other under aliases, and modules with endings and index files of several kinds."""
    k, p = F.col("p_partkey"), read(spark, sf_dir, "part")
    pages = text(
        "import Next", k, " from './C", k + 1, "';\nimport { Frame as Box", k, ", List", k, " } from \"../lib/m", k % 5, "\";\nimport React from 'react';\nfunction C", k, "() {\n  items.map(item", k, "); wait().then(done", k, ").catch(function () {});\n  return <React.Fragment><Next", k, " a/><Box", k, "\n x={1}/><Shared/></React.Fragment>;\n}\n",
        "function item", k, "(x) { }\nfunction done", k + 1, "(x) { }\n",
    )
    own = dealt(p, "p_partkey").select(text("src/components/C", k, F.when(k % 3 == 0, ".tsx").otherwise(".jsx")).alias("path"), pages.alias("text"))
    module = lambda name, path: p.where("p_partkey = 0").select(F.lit(path).alias("path"), F.lit(f"export function {name}() {{ }}\n").alias("text"))
    out = own
    for name, path in (("M0", "src/lib/m0.ts"), ("Wrong", "src/lib/m0.js"), ("M1", "src/lib/m1/index.tsx"), ("Late", "src/lib/m1/index.ts"), ("M2", "src/lib/m2/index.ts"), ("M3", "src/lib/m3.jsx"), ("m4", "other/x.js"), ("Shared", "a/s.js"), ("Shared", "b/s.js"), ("Shared", "c/s.js")):
        out = out.unionByName(module(name, path))
    return out.withColumn("language", F.when(F.col("path").rlike(r"\.tsx?$"), "typescript").otherwise("javascript"))


PAGES = "p AS (SELECT p_partkey AS k, 'src/components/C' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.tsx' ELSE '.jsx' END AS path FROM part)"


@query(
    f"""WITH {PAGES} SELECT a.path AS src, b.path || '::C' || b.k AS dst FROM p a JOIN p b ON b.k = a.k + 1
    UNION ALL SELECT path, CASE k % 5 WHEN 0 THEN 'src/lib/m0.ts::M0' WHEN 1 THEN 'src/lib/m1/index.tsx::M1' WHEN 2 THEN 'src/lib/m2/index.ts::M2' WHEN 3 THEN 'src/lib/m3.jsx::M3' ELSE 'other/x.js::m4' END FROM p UNION ALL SELECT path, unnest(['a/s.js::Shared', 'b/s.js::Shared']) FROM p"""
)
def js_renders(spark, sf_dir):
    """What components render, through relative imports, aliases and index files."""
    files = cut(script_files(spark, sf_dir))
    return J.renders(files, cut(C.symbols(files))).select("src", "dst")


@query(f"WITH {PAGES} SELECT path AS src, path || '::item' || k AS dst FROM p")
def js_callbacks(spark, sf_dir):
    """Functions that their own file hands on; one of that name elsewhere doesn't count."""
    files = cut(script_files(spark, sf_dir))
    return J.callbacks(files, cut(C.symbols(files))).select("src", "dst")


@query(f"WITH {PAGES} SELECT path, unnest(['Next' || k, 'Box' || k, 'List' || k, 'React']) AS name, unnest(['./C' || (k + 1), '../lib/m' || (k % 5), '../lib/m' || (k % 5), 'react']) AS module FROM p")
def js_imports(spark, sf_dir):
    """Imported names under their aliases."""
    return J.import_map(script_files(spark, sf_dir))


@query(
    """WITH h AS (SELECT page_id, html FROM pages), p(framework, pattern, role) AS (VALUES ('html', '<script', 'script'), ('html', 'class="ad"', 'banner'), ('html', '<nav>', 'own menu'), ('site', 'lang="fr"', 'french'), ('site', '&amp;&amp;&amp;', 'noise'))
    SELECT page_id || '::' || framework || '::' || role AS id, framework, role, pattern FROM h JOIN p ON contains(html, pattern)"""
)
def framework_nodes(spark, sf_dir):
    """Patterns of settings, a repository's over a project's, met in web pages."""
    project = '{"html": {" <script ": "script", "class=\\"ad\\"": "banner", "<nav>": "menu", "": "x", "<p>": 4}, "site": {"lang=\\"fr\\"": "french"}, "off": "x"}'
    settings = spark.createDataFrame([("project", project), ("repository", '{"html": {"<nav>": "own menu"}, "site": {"&amp;&amp;&amp;": "noise"}}')], "origin string, settings string")
    patterns = W.parse_patterns(settings)
    merged = W.merge_patterns(patterns.where("origin = 'project'"), patterns.where("origin = 'repository'"))
    pages = read(spark, sf_dir, "pages").select(s(F.col("page_id")).alias("path"), F.col("html").alias("text"))
    return W.custom_nodes(pages, merged).select("id", "framework", "role", "pattern")
