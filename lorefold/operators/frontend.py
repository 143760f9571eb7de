"""Edges of JavaScript and TypeScript sources: components that are rendered through imports, and callbacks that are handed on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import shuffled

LANGUAGES = ("javascript", "typescript")
#: Endings that a module path is tried with, in order; tags that are no components; names that are no callbacks.
TRIED = ("", ".tsx", ".ts", ".jsx", ".js", "/index.tsx", "/index.ts")
NO_COMPONENTS, NO_CALLBACKS = ("Fragment", "React", "Suspense"), ("function", "async", "this")
#: How callbacks are handed on.
CALLBACKS = (
    r"\.addEventListener\s*\(\s*['\"][\w-]+['\"]\s*,\s*(\w+)", r"\.then\s*\(\s*(\w+)", r"\.catch\s*\(\s*(\w+)", r"setTimeout\s*\(\s*(\w+)", r"setInterval\s*\(\s*(\w+)", r"\.map\s*\(\s*(\w+)",
    r"\.forEach\s*\(\s*(\w+)", r"onClick=\{(\w+)\}", r"onChange=\{(\w+)\}", r"onSubmit=\{(\w+)\}", r"useEffect\s*\(\s*\(\s*\)\s*=>\s*\{[^}]*\b(\w+)\s*\(",
)
RENDERS, CALLS, MOST = 0.42, 0.38, 2


def import_map(files: DataFrame) -> DataFrame:
    """(path, name, module): names that a file imports as components, under their aliases; the last import of a name counts."""
    own = files.where(F.col("language").isin(*LANGUAGES))
    default, braces = r"import\s+([A-Z][A-Za-z0-9_]*)\s+from\s+['\"]([^'\"]+)['\"]", r"import\s+\{([^}]+)\}\s+from\s+['\"]([^'\"]+)['\"]"
    both = lambda p: F.arrays_zip(F.regexp_extract_all("text", F.lit(p), F.lit(1)).alias("names"), F.regexp_extract_all("text", F.lit(p), F.lit(2)).alias("module"))
    one = own.select("path", F.posexplode(both(default)).alias("at", "m")).select("path", F.lit(0).alias("kind"), "at", F.lit(0).alias("k"), F.col("m.names").alias("part"), "m.module")
    many = own.select("path", F.posexplode(both(braces)).alias("at", "m")).select("path", F.lit(1).alias("kind"), "at", F.posexplode(F.split("m.names", ",")).alias("k", "part"), "m.module")
    named = one.unionByName(many).withColumn("name", F.trim(F.regexp_replace("part", r"(?s)^.*? as ", ""))).where("name <> ''")
    return named.groupBy("path", "name").agg(F.max_by("module", F.struct("kind", "at", "k")).alias("module"))


def joined_path(base, module):
    """A relative module from a file's folder: `.` and empty parts go, `..` takes the part before with it."""
    folder = F.slice(F.split(base, "/"), F.lit(1), F.size(F.split(base, "/")) - 1)
    none = F.array().cast("array<string>")
    step = lambda done, part: F.when(part.isin("", "."), done).when((part == "..") & (F.size(done) > 0) & (F.element_at(F.concat(F.array(F.lit("")), done), -1) != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.concat(done, F.array(part)))
    return F.array_join(F.aggregate(F.concat(folder, F.split(module, "/")), none, step), "/")


def resolve_modules(imports: DataFrame, files: DataFrame) -> DataFrame:
    """imports with file: the first existing path among a relative module's endings, or null."""
    # A path is brought together once, below the rows that its endings make.
    asked = imports.where(F.col("module").startswith(".")).select("path", "module").distinct().select("path", "module", joined_path(F.col("path"), F.col("module")).alias("_base"))
    asked = asked.select("path", "module", F.posexplode(F.array(*[F.concat("_base", F.lit(end)) for end in TRIED])).alias("order", "file"))
    there = asked.join(shuffled(files.select(F.col("path").alias("file")).distinct()), "file").groupBy("path", "module").agg(F.min_by("file", "order").alias("file"))
    return imports.join(shuffled(there), ["path", "module"], "left")


def renders(files: DataFrame, nodes: DataFrame, known: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """(src, dst, kind, confidence): files to the components of their JSX tags.

    A tag stands for symbols of its name, the first most by id. One that no symbol has is looked up through the
    file's import of it: a relative module's first symbol, else symbols named like the module. Edges of known
    (src, dst) don't come again.
    """
    jsx = files.where(F.col("language").isin(*LANGUAGES) & (F.col("path").rlike(r"\.(tsx|jsx)$") | F.lower("path").contains("components")))
    tags = jsx.select("path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"<([A-Z][A-Za-z0-9_]*)\b"), F.lit(1)))).alias("name")).where(~F.col("name").isin(*NO_COMPONENTS))
    symbols = nodes.where(F.col("kind").isin("class", "function", "method")).select("name", F.col("id").alias("dst"), "file_path", "start_line")
    first = F.row_number().over(Window.partitionBy("name").orderBy("dst"))
    few = shuffled(symbols).withColumn("_n", first).where(F.col("_n") <= most).select("name", "dst")
    direct = tags.join(few, "name").select("path", "dst")
    lost = tags.join(few.select("name").distinct(), "name", "left_anti").join(shuffled(import_map(files)), ["path", "name"])
    found = resolve_modules(lost, files)
    heads = symbols.groupBy(F.col("file_path").alias("file")).agg(F.min_by("dst", F.struct("start_line", "dst")).alias("dst"))
    through = found.join(shuffled(heads), "file", "left")
    base = F.regexp_replace(F.element_at(F.split("module", "/"), -1), r"\.tsx?$", "")
    by_base = through.where("dst is null").select("path", base.alias("name")).join(few, "name").select("path", "dst")
    out = direct.unionByName(through.where("dst is not null").select("path", "dst")).unionByName(by_base).select(F.col("path").alias("src"), "dst").distinct()
    out = out if known is None else out.join(known.select("src", "dst"), ["src", "dst"], "left_anti")
    return out.select("src", "dst", F.lit("references").alias("kind"), F.lit(RENDERS).alias("confidence"))


def callbacks(files: DataFrame, nodes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(src, dst, kind, confidence): files to their own functions that they hand on as callbacks; edges of known don't come again."""
    own = files.where(F.col("language").isin(*LANGUAGES))
    names = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in CALLBACKS]))
    handed = own.select("path", F.explode(F.array_distinct(names)).alias("name")).where(~F.col("name").isin(*NO_CALLBACKS))
    targets = nodes.where(F.col("kind").isin("function", "method")).select(F.col("file_path").alias("path"), "name", F.col("id").alias("dst"))
    out = handed.join(targets, ["path", "name"]).select(F.col("path").alias("src"), "dst").distinct()
    out = out if known is None else out.join(known.where("kind = 'calls'").select("src", "dst"), ["src", "dst"], "left_anti")
    return out.select("src", "dst", F.lit("calls").alias("kind"), F.lit(CALLS).alias("confidence"))
