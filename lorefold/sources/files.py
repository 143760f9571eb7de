"""Repositories, documents and JSON ledgers as DataFrames; and what is written back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: Language by file name ending.
LANGUAGES = {
    "py": "python", "java": "java", "js": "javascript", "ts": "typescript", "go": "go", "rs": "rust", "cpp": "cpp", "c": "c", "h": "c", "hpp": "cpp", "cs": "csharp", "rb": "ruby", "php": "php",
    "swift": "swift", "kt": "kotlin", "scala": "scala", "sql": "sql", "yaml": "yaml", "yml": "yaml", "json": "json", "xml": "xml", "md": "markdown",
}
#: Endings of binary files, and texts that mark generated ones.
BINARY = ("jar", "war", "class", "so", "dll", "exe", "png", "jpg", "gif", "ico", "svg", "zip", "tar", "gz", "pdf", "ttf", "woff")
GENERATED_MARKS = ("@Generated", "AUTO-GENERATED", "AUTOGENERATED", "Code generated by", "DO NOT EDIT", "do not edit", "Generated by the protocol buffer", "This file is generated", "THIS FILE IS GENERATED", "generated by protoc", "swagger-codegen", "openapi-generator")
DOCUMENT_TYPES = {"md": "markdown", "markdown": "markdown", "pdf": "pdf", "docx": "docx", "doc": "docx", "html": "html", "htm": "html", "txt": "text"}
#: Folders that are skipped besides those whose names begin with a point, and what marks the path of a generated file.
SKIPPED_FOLDERS = ("__pycache__", "node_modules", "venv", "target", "build", "dist")
GENERATED_FOLDERS = ("/generated/", "/gen/", "/build/generated/", "/target/generated-sources/", "/.proto/", "/protobuf/", "/__generated__/")
GENERATED_ENDINGS = (".pb.go", ".pb.cc", ".pb.h", ".g.dart", ".designer.cs", ".generated.cs", ".g.cs")


def ending(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def lookup(values: dict, key: Column, other: str = "") -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(other))


def has_generated_path(path: Column) -> Column:
    """By a folder or an ending of generated files."""
    low, out = F.lower(path), T.any_contained(F.lower(path), GENERATED_FOLDERS)
    for end in GENERATED_ENDINGS:
        out = out | low.endswith(end)
    return out


def is_generated(path: Column, text: Column) -> Column:
    head = F.substring(F.coalesce(text, F.lit("")), 1, 4096)
    return has_generated_path(path) | T.any_contained(head, GENERATED_MARKS) | head.rlike(r"(?mi)^//\s*<auto-generated")


def file_kind(path: Column, text: Column) -> Column:
    """binary, generated, test, config, doc or source, in this order."""
    low, end = F.lower(path), ending(path)
    return (
        F.when(end.isin(*BINARY), "binary").when(is_generated(path, text), "generated").when(low.rlike("test|spec|__test__"), "test").when(end.isin("yaml", "yml", "json", "xml", "toml", "ini", "properties"), "config")
        .when(end.isin("md", "rst", "txt", "html"), "doc").otherwise("source")
    )


def scan_repository(spark: SparkSession, root: str, include=("*",), exclude=(), max_mb: float = 5.0) -> DataFrame:
    """(path, language, kind, size_bytes, source_hash, text) of a tree's files; larger ones keep metadata only."""
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    path = F.regexp_replace("path", r"^[a-z]+:/+", "/")
    files = files.select(F.expr(f"substring(regexp_replace(path, '^[a-z]+:/+', '/'), {len(base) + 2})").alias("path"), "length", "content") if base.startswith("/") else files.select(path.alias("path"), "length", "content")
    folders = F.slice(F.split("path", "/"), F.lit(1), F.size(F.split("path", "/")) - 1)
    skipped = F.exists(folders, lambda f: f.isin(*SKIPPED_FOLDERS) | (f.startswith(".") & (f != ".github")))
    kept = files.where(~skipped & T.matches_any(F.col("path"), include) & ~T.matches_any(F.col("path"), exclude))
    small = F.when((F.col("length") <= int(max_mb * 1e6)) & ~ending(F.col("path")).isin(*BINARY), F.col("content"))
    text = F.when(F.is_valid_utf8(small.cast("string")), small.cast("string"))
    out = kept.select("path", F.col("length").alias("size_bytes"), text.alias("text"), small.alias("_c"))
    kind = file_kind(F.col("path"), F.col("text"))
    digest = F.when(kind.isin("binary", "generated") | F.col("_c").isNull(), "").otherwise(F.substring(F.sha2("_c", 256), 1, 16))
    return out.select("path", lookup(LANGUAGES, ending(F.col("path"))).alias("language"), kind.alias("kind"), "size_bytes", digest.alias("source_hash"), "text")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, type, version, text) of documents of known types; text is empty where bytes aren't UTF-8."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kept = files.where(ending(F.col("path")).isin(*DOCUMENT_TYPES))
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise("")
    return kept.select("path", lookup(DOCUMENT_TYPES, ending(F.col("path")), "text").alias("type"), F.substring(F.sha2("content", 256), 1, 16).alias("version"), text.alias("text"))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of a JSON-lines ledger; malformed lines are skipped, or fail if strict."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def read_split(spark: SparkSession, root: str, split: str, item_schema: str) -> DataFrame:
    """Items of <root>/<split>/items.json with their split."""
    items = spark.read.schema(f"items array<struct<{item_schema}>>").json(f"{root}/{split}/items.json", multiLine=True)
    return items.select(F.inline("items")).withColumn("split", F.lit(split))


def split_issues(splits: DataFrame) -> DataFrame:
    """(issue, id): missing ids, ids repeated in a split, ids in several splits."""
    missing = splits.where("coalesce(id, '') = ''").select(F.lit("missing_id").alias("issue"), F.col("id"))
    counted = splits.where("coalesce(id, '') <> ''").groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("split").alias("s"))
    return missing.unionByName(counted.where("n > s").select(F.lit("repeated").alias("issue"), "id")).unionByName(counted.where("s > 1").select(F.lit("overlap").alias("issue"), "id"))


def write_table(df: DataFrame, path: str, *partition: str, mode: str = "overwrite", kind: str = "parquet") -> None:
    """df as Parquet, JSON lines or CSV; with partition columns, rows are gathered by them first."""
    out = df.repartition(*partition) if partition else df
    writer = out.write.mode(mode).partitionBy(*partition) if partition else out.write.mode(mode)
    if kind == "csv":
        writer.option("header", True).option("nullValue", "").csv(path)
    else:
        writer.format(kind).save(path)


#: Patterns of a run log: a number or word in force from its line on, or on its line.
RUN_EVENTS = (("epoch", r"(?i)epoch\s+([0-9]+)"), ("step", r"(?i)step\s+([0-9]+)"), ("score", r"(?i)score[=:]\s*([0-9.]+)"), ("action", r"(?i)gate[=:]\s*(accept_new_best|accept|reject)"))


def parse_run_log(lines: DataFrame, run: str = "run", order: str = "line_no", text: str = "line") -> DataFrame:
    """Lines with the epoch and step in force, and score and gate action where they stand."""
    from pyspark.sql import Window

    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    got = lines.select("*", *[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(f"_{k}") for k, p in RUN_EVENTS])
    carried = [F.last(f"_{k}", ignorenulls=True).over(w).cast("int").alias(k) for k in ("epoch", "step")]
    return got.select(*lines.columns, *carried, F.col("_score").cast("double").alias("score"), F.col("_action").alias("action"))
