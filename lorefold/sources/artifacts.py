"""What modules leave behind in a run's folder, by module and name: saved, found and loaded; and ledgers appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tables of each module.
ARTIFACTS = {
    "code": ("nodes", "edges", "unresolved_refs", "entrypoints", "role_index", "module_tree", "leaf_contexts"),
    "documents": ("manifest", "document_index", "chunks", "tables"),
    "atoms": ("merged_atoms", "benchmark_seeds", "rejected_atoms", "evidence_index", "artifact_quality"),
    "runs": ("traces", "clusters", "proposals", "curve", "diagnoses", "retrieval", "selection_cache", "train_items"),
}
#: Characters kept of a trace's texts.
TRACE_CUTS = {"question": 500, "answer": 800, "reason": 200}


def save(root: str, module: str, tables: dict[str, DataFrame]) -> None:
    """Write a module's tables, replacing those of an earlier run."""
    unknown = set(tables) - set(ARTIFACTS[module])
    if unknown:
        raise ValueError(f"{module} has no {sorted(unknown)}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{module}/{name}")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(module, name, present) of all tables that a run may have."""
    there = lambda path: (p := spark._jvm.org.apache.hadoop.fs.Path(path)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    rows = [(m, n, bool(there(f"{root.rstrip('/')}/{m}/{n}/_SUCCESS"))) for m, names in ARTIFACTS.items() for n in names]
    return spark.createDataFrame(rows, "module string, name string, present boolean")


def load(spark: SparkSession, root: str, module: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{module}/{name}")


def append(root: str, module: str, name: str, rows: DataFrame, cuts: dict[str, int] | None = None) -> None:
    """Append rows to a ledger, texts cut as cuts say."""
    kept = rows.withColumns({c: F.substring(c, 1, n) for c, n in (cuts or {}).items() if c in rows.columns})
    kept.write.mode("append").parquet(f"{root.rstrip('/')}/{module}/{name}")


def index_sidecar(rows: DataFrame, *keys: str) -> DataFrame:
    """(key, value, row columns): rows by every key column that they fill, for look-ups by any of them."""
    named = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]), lambda s: F.coalesce(s["value"], F.lit("")) != "")
    return rows.withColumn("_k", F.explode(named)).select("_k.key", "_k.value", *rows.columns)


def trace_index(records: DataFrame, column: str = "value", order: str = "seq") -> DataFrame:
    """(request_id, calls) of recorded calls, a JSON text a row: each request's calls in order, without their texts; unreadable rows and those without an id fall away."""
    schema = "call_index long, call_file string, created_at string, backend_id string, request struct<request_id:string,role:string,stage:string>, response struct<request_id:string,status:string,finish_reason:string,tool_calls:array<string>>"
    read = records.select(F.col(order).alias("seq"), F.from_json(column, schema).alias("r"))
    text = lambda c: F.coalesce(c, F.lit(""))
    id_ = F.coalesce(F.nullif(F.col("r.request.request_id"), F.lit("")), F.nullif(F.col("r.response.request_id"), F.lit("")))
    call = F.struct(
        F.col("seq"), F.col("r.call_index").alias("call_index"), text(F.col("r.call_file")).alias("call_file"), text(F.col("r.created_at")).alias("created_at"), text(F.col("r.backend_id")).alias("backend_id"), text(F.col("r.request.role")).alias("role"),
        text(F.col("r.request.stage")).alias("stage"), text(F.col("r.response.status")).alias("status"), text(F.col("r.response.finish_reason")).alias("finish_reason"), F.greatest(F.lit(0), F.coalesce(F.size("r.response.tool_calls"), F.lit(0))).alias("tool_calls"),
    )
    return read.select(id_.alias("request_id"), call.alias("c")).where("request_id is not null").groupBy("request_id").agg(F.array_sort(F.collect_list("c")).alias("calls"))
