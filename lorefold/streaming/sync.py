"""Incremental upkeep of tables by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import cut, drop
from ..sources.store import Store


def upsert_stream(source: DataFrame, target: str, key: str, order: str, checkpoint: str, every: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Keep the newest row (by order) of each key in a store at target, bucketed by key.

    Each micro-batch is reduced to its newest rows and joined with the buckets of its keys, which alone are
    written anew as the version of its number; a batch that runs again after a failure writes the same version.
    """
    schema = source.schema

    def newest(df: DataFrame) -> DataFrame:
        return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("r")).select("r.*")

    def apply(batch: DataFrame, number: int) -> None:
        store = open_table(batch.sparkSession, target, schema, key, buckets)
        before = store.newest(number - 1)
        latest = cut(newest(batch))
        touched = store.touched(latest, key)
        store.commit(number, {"rows": (newest(latest.unionByName(store.read("rows", before, touched))), touched)}, before)
        drop(latest)

    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def open_table(spark: SparkSession, target: str, schema, key: str, buckets: int = 64) -> Store:
    return Store(spark, target, {"rows": schema}, {"rows": key}, buckets)


def read_version(spark: SparkSession, target: str, schema, key: str, number: int | None = None) -> DataFrame | None:
    """The rows as of the last version up to number, or None."""
    store = open_table(spark, target, schema, key)
    last = store.newest(number)
    return None if last is None else store.read("rows", last)


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts and mean values by event-time window and kind; rows later than the watermark are left out."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.window("_t", width).alias("w"), kind).agg(F.count("*").alias("events"), F.avg("value").alias("mean_value")).select(F.col("w.start").alias("start"), kind, "events", "mean_value")


def batches_of(number, size: int):
    """The update a batch belongs to, if updates take size batches each (numbered from 1)."""
    return F.floor((number - 1) / size)


#: Folders whose changes are not looked at, and endings of the files that are.
UNWATCHED = ("/.git/", "/node_modules/", "/target/", "/build/", "/.codegraph/")
WATCHED = (".java", ".py", ".js", ".ts", ".go", ".rs", ".kt", ".xml", ".yaml", ".yml")


def watched(path):
    """Whether a change of this file calls for a sync."""
    out = F.lit(False)
    for end in WATCHED:
        out = out | path.endswith(end)
    for folder in UNWATCHED:
        out = out & ~path.contains(folder)
    return F.coalesce(out, F.lit(False))


def debounced(events: DataFrame, quiet: str = "2 seconds", late: str = "10 seconds", source: str = "source", path: str = "path", time: str = "time") -> DataFrame:
    """(source, begun, fires, changes, files): one firing per burst of watched changes, a quiet period after its last.

    Every change puts the firing off; changes later than the watermark don't count any more. As a stream
    (append) a firing is given out once the watermark has passed it; files counts are exact while a burst's
    state is held, as sets of path hashes.
    """
    timed = events.where(watched(F.col(path))).withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    burst = timed.groupBy(F.session_window("_t", quiet).alias("w"), F.col(source).alias("source"))
    out = burst.agg(F.count("*").alias("changes"), F.size(F.collect_set(F.xxhash64(path))).cast("bigint").alias("files"))
    return out.select("source", F.col("w.start").alias("begun"), F.col("w.end").alias("fires"), "changes", "files")
