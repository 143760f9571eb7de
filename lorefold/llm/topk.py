"""Exact top-k search by inner product, by distributed selection on score histograms.

Contract
* Vectors of integer components (quantise() makes them); a vector that is null, has a null or
  non-finite component or a null id takes no part. Beyond its end a shorter vector counts as zero.
* Every query gets its k best candidates by (score, smaller id); all, if there are fewer; a candidate
  of the query's own id never counts. Rows that repeat an id are candidates each; of queries that
  repeat an id, the smallest vector asks. Empty tables give no rows.

Method: both sides are packed into blocks, and every block of queries meets every block of candidates
in some task. Each pass scores all pairs and counts, per query and task, scores in BINS equal parts of the
range that still holds its kth score; after log_BINS(range) passes that score is known exactly. The last pass
keeps what reaches it, at most k rows of a block and query, and ranks these. Only counts and kept rows
are shuffled; nothing of the size of the data reaches the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

BINS = 256
CANDIDATE_ROWS, QUERY_ROWS = 4096, 512
#: Cells of histograms that a task sums before it hands them on.
HELD = 1 << 22


def quantise(df: DataFrame, vec_id: str, vector: str, scale: float = 256.0) -> DataFrame:
    """(id, v): every component x as floor(scale * x), x as double; rows that take no part are left out."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("x")).where("id is not null and x is not null")
    fine = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = rows.where(fine).select("id", F.transform("x", lambda c: F.floor(c * F.lit(scale)).cast("bigint")).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(longest) - F.size("v")))
    return rows.select("id", F.when(F.size("v") < longest, filled).otherwise(F.col("v")).alias("v"))


def _pack(rows_per_block: int):
    def pack(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, rows_per_block):
                part = batch.slice(a, rows_per_block)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                v = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], ["ids", "v"])

    return pack


def blocks(rows: DataFrame, rows_per_block: int) -> DataFrame:
    return rows.mapInArrow(_pack(rows_per_block), "ids binary, v binary")


def _scores(x: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of queries and candidates, and scores with the query's own id marked NaN."""
    qid, cid = np.frombuffer(x["q_ids"], np.int64), np.frombuffer(x["ids"], np.int64)
    q, c = np.frombuffer(x["q_v"]).reshape(len(qid), -1), np.frombuffer(x["v"]).reshape(len(cid), -1)
    s = q @ c.T
    s[qid[:, None] == cid[None, :]] = np.nan
    return qid, cid, s


def _count(batches):
    """Histograms of each query, summed over the candidate blocks of a task: rows follow queries and tasks, not pairs of blocks."""
    total: dict = {}
    for batch in batches:
        for x in batch.to_pylist():
            qid, _, s = _scores(x)
            low, width = np.frombuffer(x["low"], np.int64), np.frombuffer(x["width"], np.int64)
            bin_of = np.floor_divide(s - low[:, None], width[:, None])
            fits = (bin_of >= 0) & (bin_of < BINS)  # what lies above is counted in need already, NaN nowhere
            flat = (np.arange(len(qid))[:, None] * BINS + np.where(fits, bin_of, 0).astype(np.int64))[fits]
            counts = np.bincount(flat, minlength=len(qid) * BINS).astype(np.int64)
            total[x["q_ids"]] = total.get(x["q_ids"], 0) + counts
            if len(total) * QUERY_ROWS * BINS > HELD:
                yield from map(_histogram, total.items())
                total.clear()
    yield from map(_histogram, total.items())


def _histogram(item) -> pa.RecordBatch:
    qid, counts = np.frombuffer(item[0], np.int64), item[1]
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(qid[at // BINS]), pa.array(at % BINS), pa.array(counts[at])], ["qid", "bin", "n"])


def _keep(k: int):
    def keep(batches):
        for batch in batches:
            for x in batch.to_pylist():
                qid, cid, s = _scores(x)
                least = np.frombuffer(x["low"], np.int64)
                row, col = np.nonzero(s >= least[:, None])
                score, ids = s[row, col].astype(np.int64), cid[col]
                order = np.lexsort((ids, -score, row))
                row, score, ids = row[order], score[order], ids[order]
                first = np.searchsorted(row, row)
                best = np.arange(len(row)) - first < k
                yield pa.RecordBatch.from_arrays([pa.array(qid[row[best]]), pa.array(ids[best]), pa.array(score[best])], ["query_id", "vec_id", "score"])

    return keep


def _pack_state(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, QUERY_ROWS):
            part = batch.slice(a, QUERY_ROWS)
            ids, low, width = (part.column(i).to_numpy().astype(np.int64).tobytes() for i in (0, 2, 3))
            v = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (ids, v, low, width)], ["q_ids", "q_v", "low", "width"])


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank from 1, vec_id, score for (id, v) tables of integer vectors."""
    asked = queries.groupBy("id").agg(F.min("v").alias("v"))
    largest = lambda df: df.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("m"), F.max(F.size("v")).alias("d")).first()
    a, b = largest(candidates), largest(asked)
    spark = candidates.sparkSession
    if a["m"] is None or b["m"] is None or k < 1:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    most = int(a["m"]) * int(b["m"]) * int(a["d"])
    if most >= 2**52:
        raise ValueError("scores could pass 2**52; take a smaller scale")
    passes = max(1, math.ceil(math.log(2 * most + 1, BINS)))
    packed = cut(blocks(candidates, CANDIDATE_ROWS).withColumn("group", F.spark_partition_id()))
    groups = F.explode(F.sequence(F.lit(0), F.lit(packed.agg(F.max("group")).first()[0] or 0)))
    state = cut(asked.withColumns({"low": F.lit(-most).cast("bigint"), "width": F.lit(BINS ** (passes - 1)).cast("bigint"), "need": F.lit(k).cast("bigint")}))

    def paired(state: DataFrame) -> DataFrame:
        # A stated query set, in blocks: one copy of each block for every group of candidate blocks.
        packed_queries = state.select("id", "v", "low", "width").mapInArrow(_pack_state, "q_ids binary, q_v binary, low binary, width binary")
        return packed.join(packed_queries.withColumn("group", groups), "group")

    for p in range(passes):
        counts = paired(state).select("ids", "v", "q_ids", "q_v", "low", "width").mapInArrow(_count, "qid long, bin long, n long").groupBy("qid", "bin").agg(F.sum("n").alias("n"))
        from_top = Window.partitionBy("qid").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        reached = counts.withColumn("up_to", F.sum("n").over(from_top)).join(state.select("id", "need"), F.col("qid") == F.col("id"))
        at = reached.where("up_to >= need").groupBy("qid").agg(F.max(F.struct("bin", (F.col("need") - F.col("up_to") + F.col("n")).alias("need"))).alias("s"))
        width = BINS ** max(0, passes - 2 - p)
        # Where fewer than k candidates are left, low stays and everything is kept.
        state = cut(
            state.join(at, F.col("id") == F.col("qid"), "left").select(
                "id", "v", F.coalesce(F.col("low") + F.col("s.bin") * F.col("width"), F.col("low")).alias("low"), F.lit(width).cast("bigint").alias("width"), F.coalesce("s.need", "need").alias("need")
            )
        )
    best = paired(state).select("ids", "v", "q_ids", "q_v", "low").mapInArrow(_keep(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows, rows.where("id % 50 = 0"), 5)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
