"""Exact k-means over integer vectors, with bounds loosened by the norm of total displacement.

Contract
* Vectors of exactly DIM components, none null or non-finite, take part; component x counts as floor(SCALE * x).
  Beyond +-LIMIT a squared distance would leave 64 bits: such a component raises an error.
* The first centroids are the k vectors of smallest sha256 of `2:<vec_id>` (a null id: `2:`; ties by components).
  Of fewer vectors there are fewer centroids. Each round assigns every vector to the nearest centroid (ties: the
  smaller number) and moves each centroid to floor(sum / count); one without vectors stays. A last assignment follows.
* Per vector: vec_id, cluster, distance (squared), evaluated (distances that were computed in all), and centroid.
  Rows that repeat an id count each; further columns pass; an empty table gives no rows.

Method: the centroids of all rounds are kept (rounds x k x DIM numbers, in every task's closure). A vector carries
its centroid, the exact distance to it when last evaluated, and for every centroid a lower bound with the round of
its evaluation. Bounds aren't worn away round by round: a lower bound is the old distance less the norm of where
that centroid has gone in total since, an upper bound the old distance plus that norm. Only centroids whose lower
bound doesn't exceed the upper bound are evaluated again, in integers; ties never count as excluded. Rows stay
where they are: a round rewrites their bounds, and only sums per centroid are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

DIM, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256.0
LIMIT = 1 << 27
#: Vectors that a task works on at once.
ROWS = 2048
#: What floating point may take from a bound, relatively.
SLACK = 1e-9


def quantise(df: DataFrame, vec_id: str, vector: str, dim: int = DIM, scale: float = SCALE) -> DataFrame:
    """(id, v) of the vectors that take part."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("x")).where((F.size("x") == dim) & F.forall("x", fine))
    whole = lambda c: F.floor(c * F.lit(scale))
    held = lambda c: F.when(F.abs(c * F.lit(scale)) < LIMIT, whole(c)).otherwise(F.raise_error(F.lit("a component is too large for 64-bit distances")).cast("bigint"))
    return rows.select("id", F.transform("x", held).cast("array<bigint>").alias("v"))


def first_centroids(rows: DataFrame, k: int = CLUSTERS, dim: int = DIM) -> np.ndarray:
    by = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in rows.orderBy(by, "v").limit(k).select("v").collect()], np.int64).reshape(-1, dim)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of v and c, pairwise side by side."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def all_squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of v from every row of c; by one product where doubles hold it exactly."""
    most = max(int(np.abs(v).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * most * most * v.shape[1] < 1 << 53:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([squared(v, np.broadcast_to(x, v.shape)) for x in c], 1)


def reassign(v: np.ndarray, state: tuple | None, history: np.ndarray) -> tuple:
    """(own, own_sq, own_at, lower, lower_at, evaluated) against the newest centroids; state is an earlier outcome.

    own_sq is the squared distance to the own centroid as of round own_at; lower and lower_at hold the same for
    every centroid, as distances.
    """
    now, c, rows = len(history) - 1, history[-1], np.arange(len(v))
    if state is None:
        sq = all_squared(v, c)
        own = sq.argmin(1)
        return own, sq[rows, own], np.full(len(v), now), np.sqrt(sq), np.full(sq.shape, now, np.int16), np.full(len(v), len(c), np.int64)
    own, own_sq, own_at, lower, lower_at, evaluated = (np.array(x) for x in state)
    gone = np.sqrt(((history - c[None]).astype(np.float64) ** 2).sum(2))  # of each round's centroids, to where they are now
    least = (lower - gone[lower_at, np.arange(len(c))]) * (1 - SLACK) - SLACK

    def near(upper):
        inside = least <= (upper * (1 + SLACK) + SLACK)[:, None]
        inside[rows, own] = False
        return inside

    loose = near(np.sqrt(own_sq) + gone[own_at, own]).any(1)  # others keep their centroid, without a look
    stale = loose & ((own_at != now) & (gone[own_at, own] > 0))
    own_sq[stale] = squared(v[stale], c[own[stale]])
    evaluated[stale] += 1
    own_at[loose] = now
    lower[loose, own[loose]], lower_at[loose, own[loose]] = np.sqrt(own_sq[loose]), now
    row, j = np.nonzero(near(np.sqrt(own_sq)) & loose[:, None])
    sq = np.concatenate([squared(v[row[a : a + (1 << 16)]], c[j[a : a + (1 << 16)]]) for a in range(0, len(row), 1 << 16)]) if len(row) else np.zeros(0, np.int64)
    lower[row, j], lower_at[row, j] = np.sqrt(sq), now
    evaluated += np.bincount(row, minlength=len(v))
    order = np.lexsort((j, sq, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    r, n, d = row[first], j[first], sq[first]
    better = (d < own_sq[r]) | ((d == own_sq[r]) & (n < own[r]))
    own[r[better]], own_sq[r[better]] = n[better], d[better]
    return own, own_sq, own_at, lower, lower_at, evaluated


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(values.ravel()))


def _column(batch, name: str, width: int = 0) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else column.to_numpy(zero_copy_only=False)


BOUNDS = ("own", "own_sq", "own_at", "lower", "lower_at", "evaluated")
KINDS = "own bigint, own_sq bigint, own_at bigint, lower array<double>, lower_at array<smallint>, evaluated bigint"


def _round(history: np.ndarray):
    dim, k = history.shape[2], history.shape[1]

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                v = _column(batch, "v", dim)
                state = None
                if len(history) > 1:
                    state = [_column(batch, c, k if c.startswith("lower") else 0) for c in BOUNDS]
                out = reassign(v, state, history)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(_lists(x) if x.ndim > 1 else pa.array(x.astype(np.int64)) for x in out)], ["id", "v", *BOUNDS])

    return run


def moved(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of its vectors' mean; Spark sums (64 bits hold 2 ** 36 of the largest components), one row a centroid comes here."""
    dim = centroids.shape[1]
    sums = assigned.groupBy("own").agg(F.count("*").alias("n"), F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(dim)]).alias("s"))
    out = centroids.copy()
    for r in sums.collect():
        out[r["own"]] = [s // r["n"] for s in r["s"]]
    return out


def spread(rows: DataFrame) -> DataFrame:
    """rows over as many tasks as the cluster runs at once, where the input has fewer splits."""
    want = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(want) if rows.rdd.getNumPartitions() < want else rows


def cluster(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance, evaluated) of quantised rows, and the last centroids."""
    rows = cut(spread(rows))
    kind = rows.schema["id"].dataType.simpleString()
    history = first_centroids(rows, k, dim)[None]
    if not history.shape[1]:
        return rows.select("id", F.lit(0).cast("int").alias("cluster"), F.lit(0).cast("bigint").alias("distance"), F.lit(0).cast("bigint").alias("evaluated")), history[-1]
    for step in range(rounds + 1):
        rows = cut(rows.mapInArrow(_round(history), f"id {kind}, v array<bigint>, {KINDS}"))
        if step < rounds:
            history = np.concatenate([history, moved(rows, history[-1])[None]])
    centroids = F.broadcast(rows.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(history[-1])], "own bigint, c array<bigint>"))
    apart = F.aggregate(F.zip_with("v", "c", lambda x, y: (x - y) * (x - y)), F.lit(0).cast("bigint"), lambda s, x: s + x)  # a kept distance may be of an earlier round
    return rows.join(centroids, "own").select("id", F.col("own").cast("int").alias("cluster"), apart.alias("distance"), "evaluated"), history[-1]


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    found = cut(found)
    digests = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia")).first()[0]
    about = F.broadcast(per.join(F.broadcast(digests), "cluster"))  # CLUSTERS rows at most
    return found.join(about, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", F.lit(total).cast("bigint").alias("inertia"), "centroid_sha256")


def _oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    parts = [
        f"""e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS j, v AS c FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM e ORDER BY h, v LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, j := j)) AS m
  FROM (SELECT rid, vec_id, v, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM e, c{r}) GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""n{r} AS MATERIALIZED (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c
  FROM (SELECT m.j AS j, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT m, unnest(v) AS x, unnest(range({DIM})) AS i FROM a{r}) GROUP BY ALL) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c{r}.j, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (j))""")
    last = f"""SELECT vec_id, m.j::INTEGER AS cluster, m.d AS distance, sum(m.d) OVER (PARTITION BY m.j)::BIGINT AS cluster_inertia, sum(m.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m.j = c{rounds}.j"""
    return "WITH " + ",\n".join(parts) + "\n" + last


ORACLE = _oracle()
