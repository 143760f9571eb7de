"""Queries over events and the relational tables: ledgers, graphs, search; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import atoms as A
from ..operators import graph as G
from ..operators import ledger as L
from ..operators import scoring as S
from ..operators import search as Q
from ..streaming import sync

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# events as rollout results: an item per user, errors fail


def results(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("task_type"), "event_type", F.when(F.col("value") < 50, 0).otherwise(1).alias("hard"), F.col("value").alias("soft"), F.array(F.col("event_type"), F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string"))).alias("missed_checks"))


@query(
    """WITH f AS (SELECT event_id, event_type, value, unnest([event_type, 'v' || (event_id % 3)]) AS m FROM events WHERE value < 50),
    c AS (SELECT event_type, count(*) AS support, round_even(avg(value), 3) AS avg_soft, array_to_string(list_sort(list(event_id))[1:5], ',') AS sample_ids FROM events WHERE value < 50 GROUP BY event_type),
    m AS (SELECT event_type, array_to_string(list_sort(list(DISTINCT m)), '|') AS missed FROM f GROUP BY event_type)
    SELECT row_number() OVER (ORDER BY support DESC, event_type)::INTEGER AS rank, event_type, support, avg_soft, missed, sample_ids,
      CASE WHEN support >= 2 THEN 'ready' ELSE 'needs_review' END AS status, round_even(least(0.95, 0.5 + 0.1 * support), 3)::DOUBLE AS confidence FROM c JOIN m USING (event_type)"""
)
def event_failure_clusters(spark, sf_dir):
    found = S.failure_proposals(S.cluster_failures(results(spark, sf_dir), ["event_type"]))
    return found.select("rank", "event_type", "support", "avg_soft", F.array_join("missed", "|").alias("missed"), F.array_join(F.transform("sample_ids", lambda x: x.cast("string")), ",").alias("sample_ids"), "status", "confidence")


@query(
    """WITH b AS (SELECT event_id, user_id, value, greatest(0, max(value) OVER w) AS best FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT event_id, best, best > coalesce(lag(best) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS new_best FROM b"""
)
def event_running_best(spark, sf_dir):
    return L.running_best(read(spark, sf_dir, "events"), "user_id", "event_id", "value").select("event_id", "best", "new_best")


@query(
    """WITH m AS (SELECT *, value < 60 AS r, sum((value >= 60)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events),
    n AS (SELECT *, sum(r::INT) OVER (PARTITION BY user_id, g ORDER BY event_id) AS n FROM m)
    SELECT user_id, max(n)::BIGINT AS longest, min(CASE WHEN n >= 3 THEN event_id END) AS stop_at FROM n GROUP BY user_id"""
)
def event_reject_streak(spark, sf_dir):
    return S.reject_streaks(read(spark, sf_dir, "events"), "user_id", "event_id", F.col("value") < 60, 3)


GATE_SQL = """WITH RECURSIVE e AS (SELECT user_id, event_id, value AS s, (event_id * 7 % 101) / 100.0 AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
    n AS (SELECT e.*, p.t AS prior FROM e LEFT JOIN e p ON p.user_id = e.user_id AND p.i = e.i - 1),
    r AS (SELECT user_id, event_id, i, s, '' AS action, '' AS reason, 0.0::DOUBLE AS best, 0.0::DOUBLE AS current, 0 AS rejects FROM (SELECT user_id, NULL::BIGINT AS event_id, 0 AS i, 0.0::DOUBLE AS s FROM (SELECT DISTINCT user_id FROM events))
      UNION ALL SELECT user_id, event_id, i, s, action, reason, CASE WHEN reason = 'new_best' THEN s ELSE best END, CASE WHEN action = 'reject' THEN current ELSE s END, CASE WHEN action = 'reject' THEN rejects + 1 ELSE 0 END
      FROM (SELECT *, CASE WHEN reason = 'new_best' THEN 'accept_new_best' WHEN reason IN ('improved', 'train_improved', 'tie_accepted') THEN 'accept' ELSE 'reject' END AS action FROM (SELECT n.user_id, n.event_id, n.i, n.s, r.best, r.current, r.rejects, CASE WHEN n.s > r.best {least} THEN 'new_best' WHEN n.s > r.current {least} THEN 'improved'
        {more} WHEN {tie} THEN 'tie_rejected' WHEN {short} THEN 'delta_insufficient' ELSE 'no_improvement' END AS reason FROM r JOIN n ON n.user_id = r.user_id AND n.i = r.i + 1)))
    SELECT user_id, event_id, action, reason, best, current, rejects::INTEGER AS rejects, rejects >= {patience} AS stopped FROM r WHERE i > 0"""


def gate_steps(spark, sf_dir):
    return read(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_id") * 7 % 101 / 100.0).alias("train"))


@query(GATE_SQL.format(least="", more="WHEN n.t >= n.prior + 0.03 AND n.s >= r.current - 1e-9 THEN 'train_improved' WHEN n.s >= r.current - 1e-9 THEN 'tie_accepted'", tie="false", short="false", patience=3))
def event_gate_fold(spark, sf_dir):
    """The accept or reject gate over each user's events in order, train scores and ties counting."""
    return S.gate_fold(gate_steps(spark, sf_dir), "user_id", "event_id", "value", patience=3, accept_ties=True, train="train").drop("value")


@query(GATE_SQL.format(least="+ 5", more="", tie="abs(n.s - r.current) <= 1e-9", short="n.s > r.current", patience=10))
def event_gate_strict(spark, sf_dir):
    """The strict gate: gains below delta and ties are rejected."""
    return S.gate_fold(gate_steps(spark, sf_dir), "user_id", "event_id", "value", delta=5.0, strict=True, reject_ties=True).drop("value")


@query(
    """SELECT event_type, round_even(0.4 * avg(value) / 100 + 0.4 * least(1.0, count(*) FILTER (value >= 50) / greatest(count(*), 1)) + 0.2 * (count(*) FILTER (value < 1) = 0)::INT, 3)::DOUBLE AS score, count(*) AS support FROM events GROUP BY event_type"""
)
def event_rule_support(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("v"), F.count("*").alias("support"), F.count_if(F.col("value") >= 50).alias("ok"), F.count_if(F.col("value") < 1).alias("bad"))
    return e.select("event_type", L.rule_support(F.col("v") / 100, F.col("ok"), F.col("support"), F.col("bad")).alias("score"), "support")


@query(
    """WITH c AS (SELECT event_type, CASE WHEN event_type = 'purchase' THEN 'deepseek-v4-pro' ELSE 'other' END AS model, (event_id % 1000) * 37 AS p, (event_id % 777) * 11 AS k FROM events),
    d AS (SELECT event_type, p / 1000000 * CASE model WHEN 'deepseek-v4-pro' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS a, k / 1000000 * CASE model WHEN 'deepseek-v4-pro' THEN 8.0::DOUBLE ELSE 4.0::DOUBLE END AS b FROM c)
    SELECT event_type, count(*) AS calls, round(sum(round_even(a + b, 6)), 4) AS total_cost FROM d GROUP BY event_type"""
)
def event_cost_ledger(spark, sf_dir):
    model = F.when(F.col("event_type") == "purchase", "deepseek-v4-pro").otherwise("other")
    calls = read(spark, sf_dir, "events").select("event_type", model.alias("model"), (F.col("event_id") % 1000 * 37).alias("prompt_tokens"), (F.col("event_id") % 777 * 11).alias("completion_tokens"))
    return L.call_costs(calls).groupBy("event_type").agg(F.count("*").alias("calls"), F.round(F.sum("total_cost"), 4).alias("total_cost"))


def halves(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    one = lambda odd: e.where(F.col("event_id") % 2 == odd).groupBy("user_id").agg(F.max("event_type").alias("v"), F.max("value").alias("value"))
    return one(0), one(1)


HALVES_SQL = "a AS (SELECT user_id, max(event_type) AS v, max(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY user_id), b AS (SELECT user_id, max(event_type) AS v, max(value) AS value FROM events WHERE event_id % 2 = 1 GROUP BY user_id)"


@query(
    f"""WITH {HALVES_SQL} SELECT coalesce(a.user_id, b.user_id) AS key, CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'deleted' ELSE 'changed' END AS change
    FROM a FULL JOIN b ON a.user_id = b.user_id WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.v <> b.v"""
)
def event_changed_keys(spark, sf_dir):
    """Added, changed and deleted users between two snapshots (even and odd events)."""
    a, b = halves(spark, sf_dir)
    return L.changed_keys(a, b, "user_id", "v")


@query(
    f"""WITH {HALVES_SQL} SELECT user_id, CASE WHEN (a.value >= 90)::INT = 0 AND (b.value >= 90)::INT = 0 THEN 'persistent_fail' WHEN (b.value >= 90)::INT > (a.value >= 90)::INT THEN 'improved'
    WHEN (b.value >= 90)::INT < (a.value >= 90)::INT THEN 'regressed' ELSE 'stable_success' END AS state FROM a JOIN b USING (user_id)"""
)
def event_prev_curr_pairs(spark, sf_dir):
    a, b = (x.select("user_id", (F.col("value") >= 90).cast("int").alias("hard")) for x in halves(spark, sf_dir))
    return S.compare_runs(a, b, "user_id").select("user_id", "state")


@query(
    """WITH f AS (SELECT user_id AS id, max(event_id) AS last_step, bool_or(event_type = 'error') AS echo FROM events WHERE value < 20 AND event_id % 2 = 1 GROUP BY user_id),
    p AS (SELECT user_id AS id, max(event_id) AS last_step, false AS echo, max((value > 95)::INT) AS baseline_hard FROM events WHERE event_id % 2 = 0 GROUP BY user_id)
    SELECT coalesce(f.id, p.id) AS id, coalesce(f.last_step, p.last_step) AS last_step, coalesce(f.echo, false) OR coalesce(p.echo, false) AS echo, coalesce(baseline_hard, 0)::INTEGER AS baseline_hard
    FROM p FULL JOIN f ON p.id = f.id ORDER BY echo DESC, baseline_hard <> 0, last_step DESC, id LIMIT 12"""
)
def event_replay_topk(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    failures = e.where("value < 20 AND event_id % 2 = 1").groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("step"), F.max(F.col("event_type") == "error").alias("echo"))
    pool = e.where("event_id % 2 = 0").groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("last_step"), F.lit(False).alias("echo"), F.max((F.col("value") > 95).cast("int")).alias("baseline_hard"))
    return L.replay_pool(pool, failures)


@query("SELECT props AS hash, max(value) AS score, min(event_id) AS seq FROM events GROUP BY props ORDER BY score DESC, seq LIMIT 10")
def event_frontier(spark, sf_dir):
    return L.frontier(read(spark, sf_dir, "events").select(F.col("props").alias("hash"), F.col("value").alias("score"), F.col("event_id").alias("seq")), 10)


@query("SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS events, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL")
def event_props_profile(spark, sf_dir):
    """Dynamic JSON properties read as a typed column."""
    e = read(spark, sf_dir, "events").select("event_type", "value", (F.from_json("props", "k bigint")["k"] % 10).alias("k"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("events"), F.round(F.avg("value"), 6).alias("mean_value"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def stream_incremental(spark, sf_dir):
    """The newest event of every user, kept by a file stream in micro-batches (equal to the batch query below in tests)."""
    events = read(spark, sf_dir, "events")
    base = G.shared_folder(spark)
    events.repartitionByRange(4, "event_id").write.parquet(f"{base}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run = sync.upsert_stream(source, f"{base}/versions", "user_id", "event_id", f"{base}/checkpoint")
    run.awaitTermination()
    return sync.read_version(spark, f"{base}/versions", events.schema, "user_id").select("user_id", "event_id", "event_type", "value")


# graphs of foreign keys

EDGES_SQL = """e AS (SELECT 'region:' || n_regionkey AS src, 'nation:' || n_nationkey AS dst, 'region_nation' AS kind FROM nation UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'nation_customer' FROM customer
    UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey, 'nation_supplier' FROM supplier UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'customer_order' FROM orders)"""


@query(f"WITH {EDGES_SQL} SELECT kind, count(*) AS edges, count(DISTINCT src) AS sources FROM e GROUP BY kind")
def graph_fk_edges(spark, sf_dir):
    return G.stats(G.foreign_key_graph(spark, sf_dir))


def key_pairs(spark, sf_dir):
    return G.foreign_key_graph(spark, sf_dir).select("src", "dst")


@query(
    f"""WITH RECURSIVE {EDGES_SQL}, r AS (SELECT DISTINCT src AS start, src AS node, 0 AS depth FROM e WHERE starts_with(src, 'region:') UNION SELECT r.start, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 3)
    SELECT start, d::INTEGER AS depth, count(*) AS nodes FROM (SELECT start, node, min(depth) AS d FROM r GROUP BY ALL) WHERE d > 0 GROUP BY ALL"""
)
def graph_callees_depth(spark, sf_dir):
    """Nodes by distance from every region, three steps deep."""
    pairs = key_pairs(spark, sf_dir)
    start = pairs.where("src LIKE 'region:%'").select(F.col("src").alias("node")).distinct()
    return G.reach(pairs, start, 3).groupBy("start", "depth").agg(F.count("*").alias("nodes"))


@query(
    f"""WITH RECURSIVE {EDGES_SQL}, r AS (SELECT dst AS start, src AS node, 1 AS depth FROM e WHERE kind = 'customer_order' UNION ALL SELECT r.start, e.src, r.depth + 1 FROM r JOIN e ON e.dst = r.node WHERE r.depth < 3)
    SELECT node AS top, count(DISTINCT start) AS orders FROM r WHERE depth = 3 GROUP BY node"""
)
def graph_callers(spark, sf_dir):
    """Regions three steps above orders, with the orders they are reached from."""
    pairs = key_pairs(spark, sf_dir)
    start = pairs.where("dst LIKE 'order:%'").select(F.col("dst").alias("node")).distinct()
    up = G.reach(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")), start, 3)
    return up.where("depth = 3").groupBy(F.col("node").alias("top")).agg(F.countDistinct("start").alias("orders"))


@query(
    f"""WITH {EDGES_SQL}, up AS (SELECT dst AS start, 'callers' AS direction, src AS node FROM e WHERE starts_with(dst, 'nation:')), down AS (SELECT src, 'callees', dst FROM e WHERE starts_with(src, 'nation:'))
    SELECT start, direction, count(*) AS nodes FROM (SELECT * FROM up UNION SELECT * FROM down) GROUP BY ALL"""
)
def graph_impact(spark, sf_dir):
    """Direct neighbours of every nation both ways."""
    pairs = G.foreign_key_graph(spark, sf_dir).withColumn("kind", F.lit("calls"))
    start = pairs.where("src LIKE 'nation:%'").select(F.col("src").alias("node")).unionByName(pairs.where("dst LIKE 'nation:%'").select(F.col("dst").alias("node"))).distinct()
    return G.impact(pairs, start, 1).groupBy("start", "direction").agg(F.count("*").alias("nodes"))


@query(
    """SELECT 'region:' || n_regionkey AS start, 'supplier:' || s_suppkey AS target, 'region:' || n_regionkey || ' → nation:' || n_nationkey || ' → supplier:' || s_suppkey AS path, 2 AS length FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def graph_shortest_paths(spark, sf_dir):
    pairs = key_pairs(spark, sf_dir)
    start = pairs.where("src LIKE 'region:%'").select(F.col("src").alias("node")).distinct()
    target = pairs.where("dst LIKE 'supplier:%'").select(F.col("dst").alias("node")).distinct()
    return G.shortest_paths(pairs, start, target).select("start", "target", G.format_path(F.col("path")).alias("path"), "length")


@query(
    """SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS owner FROM (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_shipdate, l_partkey % 100 AS file FROM lineitem) l
    LEFT JOIN (SELECT o_orderkey, o_orderdate, o_custkey % 100 AS file FROM orders) o ON l.file = o.file AND o_orderdate <= l_shipdate GROUP BY rid"""
)
def graph_asof_owner(spark, sf_dir):
    """Lines of orders with the last order, before their shipping, of the same of 100 groups of customers and parts: an as-of join over a range shuffle."""
    types = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("line"), (F.col("o_custkey") % 100).alias("file"))
    members = read(spark, sf_dir, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("id"), F.col("l_shipdate").alias("line"), (F.col("l_partkey") % 100).alias("file"))
    return G.owners(members, types).select("id.l_orderkey", "id.l_linenumber", "owner")


# search over names


def name_nodes(spark, sf_dir):
    one = lambda t, k, n, kind: read(spark, sf_dir, t).select(F.concat(F.lit(kind + ":"), F.col(k).cast("string")).alias("id"), F.col(n).alias("name"), F.lit(kind).alias("kind"), F.lit(t).alias("file_path"), F.col(n).alias("qualified_name"))
    return one("part", "p_partkey", "p_name", "part").unionByName(one("supplier", "s_suppkey", "s_name", "supplier")).unionByName(one("customer", "c_custkey", "c_name", "customer")).unionByName(one("nation", "n_nationkey", "n_name", "nation"))


NODES_SQL = "n AS (SELECT 'part:' || p_partkey AS id, p_name AS name, 'part' AS kind FROM part UNION ALL SELECT 'supplier:' || s_suppkey, s_name, 'supplier' FROM supplier UNION ALL SELECT 'customer:' || c_custkey, c_name, 'customer' FROM customer UNION ALL SELECT 'nation:' || n_nationkey, n_name, 'nation' FROM nation)"


@query(
    f"""WITH {NODES_SQL}, s AS (SELECT id, kind, CASE WHEN list_contains(regexp_split_to_array(lower(name), '[^a-z0-9]+'), 'supplier') OR list_contains(regexp_split_to_array(lower(name), '[^a-z0-9]+'), '7') OR kind = 'supplier' THEN 1.0
    WHEN contains(lower(name), 'supplier') OR contains(lower(name), '7') THEN 0.6 END AS score FROM n WHERE kind IN ('supplier', 'part')) SELECT id, kind, score::DOUBLE AS score FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT 50"""
)
def search_cascade(spark, sf_dir):
    """A typed search: whole words first, then parts of words, of two kinds of nodes."""
    return Q.search(name_nodes(spark, sf_dir), Q.parse_query("kind:supplier,part supplier 7"), 50).select("id", "kind", "score")


@query(
    """WITH c AS (SELECT p_partkey AS candidate_id, p_size % 5 AS query_id, p_brand AS path, p_type AS symbol, (p_size % 2)::DOUBLE AS anchor, (p_partkey % 10) / 10 AS semantic, (p_partkey % 3 = 0)::INT::DOUBLE AS chain, (p_partkey % 7 = 0)::INT::DOUBLE AS evidence,
      CASE p_partkey % 4 WHEN 0 THEN 'service' WHEN 1 THEN 'unknown' WHEN 2 THEN 'handler_only' ELSE 'repository' END AS role FROM part),
    s AS (SELECT *, round_even(0.35 * anchor + 0.25 * CASE role WHEN 'service' THEN 1.0 WHEN 'unknown' THEN 0.3 ELSE 0.0 END + 0.20 * semantic + 0.10 * chain + 0.10 * evidence - 0.25 * CASE role WHEN 'handler_only' THEN 0.7 WHEN 'repository' THEN 1.0 ELSE 0.0 END, 4)::DOUBLE AS score FROM c),
    f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id, path, symbol ORDER BY score DESC, candidate_id) = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, candidate_id) AS rank FROM f)
    SELECT query_id, rank::INTEGER AS rank, candidate_id, score FROM r WHERE rank <= 8"""
)
def rerank_candidates(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    role = F.when(k % 4 == 0, "service").when(k % 4 == 1, "unknown").when(k % 4 == 2, "handler_only").otherwise("repository")
    c = p.select(
        k.alias("candidate_id"), (F.col("p_size") % 5).alias("query_id"), F.col("p_brand").alias("path"), F.col("p_type").alias("symbol"), (F.col("p_size") % 2).cast("double").alias("anchor"), (k % 10 / 10).alias("semantic"),
        (k % 3 == 0).cast("double").alias("chain"), (k % 7 == 0).cast("double").alias("evidence"), role.alias("role"),
    )
    return Q.rerank(c, 8).select("query_id", "rank", "candidate_id", "score")


@query("WITH d AS (SELECT DISTINCT p_brand, p_type FROM part) SELECT p_brand, count(*) AS symbols, array_to_string(list_sort(list(p_type))[1:20], ',') AS first_symbols FROM d GROUP BY p_brand")
def role_index(spark, sf_dir):
    return A.role_index(read(spark, sf_dir, "part"), ["p_brand"], "p_type").select("p_brand", "symbols", F.array_join("first_symbols", ",").alias("first_symbols"))


@query(
    """WITH RECURSIVE o AS (SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part),
    r AS (SELECT p_brand, p_partkey, i, (p_size <= 300) AS taken, CASE WHEN p_size <= 300 THEN p_size ELSE 0 END AS used FROM o WHERE i = 1
      UNION ALL SELECT o.p_brand, o.p_partkey, o.i, used + p_size <= 300, CASE WHEN used + p_size <= 300 THEN used + p_size ELSE used END FROM r JOIN o ON o.p_brand = r.p_brand AND o.i = r.i + 1)
    SELECT p_brand, p_partkey, taken FROM r"""
)
def leaf_packing(spark, sf_dir):
    """Parts of a brand packed in order into a budget of 300, those that don't fit passed over."""
    return G.pack_snippets(read(spark, sf_dir, "part"), "p_brand", "p_partkey", "p_size", 300)


@query("SELECT o_orderpriority AS priority, count(*) AS orders, sum((o_totalprice < 100000)::INT)::BIGINT AS small, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY o_orderpriority")
def order_quality_scan(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"), F.count_if(F.col("o_totalprice") < 100000).alias("small"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))


@query("SELECT event_type, sum(events)::BIGINT AS events, count(*) AS windows FROM (SELECT event_type, time_bucket(INTERVAL 10 MINUTES, ts) AS w, count(*) AS events FROM events GROUP BY ALL) GROUP BY event_type")
def event_windows(spark, sf_dir):
    """Ten-minute event-time windows, by the function that the stream uses."""
    return sync.windowed_counts(read(spark, sf_dir, "events"), "ts", "event_type").groupBy("event_type").agg(F.sum("events").alias("events"), F.count("*").alias("windows"))


@query(
    """SELECT s_nationkey, count(*) AS suppliers, sum(n)::BIGINT AS lines, round(sum(rev), 2) AS revenue FROM supplier JOIN (SELECT l_suppkey, count(*) AS n, sum(l_extendedprice * (1 - l_discount)) AS rev FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey GROUP BY s_nationkey"""
)
def graph_edge_weights(spark, sf_dir):
    """Lines and revenue along supplier edges: partial sums before the join."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    j = read(spark, sf_dir, "supplier").join(lines, F.col("s_suppkey") == F.col("l_suppkey"))
    return j.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.sum("n").alias("lines"), F.round(F.sum("rev"), 2).alias("revenue"))

