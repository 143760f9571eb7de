"""Ledgers that grow by steps: rules, replay pools, frontiers, curves, costs; and changes between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: US dollars per million tokens, (prompt, completion), by model.
PRICES = {"deepseek-v4-pro": (2.0, 8.0), "default": (1.0, 4.0)}


def rule_support(code_confidence: Column, accepted: Column, support: Column, regressions: Column) -> Column:
    """0.4 confidence, 0.4 share of accepted uses, 0.2 without regressions; three places."""
    used = F.least(F.lit(1.0), accepted / F.greatest(support, F.lit(1)))
    return F.bround(0.4 * code_confidence + 0.4 * used + 0.2 * (regressions == 0).cast("double"), 3)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new added, or put in place of those of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new.select(*old.columns))


def merge_rules(bank: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rules by text key: counters add up, sources join (24 at most, sorted), the last step stays."""
    key = F.lower(F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " ")))
    both = bank.unionByName(candidates).withColumn("_key", key)
    totals = both.groupBy("_key").agg(
        F.min_by("rule_id", F.struct("last_step", "rule_id")).alias("rule_id"), F.min_by("text", F.struct("last_step", "rule_id")).alias("text"),
        *[F.sum(c).alias(c) for c in ("support_count", "accepted_count", "regression_count")], F.max("last_step").alias("last_step"),
    )
    sources = both.select("_key", F.explode_outer("source_items").alias("s")).distinct().withColumn("n", F.row_number().over(Window.partitionBy("_key").orderBy("s"))).where("n <= 24 and s is not null")
    return totals.join(sources.groupBy("_key").agg(F.array_sort(F.collect_list("s")).alias("source_items")), "_key", "left").drop("_key")


def active_rules(bank: DataFrame, most: int, least_support: int = 1) -> DataFrame:
    kept = bank.where((F.col("support_count") >= least_support) & (F.col("regression_count") <= F.col("accepted_count")))
    return kept.orderBy(F.desc("support_count"), "rule_id").limit(most)


def replay_pool(pool: DataFrame, failures: DataFrame, most: int = 12) -> DataFrame:
    """Failures put into the pool by id; echoes first, then those never passed, then the newest; most stay."""
    f = failures.select("id", F.col("step").alias("_step"), F.col("echo").alias("_echo"))
    joined = pool.join(f, "id", "full")
    merged = joined.select("id", F.coalesce("_step", "last_step").alias("last_step"), (F.coalesce("_echo", F.lit(False)) | F.coalesce("echo", F.lit(False))).alias("echo"), F.coalesce("baseline_hard", F.lit(0)).alias("baseline_hard"))
    return merged.orderBy(F.desc("echo"), F.col("baseline_hard") != 0, F.desc("last_step"), "id").limit(most)


def replay_outcomes(pool: DataFrame, results: DataFrame) -> DataFrame:
    """regressed (passed before, not now) or fixed (the reverse) of pool items met in results."""
    now = results.groupBy("id").agg(F.max("hard").alias("now"))
    state = F.when((F.col("baseline_hard") == 1) & (F.col("now") == 0), "regressed").when((F.col("baseline_hard") == 0) & (F.col("now") == 1), "fixed").otherwise("same")
    return pool.join(now, "id", "left").withColumn("state", F.when(F.col("now").isNotNull(), state))


def frontier(candidates: DataFrame, size: int) -> DataFrame:
    """The best candidates: one row a hash (its best score, first seen), ties to the earlier."""
    best = candidates.groupBy("hash").agg(F.max("score").alias("score"), F.min("seq").alias("seq"))
    return best.orderBy(F.desc("score"), "seq").limit(size)


def newest(cache: DataFrame, most: int = 1000) -> DataFrame:
    """The most entries by first insertion."""
    return cache.groupBy("hash").agg(F.min("seq").alias("seq"), F.max_by("score", "seq").alias("score")).orderBy(F.desc("seq")).limit(most)


def running_best(points: DataFrame, run: str, order: str, score: str) -> DataFrame:
    """best: the largest score so far, from 0; new_best where it grows."""
    w = Window.partitionBy(run).orderBy(order)
    best = F.greatest(F.lit(0.0), F.max(score).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.coalesce(F.lag("best").over(w), F.lit(0.0))
    return points.withColumn("best", best).withColumn("new_best", F.col("best") > before)


def call_costs(calls: DataFrame, model: str = "model", prompt: str = "prompt_tokens", completion: str = "completion_tokens", prices=PRICES) -> DataFrame:
    """prompt_cost, completion_cost and total_cost by model, default price for others, six places."""
    pick = lambda i: F.coalesce(F.try_element_at(F.create_map(*[x for m, p in prices.items() for x in (F.lit(m), F.lit(p[i]))]), F.col(model)), F.lit(prices["default"][i]))
    a, b = F.coalesce(F.col(prompt), F.lit(0)) / 1_000_000 * pick(0), F.coalesce(F.col(completion), F.lit(0)) / 1_000_000 * pick(1)
    return calls.select("*", F.bround(a, 6).alias("prompt_cost"), F.bround(b, 6).alias("completion_cost"), F.bround(a + b, 6).alias("total_cost"))


def changed_keys(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change): added, changed or deleted between two snapshots of distinct keys."""
    a, b = old.select(F.col(key).alias("key"), F.col(value).alias("old")), new.select(F.col(key).alias("key"), F.col(value).alias("new"))
    joined = a.withColumn("in_old", F.lit(True)).join(b.withColumn("in_new", F.lit(True)), "key", "full")
    change = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "deleted").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return joined.select("key", change.alias("change")).where("change is not null")


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last n rows in append order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def curve_summary(points: DataFrame) -> DataFrame:
    """Counts of events and gate actions, and the best score."""
    event, action = F.col("event"), F.col("gate_action")
    return points.agg(
        F.count("*").alias("points"), F.count_if(event == "rollout").alias("rollouts"), F.count_if(event == "skip").alias("skips"), F.count_if(action == "reject").alias("rejects"),
        F.count_if(action.isin("accept", "accept_new_best")).alias("accepts"), F.max("selection_score").alias("best"),
    )


def rule_attribution(rules: DataFrame, results: DataFrame) -> DataFrame:
    """Per rule: results in which it was in the text, passed ones, failed ones. rules(rule_id, version), results(version, hard)."""
    per_version = results.groupBy("version").agg(F.count("*").alias("uses"), F.sum("hard").alias("helped"))
    return rules.join(per_version, "version").groupBy("rule_id").agg(F.sum("uses").alias("uses"), F.sum("helped").alias("helped"), (F.sum("uses") - F.sum("helped")).alias("failed"))
