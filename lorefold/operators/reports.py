"""Tables and reports about whole runs: curves as fixed columns, retrieval totals, quality with recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import edits as E
from . import runs as R

#: Columns of a curve, in order.
CURVE = (
    "ts", "event", "step", "epoch", "train_rollout_soft", "train_rollout_hard", "train_passed", "train_failed", "train_total", "selection_hard", "selection_soft", "selection_gate",
    "best_score", "current_score", "gate_action", "gate_reason", "edit_count", "patch_count", "reason", "slow_update_gate", "test_score", "test_hard",
)
REGRESSED, SOURCES = 5, 5


def curve_table(points: DataFrame, run: str = "run") -> DataFrame:
    """points with their run and the columns of a curve, as texts: absent and null ones are empty, others fall away."""
    have = set(points.columns)
    return points.select(run, *[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in CURVE])


def backfilled(log: DataFrame, history: DataFrame, gates: DataFrame, run: str = "run", order: str = "line_no") -> DataFrame:
    """Curve points of runs from their parsed logs (epoch, step, score, action by line), histories and gate reports (run, step, ...).

    A step with a gate action, in a report, the history or the log, in this order, is a `gate` point; one without is
    a `skip`. Scores go by the report, then the history, then the log; best and current follow accepted ones.
    """
    last = log.where("step is not null").groupBy(run, "step").agg(F.max("epoch").alias("epoch"), F.max(order).alias("seq"), F.max_by("score", F.when(F.col("score").isNotNull(), F.col(order))).alias("_score"), F.max_by("action", F.when(F.col("action").isNotNull(), F.col(order))).alias("_action"))
    own = lambda df, name, *cols: df.select(run, "step", *[F.col(c).alias(f"_{name}_{c}") for c in cols])
    joined = last.join(own(history, "h", "action", "score", "edit_count"), [run, "step"], "left").join(own(gates, "g", "action", "score"), [run, "step"], "left")
    action, score = F.coalesce("_g_action", "_h_action", "_action"), F.coalesce("_g_score", "_h_score", "_score")
    taken = F.when(action.startswith("accept"), score)
    w = Window.partitionBy(run).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    event = F.when(action.isNull(), "skip").otherwise("gate")
    return joined.select(
        run, "seq", "step", "epoch", event.alias("event"), action.alias("gate_action"), F.bround(score, 4).alias("selection_gate"), F.bround(F.max(taken).over(w), 4).alias("best_score"),
        F.bround(F.last(taken, ignorenulls=True).over(w), 4).alias("current_score"), F.col("_h_edit_count").alias("edit_count"), F.when(action.isNull(), "no_valid_edits").alias("reason"),
    )


def retrieval_metrics(steps: DataFrame, sources: DataFrame, run: str = "run") -> DataFrame:
    """Totals and rates per run of its retrieval steps (plans, candidates, facts, cases, cases_with_facts, glue_first) and (run, source, n)."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint")
    out = steps.groupBy(run).agg(F.count("*").alias("steps"), *[total(c).alias(c) for c in ("plans", "candidates", "facts", "cases", "cases_with_facts", "glue_first")])
    per_case = lambda c, digits: F.bround(F.col(c) / F.greatest(F.col("cases"), F.lit(1)), digits)
    n = sources.groupBy(run, "source").agg(total("n").alias("n"))
    place = F.row_number().over(Window.partitionBy(run).orderBy(F.desc("n"), "source"))
    few = n.withColumn("_p", place).where(F.col("_p") <= SOURCES)
    top = few.groupBy(run).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", F.concat_ws("=", "source", F.col("n").cast("string")).alias("t")))), lambda x: x["t"]), ",").alias("top_sources"))
    return out.join(top, run, "left").select(
        run, "steps", F.col("plans").alias("query_plans"), "candidates", "facts", "cases_with_facts", per_case("cases_with_facts", 3).alias("facts_rate"), per_case("candidates", 1).alias("candidates_per_case"),
        per_case("facts", 1).alias("facts_per_case"), F.coalesce("top_sources", F.lit("")).alias("top_sources"), F.bround(F.col("glue_first") / F.col("steps"), 3).alias("glue_first_rate"),
    )


def quality_report(runs: DataFrame, points: DataFrame, tested: DataFrame, replayed: DataFrame, most_tokens: int = 4000) -> DataFrame:
    """A row a run of runs (run, initial, best, best_score): sizes, scores, whether its best ever fell, failures and what to do.

    points (run, seq, best), tested (run, id, hard, soft) and replayed (run, id, regressed) may lack a run.
    Recommendations, in order: replays that regressed, a best score that fell, leaks in the best document, its size.
    """
    scanned = E.quality(runs.select("run", "best"), "best", most_tokens=most_tokens)
    leaks = scanned.select("run", F.col("leaks").alias("leakage"), F.col("duplicates").alias("duplicate_rules"), F.col("tokens").alias("estimated_tokens"))
    falls = R.best_never_falls(points).select("run", F.col("monotonic"))
    tests = tested.groupBy("run").agg(F.bround(F.avg("soft"), 3).alias("test_soft"), F.bround(F.avg("hard"), 3).alias("test_hard"), F.count_if(F.col("hard") == 0).alias("hard_failures"))
    n = F.row_number().over(Window.partitionBy("run").orderBy("id"))
    few = replayed.where("regressed").withColumn("_n", n).where(F.col("_n") <= REGRESSED)
    again = few.groupBy("run").agg(F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda i: i.cast("string")), ", ").alias("_ids"))
    joined = runs.join(leaks, "run").join(falls, "run", "left").join(tests, "run", "left").join(again, "run", "left")
    advice = F.array_compact(F.array(
        F.when(F.col("_ids").isNotNull(), F.concat(F.lit("Replay regression on: "), F.col("_ids"))), F.when(~F.col("monotonic"), "Do not overwrite best during knowledge_accept."),
        F.when(F.col("leakage") > 0, "Sanitize benchmark/scorer-facing rules before gate."), F.when(F.col("estimated_tokens") > most_tokens, f"Reduce skill size below {most_tokens} tokens."),
    ))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select(
        "run", F.length("initial").alias("initial_chars"), F.length("best").alias("best_chars"), F.bround("best_score", 3).alias("best_score"), zero("test_soft"), zero("test_hard"), F.coalesce("monotonic", F.lit(True)).alias("monotonic"),
        "leakage", "duplicate_rules", "estimated_tokens", zero("hard_failures"), advice.alias("recommendations"),
    )
