"""Rules proposed from a step's failures and successes, the patches made of them, and these beside reflected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .runs import semantic_checks

#: Heading of scenario rules, letters of a question, checks of a rule, members of a success rule, traces of an edit, letters of a rule at least.
SCENARIOS, QUESTION, CHECKS, MEMBERS, TRACES, SHORTEST = "### Scenario rules", 48, 6, 5, 8, 12
NO_CHECKS = "verified task-specific requirements"


def _none() -> Column:
    return F.array().cast("array<string>")


def failure_rule(task_type: Column, missed: Column) -> Column:
    """What a cluster of failures should be told."""
    task, some = F.coalesce(F.nullif(task_type, F.lit("")), F.lit("general")), F.coalesce(missed, _none())
    told = F.concat(F.lit("When handling "), task, F.lit(" tasks, ensure the answer satisfies: "), F.array_join(F.slice(some, 1, CHECKS), ", "), F.lit("."))
    return F.when(F.size(some) > 0, told).otherwise(F.concat(F.lit("Review "), task, F.lit(" handling against benchmark expected checks.")))


def success_line(question: Column, passed: Column, expected: Column, refs: Column, ignored=(), tail: str = "") -> Column:
    """A line for one success: its scene, the points it covered, and its first reference."""
    asked = T.strip(F.coalesce(question, F.lit("")))
    scene = F.when(asked == "", "同类场景").otherwise(F.concat(F.lit("「"), F.substring(asked, 1, QUESTION), F.when(F.length(asked) > QUESTION, "...").otherwise(""), F.lit("」这类场景")))
    own = F.when(F.size(F.coalesce(passed, _none())) > 0, passed).otherwise(expected)
    points = semantic_checks(F.filter(F.transform(F.coalesce(own, _none()), T.strip), lambda c: c != ""), ignored, CHECKS)
    text = F.when(F.size(points) > 0, F.array_join(points, "、")).otherwise(NO_CHECKS)
    ref = F.when(F.size(F.coalesce(refs, _none())) > 0, F.concat(F.lit("; ref "), F.get(refs, F.lit(0)))).otherwise("")
    return F.concat(F.lit("- 对于"), scene, F.lit("，保留成功输出模式：业务要点包括「"), text, F.lit("」" + (f"; {tail}" if tail else "")), ref, F.lit("."))


def _named(step: str) -> Column:
    number = F.col(step).cast("string")
    return F.concat(F.lit("prop-step"), F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number), F.lit("-"), F.col("cluster_id"))


def from_failures(clusters: DataFrame, least: int = 2) -> DataFrame:
    """(step, proposal_id, source, support, rule, risk, confidence, status, trace_ids) of clusters (step, cluster_id, task_type, support, missed_checks, trace_ids)."""
    enough = F.col("support") >= least
    confidence = F.least(F.lit(0.95), 0.5 + 0.1 * F.col("support"))
    return clusters.select(
        "step", _named("step").alias("proposal_id"), F.lit("failure_cluster").alias("source"), "support", failure_rule(F.col("task_type"), F.col("missed_checks")).alias("rule"),
        F.when(enough, "medium").otherwise("high").alias("risk"), F.bround(confidence, 3).alias("confidence"), F.when(enough, "ready").otherwise("needs_review").alias("status"), "trace_ids",
    )


def from_successes(traces: DataFrame, least: int = 2, ignored=(), tail: str = "") -> DataFrame:
    """The same of traces (step, id, task_type, hard, question, passed_checks, expected_checks, context_refs) that passed, a proposal a step and task.

    A rule has a line for each of the first MEMBERS by id and question; of many members only these and counts are held.
    """
    passed = traces.where("hard = 1").withColumn("task_type", F.coalesce(F.nullif("task_type", F.lit("")), F.lit("general")))
    n = F.row_number().over(Window.partitionBy("step", "task_type").orderBy("id", "question"))
    first = passed.withColumn("_n", n).where(F.col("_n") <= TRACES)
    line = success_line(F.col("question"), F.col("passed_checks"), F.col("expected_checks"), F.col("context_refs"), ignored, tail)
    sorted_ = F.array_sort(F.collect_list(F.struct("_n", line.alias("l"), F.col("id").cast("string").alias("id"))))
    few = first.groupBy("step", "task_type").agg(sorted_.alias("_m"))
    counts = passed.groupBy("step", "task_type").agg(F.count("*").alias("support")).where(F.col("support") >= least)
    rule = F.concat(F.lit(f"{SCENARIOS}\n\n"), F.array_join(F.transform(F.slice("_m", 1, MEMBERS), lambda m: m["l"]), "\n"))
    joined = counts.join(few, ["step", "task_type"]).withColumn("cluster_id", F.concat(F.lit("success-"), F.col("task_type")))
    confidence = F.bround(F.least(F.lit(0.9), 0.4 + 0.08 * F.col("support")), 3)
    return joined.select("step", _named("step").alias("proposal_id"), F.lit("success_cluster").alias("source"), "support", rule.alias("rule"), F.lit("low").alias("risk"), confidence.alias("confidence"), F.lit("ready").alias("status"), F.transform("_m", lambda m: m["id"]).alias("trace_ids"))


def to_edits(proposals: DataFrame, skills: DataFrame, fan_in: int = 20, most: int = 5) -> DataFrame:
    """(step, source_type, place, content, support, confidence, trace_ids): edits of each step's and source's ready proposals.

    The fan_in best by support, then confidence, then id; of these rules that are long enough, new to the step's
    skill (step, skill) and the first of their fingerprint; most at most.
    """
    source = F.when(F.col("source") == "failure_cluster", "failure").otherwise("success")
    best = Window.partitionBy("step", "source_type").orderBy(F.desc("support"), F.desc("confidence"), "proposal_id")
    ready = proposals.where("status = 'ready'").withColumn("source_type", source).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= fan_in)
    content = T.strip(F.col("rule"))
    fit = ready.join(skills.select("step", "skill"), "step", "left").withColumn("content", content).where((F.length("content") >= SHORTEST) & ~F.coalesce(F.col("skill").contains(F.col("content")), F.lit(False)))
    same = F.row_number().over(Window.partitionBy("step", "source_type", T.fingerprint(F.col("content"))).orderBy("_n"))
    place = F.row_number().over(Window.partitionBy("step", "source_type").orderBy("_n"))
    once = fit.withColumn("_f", same).where("_f = 1").withColumn("place", place).where(F.col("place") <= most)
    return once.select("step", "source_type", "place", "content", "support", "confidence", F.slice("trace_ids", 1, TRACES).alias("trace_ids"))


def to_patches(edits: DataFrame, proposals: DataFrame) -> DataFrame:
    """(step, source_type, reasoning, contents): a patch for each step and source that has edits."""
    source = F.when(F.col("source") == "failure_cluster", "failure").otherwise("success").alias("source_type")
    given = proposals.groupBy("step", source).agg(F.count("*").alias("_given"))
    made = edits.groupBy("step", "source_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "content"))), lambda e: e["content"]).alias("contents"))
    reasoning = F.concat(F.lit("trace_cluster_merge ("), F.size("contents").cast("string"), F.lit(" edits from "), F.col("_given").cast("string"), F.lit(" proposals)"))
    return made.join(given, ["step", "source_type"]).select("step", "source_type", reasoning.alias("reasoning"), "contents")


def beside_reflected(reflected: DataFrame, edits: DataFrame) -> DataFrame:
    """(step, source_type, content, origin, place): reflected edits (step, source_type, place, content), then proposed ones whose fingerprint their patch doesn't have."""
    both = reflected.select("step", "source_type", "place", "content", F.lit(0).alias("_o")).unionByName(edits.select("step", "source_type", "place", "content", F.lit(1).alias("_o")))
    key = T.fingerprint(F.col("content"))
    first = F.row_number().over(Window.partitionBy("step", "source_type", key).orderBy("_o", "place"))
    kept = both.withColumn("_f", first).where("_o = 0 or _f = 1")
    place = F.row_number().over(Window.partitionBy("step", "source_type").orderBy("_o", "place"))
    return kept.select("step", "source_type", "content", F.when(F.col("_o") == 0, "reflected").otherwise("proposed").alias("origin"), place.alias("place"))
