"""Training across epochs: samples that every run draws alike, slow updates between epochs, and runs that go on after a stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.store import Store
from . import runs as R
from . import scoring as S

SAMPLE = 20
#: What a suggestion says that asks for nothing.
NO_ACTION = (
    r"(?i)\b(no|not)\s+(changes?|updates?|modifications?)\s+(needed|required)\b", r"(?i)\b(skill definition|skill content)\s+(remained|is)\s+unchanged\b",
    r"(?i)\bno additional (tightening|loosening|rules?|guidance)\b", r"(?i)\bpreserve (the )?(core )?principles\b", r"(?i)\bconsistent pass\b",
)


def epoch_sample(items: DataFrame, seed: int, most: int = SAMPLE, by: str = "epoch", key: str = "id") -> DataFrame:
    """The most items of each epoch of smallest keyed hash: the same ones however the table is partitioned, others under another seed."""
    drawn = F.sha2(F.concat_ws(":", F.lit(seed), F.col(by).cast("string"), F.col(key).cast("string")), 256)
    n = F.row_number().over(Window.partitionBy(by).orderBy("_draw", key))
    return items.withColumn("_draw", drawn).withColumn("_n", n).where(F.col("_n") <= most).drop("_draw", "_n")


def actionable(text):
    """Whether a suggestion asks for anything."""
    out = F.lit(False)
    for pattern in NO_ACTION:
        out = out | text.rlike(pattern)
    return ~out


def slow_update(sample: DataFrame, before: DataFrame, after: DataFrame, skills: DataFrame, by: str = "epoch", key: str = "id") -> DataFrame:
    """Per epoch of skills (epoch, previous, current, suggestion): counts of the sample's outcomes, action and content.

    before and after (epoch, id, hard) are the results of both skills. In order: nothing sampled, `skip`; only
    stable successes among the compared, `skip_stable_success_only`; a suggestion, `suggested` or, if it asks for
    nothing, `skip_non_actionable`; no suggestion and equal skills, `skip_no_change`; else a summary, `rule_based`.
    """
    results = lambda df: df.join(sample.select(by, key), [by, key], "left_semi").withColumn("_key", F.to_json(F.struct(by, key)))
    pairs = S.compare_runs(results(before), results(after), "_key").withColumn(by, F.get_json_object("_key", f"$.{by}").cast(skills.schema[by].dataType))
    counts = R.pair_counts(pairs, by)
    sampled = sample.groupBy(by).agg(F.count("*").alias("sampled"))
    joined = skills.join(sampled, by, "left").join(counts, by, "left")
    told = F.coalesce(T.strip(F.col("suggestion")), F.lit("")) != ""
    action = (
        F.when(F.coalesce("sampled", F.lit(0)) == 0, "skip").when(F.coalesce("stable_only", F.lit(False)), "skip_stable_success_only").when(told & actionable(F.col("suggestion")), "suggested")
        .when(told, "skip_non_actionable").when(T.strip(F.col("previous")) == T.strip(F.col("current")), "skip_no_change").otherwise("rule_based")
    )
    summary = F.concat(F.lit("## Epoch Transition Summary\nSkill evolved from "), F.length("previous").cast("string"), F.lit(" → "), F.length("current").cast("string"), F.lit(" chars.\nEvaluated on "), F.col("sampled").cast("string"), F.lit(" sampled tasks.\nReview the differences for regression and improvement patterns."))
    content = F.when(F.col("action") == "suggested", T.strip(F.col("suggestion"))).when(F.col("action") == "rule_based", summary).otherwise("")
    counted = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("sampled", "improved", "regressed", "persistent_fail", "stable_success")]
    return joined.withColumn("action", action).select(by, *counted, "action", content.alias("content"))


# Checkpoints

STATES = {
    "states": "run string, step long, current_score double, best_score double, best_step long, current_skill string, best_skill string, epoch long, next_batch long, internal string",
    "skills": "run string, name string, text string",
}


def checkpoints(spark: SparkSession, root: str, buckets: int = 16) -> Store:
    """Where runs leave their states (a row a run) and skills (by run and name)."""
    return Store(spark, root, STATES, {"states": "run", "skills": "run"}, buckets)


def save_states(store: Store, number: int, states: DataFrame, skills: DataFrame) -> None:
    """Make checkpoint number: the states of some runs, and skills that are new or replace those of their names; both or nothing."""
    before, changes = store.newest(number - 1), {}
    for name, rows, keys in (("states", states, ["run"]), ("skills", skills, ["run", "name"])):
        touched = store.touched(rows, "run")
        kept = store.read(name, before, touched).join(rows.select(*keys), keys, "left_anti")
        changes[name] = (kept.unionByName(rows.select(*kept.columns)), touched)
    store.commit(number, changes, before)


def resume(store: Store, initial: DataFrame) -> DataFrame:
    """Per run of initial (run, skill): the skills to go on with, its last step, and where its batches go on.

    The best skill is that of the state, if it is there, else one named `best`, else the initial; the current one
    that of the state, else the last version by name, else the best.
    """
    number = store.newest()
    states, skills = store.read("states", number), store.read("skills", number)
    text = lambda column: states.select("run", F.col(column).alias("name")).join(skills, ["run", "name"]).select("run", F.col("text").alias(f"_{column}"))
    best = skills.where("name = 'best'").select("run", F.col("text").alias("_named_best"))
    last = skills.where("name LIKE 'skill_v%'").groupBy("run").agg(F.max_by("text", "name").alias("_last"))
    joined = initial.join(states, "run", "left")
    for more in (text("best_skill"), text("current_skill"), best, last):
        joined = joined.join(more, "run", "left")
    chosen = joined.withColumn("best", F.coalesce("_best_skill", "_named_best", "skill"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return chosen.select("run", F.coalesce("_current_skill", "_last", "best").alias("current"), "best", zero("step"), zero("epoch"), zero("next_batch"))
