"""Scores of answers against expected checks, gates over them, and failure clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .graph import cut, dealt

#: Patterns of answers that repeat their prompt or tools.
ECHO_PATTERNS = (r"(?im)^Task:\s", r"(?im)Skill reference:", r"(?im)Code context:", r"(?im)^Context references:", r"(?im)Follow the skill document", r"(?im)tool_calls", r"(?im)<\s*[｜|].*tool")


def check_key(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(","), F.lit("")))


def check_passes(answer: Column, check: Column, aliases: Column | None = None) -> Column:
    """Whether the answer holds the check, or one of its aliases (map of lower-cased check to array)."""
    answer = check_key(answer)
    own = answer.contains(check_key(check))
    if aliases is None:
        return own
    others = F.coalesce(F.try_element_at(aliases, F.lower(check)), F.array().cast("array<string>"))
    return own | F.exists(others, lambda a: answer.contains(check_key(a)))


#: Needles that every row is tried against in place; more of them are met by their rarest RUN characters in a row.
#: Texts are looked at in pieces of PIECE characters or more.
NEEDLES, RUN, PIECE = 1_000, 8, 4_096


def _runs(text: Column, n: int, *by: Column) -> Column:
    """Hashes of the distinct runs of n characters of a text."""
    spans = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.xxhash64(*by, F.substr(text, i, F.lit(n))))
    return F.array_distinct(F.when(F.length(text) >= n, spans).otherwise(F.array().cast("array<bigint>")))


def contained(rows: DataFrame, text: str, needles: DataFrame, needle: str, by: tuple[str, str] | None = None) -> DataFrame:
    """rows with the columns of each needle (none named as a column of rows) that their text contains.

    Few needles are broadcast and tried on every row. Of many, each is met through that run of its RUN characters
    (a shorter one through itself) which the fewest needles have, so that a common beginning brings nothing
    together. Texts are cut into pieces that overlap by the longest needle: hashes of a piece's runs bring piece and
    needle together, and only the two are compared. by names a column of rows and one of needles that must be equal.
    """
    filled = cut(needles.where(F.coalesce(F.col(needle), F.lit("")) != ""))
    inside = F.col(text).contains(F.col(needle))
    number, longest = filled.agg(F.count("*"), F.max(F.length(needle))).first()
    if number <= NEEDLES:
        return rows.join(F.broadcast(filled), inside & (F.col(by[0]) == F.col(by[1])) if by else inside)
    own, other = ([F.col(c)] for c in by) if by else ([], [])
    tagged, filled = cut(rows.withColumn("_row", F.monotonically_increasing_id())), cut(filled.withColumn("_needle", F.monotonically_increasing_id()))
    step = max(PIECE, longest)
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(step))
    pieces = tagged.where(F.col(text).isNotNull()).select("_row", *[c.alias("_by") for c in own], F.explode(F.transform(starts, lambda i: F.substr(F.col(text), i, F.lit(step + longest - 1)))).alias("_piece"))
    pieces = cut(dealt(pieces).withColumn("_at", F.monotonically_increasing_id()))
    sized = filled.select("_needle", *[c.alias("_by") for c in other], F.col(needle).alias("_text"), F.least(F.length(needle), F.lit(RUN)).alias("_size"))
    key, met = (["_by"] if by else []), None
    for n in sorted(r["_size"] for r in sized.select("_size").distinct().collect()):  # RUN sizes at most
        some = sized.where(F.col("_size") == n).select("_needle", F.explode(_runs(F.col("_text"), n, *map(F.col, key))).alias("_run"))
        common = some.groupBy("_run").agg(F.count("*").alias("_n"))
        rarest = cut(some.join(common, "_run").groupBy("_needle").agg(F.min(F.struct("_n", "_run")).alias("r")).select("_needle", F.col("r._run").alias("_run")))
        runs = pieces.select("_at", F.explode(_runs(F.col("_piece"), n, *map(F.col, key))).alias("_run"))
        pairs = runs.join(rarest.select("_run").distinct(), "_run", "left_semi").join(rarest, "_run").select("_at", "_needle")
        met = pairs if met is None else met.unionByName(pairs)
    both = met.join(sized.select("_needle", "_text", *[F.col(c).alias("_by2") for c in key]), "_needle").join(pieces, "_at")
    held = both.where(F.col("_piece").contains(F.col("_text")) & (F.col("_by") == F.col("_by2") if by else F.lit(True))).select("_row", "_needle").distinct()
    return tagged.join(held, "_row").join(filled, "_needle").drop("_row", "_needle")


def merge_aliases(a: Column, b: Column) -> Column:
    """Aliases of two maps with lower-cased keys, lists joined."""
    none = F.array().cast("array<string>")
    low = lambda m: F.transform_keys(m, lambda k, v: F.lower(k))
    return F.map_zip_with(low(a), low(b), lambda k, x, y: F.array_distinct(F.concat(F.coalesce(x, none), F.coalesce(y, none))))


def keyword_score(df: DataFrame, answer: str, checks: str, aliases: str | None = None) -> DataFrame:
    """passed_checks, missed_checks, hard, soft, accuracy, precision, recall, f1; without checks soft is 0."""
    a = F.coalesce(F.col(answer), F.lit(""))
    alias = F.col(aliases) if aliases else None
    passed = F.filter(checks, lambda c: check_passes(a, c, alias))
    out = df.withColumn("passed_checks", passed).withColumn("missed_checks", F.filter(checks, lambda c: ~check_passes(a, c, alias)))
    total, n = F.greatest(F.size(checks), F.lit(1)), F.size("passed_checks")
    soft = n / total
    precision = n / F.greatest(F.size(F.filter(F.split(T.collapse(a), " "), lambda w: w != "")), F.lit(1))
    f1 = F.when(precision + soft > 0, 2 * precision * soft / (precision + soft)).otherwise(F.lit(0.0))
    hard = (n == total).cast("int")
    return out.select("*", hard.alias("hard"), F.bround(soft, 3).alias("soft"), hard.cast("double").alias("accuracy"), F.bround(precision, 3).alias("precision"), F.bround(soft, 3).alias("recall"), F.bround(f1, 3).alias("f1"))


def rubric_score(answer: Column, rubric: Column, hard_from: float = 0.8) -> Column:
    """struct(soft, hard): share of the weights of dimensions (name, weight, keywords) with a keyword in the answer."""
    hit = lambda d: F.exists(d["keywords"], lambda k: check_key(answer).contains(check_key(k)))
    add = lambda which: F.aggregate(rubric, F.lit(0.0), lambda s, d: s + F.when(which(d), d["weight"]).otherwise(F.lit(0.0)))
    soft = F.bround(F.coalesce(add(hit) / F.nullif(add(lambda d: F.lit(True)), F.lit(0.0)), F.lit(0.0)), 3)
    return F.struct(soft.alias("soft"), (soft >= hard_from).cast("int").alias("hard"))


def normalise_script_score(df: DataFrame, hard_from: float = 1.0) -> DataFrame:
    """Scores of an outside scorer: soft within 0 and 1, hard by threshold if absent, missed checks filled in."""
    soft = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("soft", F.lit(0.0))))
    missed = F.when(F.col("missed_checks").isNull() | (F.size("missed_checks") == 0), F.array_except("expected_checks", F.coalesce("passed_checks", F.array().cast("array<string>")))).otherwise(F.col("missed_checks"))
    return df.withColumns({"soft": soft, "hard": F.coalesce(F.col("hard").cast("int"), (soft >= hard_from).cast("int")), "missed_checks": missed})


def mean_scores(results: DataFrame, *by: str) -> DataFrame:
    """Mean hard, soft, accuracy and f1, rounded to 3 places."""
    return results.groupBy(*by).agg(F.count("*").alias("items"), *[F.bround(F.avg(c), 3).alias(c) for c in ("hard", "soft", "accuracy", "f1")])


def gate_score(hard: Column, soft: Column, metric: str, weight: float = 0.5) -> Column:
    weight = min(1.0, max(0.0, weight))
    return {"hard": hard.cast("double"), "soft": soft.cast("double")}.get(metric, (1 - weight) * hard + weight * soft)


def effective_metric(items: int, metric: str) -> str:
    """Few items make a coarse metric, so soft or mixed scores decide."""
    return "soft" if items < 5 else "mixed" if items < 20 and metric == "hard" else metric


def gate_fold(
    steps: DataFrame, run: str, order: str, score: str, delta: float = 0.01, patience: int = 10, strict: bool = False, reject_ties: bool = False, accept_ties: bool = False, train: str | None = None, train_delta: float = 0.03
) -> DataFrame:
    """Accept or reject each step of a run in order: action, reason, best, current, rejects in a row, stopped.

    In this order: above the best score, a new best; above the current one, accepted; accepted too where the
    train score grew by train_delta and the current score is held, or where ties are accepted; else
    rejected. delta counts only if strict. A decision needs what its predecessors left, so runs go through
    tasks sorted and row by row; only the scores so far are held.
    """
    kinds = {c: steps.schema[c].dataType.simpleString() for c in (run, order)}
    least = delta if strict else 0.0

    def decide(frames):
        at, best, current, rejects, before = None, 0.0, 0.0, 0, None
        for frame in frames:
            out = []
            for r, o, s, t in zip(frame[run], frame[order], frame["_s"], frame["_t"]):
                if r != at:
                    at, best, current, rejects, before = r, 0.0, 0.0, 0, None
                held = s >= current - 1e-9
                if s > best + least:
                    action, reason, best, current = "accept_new_best", "new_best", s, s
                elif s > current + least:
                    action, reason, current = "accept", "improved", s
                elif not strict and before is not None and t is not None and t >= before + train_delta and held:
                    action, reason, current = "accept", "train_improved", s
                elif accept_ties and not strict and not reject_ties and held:
                    action, reason, current = "accept", "tie_accepted", s
                else:
                    tie, short = reject_ties and abs(s - current) <= 1e-9, strict and s > current
                    action, reason = "reject", "tie_rejected" if tie else "delta_insufficient" if short else "no_improvement"
                rejects = rejects + 1 if action == "reject" else 0
                before = t
                out.append((r, o, s, action, reason, best, current, rejects, rejects >= patience))
            yield pd.DataFrame(out, columns=[run, order, score, "action", "reason", "best", "current", "rejects", "stopped"])

    rows = steps.select(run, order, F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("_s"), (F.col(train).cast("double") if train else F.lit(None).cast("double")).alias("_t"))
    rows = rows.select(run, order, "_s", F.when(~F.isnan("_t"), F.col("_t")).alias("_t")).repartition(run).sortWithinPartitions(run, order)
    return rows.mapInPandas(_none_for_nan(decide, "_t"), f"`{run}` {kinds[run]}, `{order}` {kinds[order]}, `{score}` double, action string, reason string, best double, current double, rejects int, stopped boolean")


def _none_for_nan(use, column: str):
    """use() with the column's missing values as None."""

    def each(frames):
        return use(f.assign(**{column: f[column].astype(object).where(f[column].notna(), None)}) for f in frames)

    return each


def reject_streaks(steps: DataFrame, run: str, order: str, rejected: Column, patience: int) -> DataFrame:
    """Longest run of rejected steps in a row and the first order at which patience is used up, by gaps and islands."""
    w = Window.partitionBy(run).orderBy(order)
    marked = steps.withColumn("_r", rejected).withColumn("_g", F.sum((~F.col("_r")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.sum(F.col("_r").cast("int")).over(Window.partitionBy(run, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_n", streak).groupBy(run).agg(F.max("_n").alias("longest"), F.min(F.when(F.col("_n") >= patience, F.col(order))).alias("stop_at"))


def detect_echo(answer: Column, patterns=ECHO_PATTERNS) -> Column:
    """struct(clean, matched): patterns an answer matches."""
    matched = F.filter(F.array(*[F.when(answer.rlike(p), F.lit(p)) for p in patterns]), lambda p: p.isNotNull())
    return F.struct((F.size(matched) == 0).alias("clean"), matched.alias("matched"))


def apply_hygiene(results: DataFrame, answer: str, patterns=ECHO_PATTERNS) -> DataFrame:
    """Echoing answers lose every score and miss every check; reason prompt_echo."""
    bad = ~detect_echo(F.coalesce(F.col(answer), F.lit("")), patterns)["clean"]
    zero = {c: F.when(bad, F.lit(0).cast(results.schema[c].dataType)).otherwise(F.col(c)) for c in ("hard", "soft", "accuracy", "precision", "recall", "f1") if c in results.columns}
    arrays = {"missed_checks": F.when(bad, F.col("expected_checks")).otherwise(F.col("missed_checks")), "passed_checks": F.when(bad, F.array().cast("array<string>")).otherwise(F.col("passed_checks"))}
    return results.withColumn("hygiene_reason", F.when(bad, "prompt_echo").otherwise("")).withColumns(zero | {k: v for k, v in arrays.items() if k in results.columns})


def answer_body(answer: Column) -> Column:
    """From the first '## ' heading on, up to a following '# ' title; unchanged without heading."""
    body = F.regexp_extract(answer, r"(?ms)^(##\s+\S.*)", 1)
    cut = F.regexp_replace(body, r"(?s)^(.{20}.*?)\n# .*$", "$1")
    return T.strip(F.when(body == "", answer).otherwise(cut))


def compare_runs(before: DataFrame, after: DataFrame, key: str, score: str = "hard") -> DataFrame:
    """improved, regressed, persistent_fail or stable_success of every key in both."""
    a, b = before.select(key, F.col(score).alias("before")), after.select(key, F.col(score).alias("after"))
    state = F.when((F.col("before") == 0) & (F.col("after") == 0), "persistent_fail").when(F.col("after") > F.col("before"), "improved").when(F.col("after") < F.col("before"), "regressed").otherwise("stable_success")
    return a.join(b, key).withColumn("state", state)


def cluster_failures(results: DataFrame, by: list[str], sample: int = 5) -> DataFrame:
    """Failures (hard = 0) by key: support, distinct missed checks, first ids, mean soft, rank by support.

    missed and ids come from grouped rows, so that no list of a whole group is built.
    """
    failed = results.where("hard = 0")
    keys = {c: F.array_join(F.array_sort(F.col(c)), "|") if results.schema[c].dataType.simpleString().startswith("array") else F.col(c) for c in by}
    keyed = failed.withColumns({f"_k_{c}": v for c, v in keys.items()})
    names = [f"_k_{c}" for c in by]
    support = keyed.groupBy(*names).agg(F.count("*").alias("support"), F.bround(F.avg("soft"), 3).alias("avg_soft"))
    missed = keyed.select(*names, F.explode("missed_checks").alias("m")).distinct().groupBy(*names).agg(F.array_sort(F.collect_list("m")).alias("missed"))
    first = keyed.select(*names, "id", F.row_number().over(Window.partitionBy(*names).orderBy("id")).alias("n")).where(F.col("n") <= sample)
    ids = first.groupBy(*names).agg(F.array_sort(F.collect_list("id")).alias("sample_ids"))
    joined = support.join(missed, names, "left").join(ids, names, "left")
    # Ranks by support: those of greater support, from a count by support, and the place among equals.
    same = support.groupBy("support").agg(F.count("*").alias("_n"))
    above = same.withColumn("_above", F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("support")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("support").orderBy(*names))
    return joined.join(above, "support").withColumn("rank", (F.col("_above") + place).cast("int")).select("rank", *[F.col(f"_k_{c}").alias(c) for c in by], "support", "avg_soft", "missed", "sample_ids")


def failure_proposals(clusters: DataFrame, least_support: int = 2) -> DataFrame:
    confidence = F.least(F.lit(0.95), 0.5 + 0.1 * F.col("support"))
    return clusters.withColumn("status", F.when(F.col("support") >= least_support, "ready").otherwise("needs_review")).withColumn("confidence", F.bround(confidence, 3))


def success_proposals(results: DataFrame, least_support: int = 2) -> DataFrame:
    grouped = results.where("hard = 1").groupBy("task_type").agg(F.count("*").alias("support")).where(F.col("support") >= least_support)
    return grouped.withColumn("confidence", F.bround(F.least(F.lit(0.9), 0.4 + 0.08 * F.col("support")), 3))


def missed_summary(results: DataFrame) -> DataFrame:
    return results.where("hard = 0").select(F.explode("missed_checks").alias("check")).groupBy("check").count().orderBy(F.desc("count"), "check")


def classify_failure(df: DataFrame, answer: str = "predicted_answer", aliases: str | None = None) -> DataFrame:
    """failure_type: prompt_echo, alias_gap, missing_business_rule or unknown, in this order."""
    a = F.coalesce(F.col(answer), F.lit(""))
    gap = F.lit(False)
    if aliases:
        others = lambda m: F.coalesce(F.try_element_at(F.col(aliases), F.lower(m)), F.array().cast("array<string>"))
        gap = F.exists("missed_checks", lambda m: F.exists(others(m), lambda x: check_key(a).contains(check_key(x))))
    kind = F.when(~detect_echo(a)["clean"], "prompt_echo").when(gap, "alias_gap").when(F.col("hard") == 0, "missing_business_rule").otherwise("unknown")
    return df.withColumn("failure_type", kind)


def edit_budget(step: Column, total: int, initial: int, least: int, strategy: str) -> Column:
    """Edits allowed at a step: constant, linear, cosine or exponential decay, half to even."""
    part = F.least(F.lit(1.0), step / F.lit(float(max(1, total))))
    value = {
        "constant": F.lit(float(initial)), "linear": initial - (initial - least) * part,
        "cosine": least + 0.5 * (initial - least) * (1 + F.cos(F.lit(3.141592653589793) * part)), "exponential": initial * F.pow(F.lit(0.95), step),
    }[strategy]
    return F.greatest(F.lit(least), F.bround(value, 0).cast("int"))
