"""Runs of an answering loop: diagnoses of failures, the rule bank, replay, proposals and edits, curves, evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import edits as E
from . import graph as G
from . import ledger as L
from . import scoring as S

#: Kinds of failures by urgency, and what a rule made of one says.
PRIORITY = ("prompt_echo", "output_format_error", "scorer_alias_gap", "missing_business_rule")
TEMPLATES = {
    "prompt_echo": ("Final answer must not repeat Task/Skill reference/Code context; output only the deliverable.", ""),
    "output_format_error": ("Output format does not satisfy scorer checks: ", "."),
    "scorer_alias_gap": ("Output should satisfy missed checks (and configured aliases): ", "."),
    "missing_business_rule": ("Add skill rules so output covers missed checks: ", "."),
}
#: Ids that say nothing, actions by which a candidate came in, and the heading of verified rules.
WEAK_IDS = ("rule", "rules", "unknown", "none", "null", "id")
ACCEPTED = ("accept_new_best", "accept", "accept_new_best_from_knowledge", "accept_current_knowledge")
HEADING = "## Verified Rules"
NO_TEXT = "array<string>"


def _none() -> Column:
    return F.array().cast(NO_TEXT)


def _first(c: Column, n: int) -> Column:
    return F.slice(F.coalesce(c, _none()), 1, n)


# diagnosis


def diagnose(results: DataFrame, facts: DataFrame, require_facts: bool = True) -> DataFrame:
    """Failures (hard = 0) with failure_type, number of facts, status and a general rule.

    results has (id, hard, predicted_answer, missed_checks, scorer_type); the type is an echo, what the
    scorer says, or a missing rule, which needs a fact (id, fact) to be ready.
    """
    echo = ~S.detect_echo(F.coalesce(F.col("predicted_answer"), F.lit("")))["clean"]
    kind = F.when(echo, "prompt_echo").when(F.col("scorer_type").isin(*PRIORITY), F.col("scorer_type")).otherwise("missing_business_rule")
    failed = results.where("hard = 0").withColumn("failure_type", kind).join(facts.groupBy("id").agg(F.count("*").alias("facts")), "id", "left")
    n = F.coalesce("facts", F.lit(0))
    status = F.when((F.col("failure_type") == "missing_business_rule") & (n == 0) & F.lit(require_facts), "needs_review").otherwise("ready")
    return failed.withColumns({"facts": n, "status": status, "rule": general_rule(F.col("failure_type"), F.col("missed_checks"))})


def general_rule(kind: Column, missed: Column) -> Column:
    """The template of a kind with the first five missed checks."""
    named = F.array_join(_first(missed, 5), ", ")
    out = None
    for k, (head, tail) in TEMPLATES.items():
        text = F.concat(F.lit(head), named, F.lit(tail)) if tail else F.lit(head)
        out = F.when(kind == k, text) if out is None else out.when(kind == k, text)
    return out.otherwise("")


def by_urgency(diagnoses: DataFrame) -> DataFrame:
    """Diagnoses with their place: kinds by urgency, then id."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, PRIORITY)), F.col("failure_type")), F.lit(0)), F.lit(9))
    return diagnoses.withColumn("urgency", place.cast("int"))


def diagnosis_summary(diagnoses: DataFrame, by: str = "step", most: int = 12) -> DataFrame:
    """Per step: diagnoses of each kind, those to review, and the first distinct rules."""
    counts = diagnoses.groupBy(by).agg(F.count("*").alias("diagnoses"), F.count_if(F.col("status") == "needs_review").alias("needs_review"), *[F.count_if(F.col("failure_type") == k).alias(k) for k in PRIORITY])
    rules = diagnoses.where("rule <> ''").select(by, "rule").distinct().withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("rule"))).where(F.col("_n") <= most)
    return counts.join(rules.groupBy(by).agg(F.array_sort(F.collect_list("rule")).alias("rules")), by, "left").withColumn("rules", F.coalesce("rules", _none()))


def diagnosis_metrics(diagnoses: DataFrame, results: DataFrame) -> DataFrame:
    """One row: failures, those diagnosed, coverage, and the rates of ready ones and of those with facts."""
    failed = results.where("hard = 0").select("id").distinct()
    own = diagnoses.groupBy("id").agg(F.max((F.col("status") == "ready").cast("int")).alias("r"), F.max((F.col("facts") > 0).cast("int")).alias("f"))
    rate = lambda n, of: F.bround(n / F.greatest(of, F.lit(1)), 4)
    both = failed.join(own, "id", "left").agg(F.count("*").alias("failures"), F.count("r").alias("diagnosed"), F.coalesce(F.sum("r"), F.lit(0)).alias("ready"), F.coalesce(F.sum("f"), F.lit(0)).alias("with_facts"))
    return both.select("failures", "diagnosed", rate(F.col("diagnosed"), F.col("failures")).alias("coverage"), rate(F.col("ready"), F.col("diagnosed")).alias("ready_rate"), rate(F.col("with_facts"), F.col("diagnosed")).alias("fact_rate"))


def failure_records(results: DataFrame) -> DataFrame:
    """Failures with question cut at 300 and answer at 400 characters."""
    return results.where("coalesce(hard, 1) = 0").select("id", "task_type", F.substring("question", 1, 300).alias("question"), F.substring("predicted_answer", 1, 400).alias("answer"), "missed_checks")


def missed_counts(results: DataFrame, most: int = 5) -> DataFrame:
    """The most missed checks of each task type (none given: default), numbers folded to one."""
    group = F.coalesce(F.nullif("task_type", F.lit("")), F.lit("default"))
    check = F.when(T.is_numeric(F.col("m")), "<number>").otherwise(F.col("m"))
    counts = results.where("hard = 0").select(group.alias("task_type"), F.explode("missed_checks").alias("m")).groupBy("task_type", check.alias("check")).agg(F.count("*").alias("times"))
    n = F.row_number().over(Window.partitionBy("task_type").orderBy(F.desc("times"), "check"))
    return counts.withColumn("rank", n).where(F.col("rank") <= most)


def candidate_rules(diagnoses: DataFrame, require_facts: bool = True, least: int = 12) -> DataFrame:
    """Rules of ready diagnoses, one a text (first id); missing rules only with facts; too short ones fall away."""
    fit = (F.col("status") == "ready") & (F.length("rule") >= least)
    if require_facts:
        fit = fit & ((F.col("failure_type") != "missing_business_rule") | (F.col("facts") > 0))
    return diagnoses.where(fit).groupBy(T.text_key(F.col("rule")).alias("key")).agg(F.min_by("rule", "id").alias("text"), F.min("id").alias("first_id"), F.count("*").alias("support"))


# rule bank


def rule_hash(text: Column) -> Column:
    return F.substring(F.sha1(T.text_key(text)), 1, 10)


def is_weak_id(rule_id: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(rule_id, F.lit(""))))
    return low.isin(*WEAK_IDS) | (F.length(low) < 2)


def rule_id_of(text: Column) -> Column:
    """Lower-cased text as an id of 40 characters at most; short ones get the hash too, empty or weak ones are the hash."""
    trimmed = lambda c: F.regexp_replace(c, r"^_+|_+$", "")
    slug = trimmed(F.substring(trimmed(F.regexp_replace(T.text_key(text), r"[^a-z0-9._-]+", "_")), 1, 40))
    digest = rule_hash(text)
    return F.when((slug == "") | slug.isin(*WEAK_IDS), F.concat(F.lit("rule_"), digest)).when(F.length(slug) < 8, F.concat_ws("_", slug, digest)).otherwise(slug)


def unique_ids(rules: DataFrame, order: str) -> DataFrame:
    """rules(text) with distinct rule_id: the first of equal ids keeps it, others get the hash of their text, then a number."""
    named = rules.withColumn("_id", rule_id_of(F.col("text"))).withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy(order)))
    longer = F.concat_ws("_", F.regexp_replace(F.substring("_id", 1, 37), r"_+$", ""), rule_hash(F.col("text")))
    tried = named.withColumn("rule_id", F.when(F.col("_n") == 1, F.col("_id")).otherwise(longer))
    again = F.row_number().over(Window.partitionBy("rule_id").orderBy(F.col("_n") > 1, order))
    return tried.withColumn("_m", again).withColumn("rule_id", F.when(F.col("_m") > 1, F.concat_ws("_", "rule_id", F.col("_m").cast("string"))).otherwise(F.col("rule_id"))).drop("_id", "_n", "_m")


def active_rules(bank: DataFrame, most: int = 20, least_support: int = 1, least_score: float = 0.0, exclude_regressed: bool = True) -> DataFrame:
    """Active rules without regressions, of enough support and score: most supported first."""
    kept = bank.where((F.col("status") == "active") & (F.coalesce("support_count", F.lit(0)) >= least_support))
    if exclude_regressed:
        kept = kept.where(F.coalesce("regression_count", F.lit(0)) == 0)
    scored = kept.withColumn("score", L.rule_support(F.col("code_confidence"), F.col("accepted_count"), F.col("support_count"), F.col("regression_count")))
    return scored.where(F.col("score") >= least_score).orderBy(F.desc("support_count"), "rule_id").limit(most)


def with_evidence(rules: DataFrame) -> DataFrame:
    """Without missing-rule rows that have neither references nor facts."""
    bare = (F.col("failure_type") == "missing_business_rule") & (F.size(F.coalesce("evidence_refs", _none())) == 0) & (F.size(F.coalesce("code_facts", _none())) == 0)
    return rules.where(~bare)


def record_acceptance(bank: DataFrame, docs: DataFrame, fixed: DataFrame, run: str, most_runs: int = 8, most_items: int = 24) -> DataFrame:
    """The bank after documents (doc, text, step) came in: rules whose text one holds gain support, its run, its step and the fixed ids."""
    met = S.contained(docs.select("step", F.col("text").alias("_doc")), "_doc", bank.select("rule_id", "text"), "text").groupBy("rule_id").agg(F.count("*").alias("_met"), F.max("step").alias("_step"))
    items = fixed.select(F.col("id").alias("i")).where("coalesce(i, '') <> ''").distinct().agg(F.array_sort(F.collect_list("i")).alias("_fixed"))  # ids that one replay pool of bounded size fixed
    joined = bank.join(met, "rule_id", "left").crossJoin(F.broadcast(items))  # one row
    hit, n = F.col("_met").isNotNull(), F.coalesce("_met", F.lit(0))
    runs = F.array_distinct(F.concat(F.coalesce("source_runs", _none()), F.array(F.lit(run))))
    runs = F.slice(runs, F.greatest(F.lit(1), F.size(runs) - most_runs + 1), F.lit(most_runs))
    exemplars = F.slice(F.array_sort(F.array_union(F.coalesce("source_items", _none()), "_fixed")), 1, most_items)
    out = joined.withColumns({
        "support_count": F.col("support_count") + n, "accepted_count": F.col("accepted_count") + n, "last_accept_step": F.when(hit, F.col("_step")).otherwise(F.col("last_accept_step")),
        "source_runs": F.when(hit, runs).otherwise(F.col("source_runs")), "source_items": F.when(hit, exemplars).otherwise(F.col("source_items")),
    })
    return out.select(*bank.columns)


def record_regressions(bank: DataFrame, regressed: DataFrame) -> DataFrame:
    """Rules one of whose source items regressed have one regression more."""
    hit = bank.select("rule_id", F.explode("source_items").alias("id")).join(regressed.select("id").distinct(), "id", "left_semi").select("rule_id").distinct().withColumn("_hit", F.lit(1))
    return bank.join(hit, "rule_id", "left").withColumn("regression_count", F.coalesce("regression_count", F.lit(0)) + F.coalesce("_hit", F.lit(0))).select(*bank.columns)


def may_record_regression(action: Column, regressed: Column, candidate_hash: Column, accepted_hash: Column) -> Column:
    """Only what an accepted candidate itself regressed counts."""
    same = (F.coalesce(candidate_hash, F.lit("")) == "") | (candidate_hash == accepted_hash)
    return (F.size(F.coalesce(regressed, _none())) > 0) & action.isin(*ACCEPTED) & same


def promote(docs: DataFrame, doc: str = "doc", text: str = "text", heading: str = HEADING) -> DataFrame:
    """(doc, rule, rule_id) of the bullets below the verified heading."""
    body = E.sections(docs, doc, text).where(F.col("heading") == heading.lstrip("# ")).select("doc", "body")
    bullets = body.select("doc", F.explode(F.filter(F.split("body", "\n"), lambda x: x.rlike(E.BULLET))).alias("line"))
    rule = T.strip(F.regexp_replace("line", E.BULLET, ""))
    return bullets.select("doc", rule.alias("rule")).where("rule <> ''").distinct().withColumn("rule_id", rule_id_of(F.col("rule")))


def inject_rules(text: Column, rules: Column, heading: str = HEADING) -> Column:
    """text below a block of those rules that it doesn't hold; unchanged if it has the heading or holds all."""
    new = F.filter(rules, lambda r: ~text.contains(r))
    block = F.concat(F.lit(heading + "\n\n"), F.array_join(F.transform(new, lambda r: F.concat(F.lit("- "), r)), "\n"), F.lit("\n\n"))
    return F.when(text.contains(heading) | (F.size(new) == 0), text).otherwise(F.concat(block, text))


def inject_ids(text: Column) -> Column:
    """A comment with the rule's id before each bullet."""
    each = F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(E.BULLET), F.concat(F.lit("<!-- rule_id: "), rule_id_of(F.regexp_replace(x, E.BULLET, "")), F.lit(" -->\n"), x)).otherwise(x))
    return F.array_join(each, "\n")


def strip_ids(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^\s*<!-- rule_id: .* -->\s*$")), "\n")


def attribute(rules: DataFrame, results: DataFrame, text: str = "skill") -> DataFrame:
    """Per rule: results in whose document its text stands, those passed, failed, and the checks that these passed."""
    versions = results.select(F.col(text).alias("_doc")).distinct()
    holds = S.contained(versions, "_doc", rules.select("rule_id", F.col("text").alias("_rule")), "_rule")
    per = results.groupBy(F.col(text).alias("_doc")).agg(F.count("*").alias("uses"), F.sum("hard").alias("helped"))
    checks = results.where("hard = 1").select(F.col(text).alias("_doc"), F.explode("passed_checks").alias("c")).distinct()
    used = holds.join(per, "_doc").groupBy("rule_id").agg(F.sum("uses").alias("uses"), F.sum("helped").alias("helped"), (F.sum("uses") - F.sum("helped")).alias("failed"))
    good = holds.join(checks, "_doc").select("rule_id", "c").distinct().groupBy("rule_id").agg(F.array_sort(F.collect_list("c")).alias("helped_checks"))
    return used.join(good, "rule_id", "left").withColumn("helped_checks", F.coalesce("helped_checks", _none()))


def hygiene_pass(rules: DataFrame, attribution: DataFrame, least_uses: int = 1, most: int = 3) -> DataFrame:
    """(doc, pos, rule, why): bullets to delete, most a document: repeated ones, and rules with two regressions or more.

    rules has (doc, pos, rule, rule_id), attribution (rule_id, uses, regressions).
    """
    again = F.row_number().over(Window.partitionBy("doc", F.lower("rule")).orderBy("pos"))
    joined = rules.where("rule <> ''").withColumn("_again", again).join(attribution, "rule_id", "left")
    why = F.when(F.col("_again") > 1, "repeated").when(F.coalesce("regressions", F.lit(0)) >= 2, "regressed")
    n = F.row_number().over(Window.partitionBy("doc").orderBy("pos"))
    return joined.select("doc", "pos", "rule", why.alias("why")).where("why is not null").withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def hygiene_due(docs: DataFrame, unused_regressed: Column, text: str = "text", most_tokens: int = 4000, most_rules: int = 120) -> DataFrame:
    """docs with due: too long, too many rules, or two rules unused and regressed."""
    return docs.withColumn("due", (T.token_estimate(F.col(text), 1) > most_tokens) | (E.count_rules(F.col(text)) > most_rules) | (unused_regressed >= 2))


# replay


def replay_report(pool: DataFrame, results: DataFrame, by: str = "step", least_rate: float = 0.5) -> DataFrame:
    """Per step: rates, echoes, regressed and fixed items, passed, and why not: an echo, a regression, the rate."""
    joined = results.join(pool.select("id", "baseline_hard"), "id", "left")
    went = lambda a, b: F.count_if((F.col("baseline_hard") == a) & (F.col("hard") == b))
    out = joined.groupBy(by).agg(F.count("*").alias("total"), F.avg("hard").alias("rate"), F.bround(F.avg("soft"), 3).alias("soft"), F.count_if("echo").alias("echoes"), went(1, 0).alias("regressed"), went(0, 1).alias("fixed"))
    reason = F.when(F.col("echoes") > 0, "prompt_echo_in_replay").when(F.col("regressed") > 0, "replay_regression").when(F.col("rate") < least_rate, "hard_pass_rate_below_threshold").otherwise("ok")
    return out.select(by, "total", F.bround("rate", 3).alias("hard"), "soft", "echoes", "regressed", "fixed", reason.alias("reason"), (reason == "ok").alias("passed"))


def filter_pool(pool: DataFrame, most: int, include_echo: bool = False) -> DataFrame:
    """The pool's first items in order, without echoes if so asked."""
    return (pool if include_echo else pool.where("not coalesce(echo, false)")).orderBy("place").limit(most)


def merge_pools(pool: DataFrame, others: DataFrame, most: int = 12) -> DataFrame:
    """Items of other runs' pools put over those of the same id, the last pool's (by source) counting; echoes first, then never passed, then newest."""
    last = others.where("coalesce(id, '') <> ''").groupBy("id").agg(F.max_by(F.struct("echo", "baseline_hard", "last_step"), "source").alias("o"))
    joined = pool.join(last, "id", "full")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(c)).alias(c)
    merged = joined.select("id", F.coalesce(pick("echo"), F.lit(False)).alias("echo"), F.coalesce(pick("baseline_hard"), F.lit(0)).alias("baseline_hard"), F.coalesce(pick("last_step"), F.lit(0)).alias("last_step"))
    return merged.orderBy(F.desc("echo"), F.col("baseline_hard") != 0, F.desc("last_step"), "id").limit(most)


def merge_exemplars(pool: DataFrame, rules: DataFrame, registry: DataFrame, most: int = 12) -> DataFrame:
    """The pool with the source items of rules that a registry knows and the pool lacks, as passed before."""
    items = rules.select(F.explode("source_items").alias("id")).distinct().join(registry.select("id").distinct(), "id", "left_semi").join(pool.select("id"), "id", "left_anti")
    more = items.select("id", F.lit(False).alias("echo"), F.lit(1).alias("baseline_hard"), F.lit(0).alias("last_step"))
    both = pool.select("id", "echo", "baseline_hard", "last_step").unionByName(more)
    return both.orderBy(F.desc("echo"), F.col("baseline_hard") != 0, F.desc("last_step"), "id").limit(most)


# proposals and edits


def select_proposals(proposals: DataFrame, docs_text: str, fan_in: int = 20, most: int = 5) -> DataFrame:
    """Ready proposals as edits: most supported, then most confident; one a fingerprint, none whose rule the document holds, most at most."""
    ready = proposals.where("status = 'ready'").orderBy(F.desc("support"), F.desc("confidence"), "proposal_id").limit(fan_in)
    fit = ready.where((F.length(F.trim("rule")) >= 12) & ~F.lit(docs_text).contains(F.trim("rule")))
    first = F.row_number().over(Window.partitionBy(T.fingerprint(F.col("rule"))).orderBy(F.desc("support"), F.desc("confidence"), "proposal_id"))
    kept = fit.withColumn("_f", first).where("_f = 1").drop("_f")  # fan_in rows at most
    return kept.orderBy(F.desc("support"), F.desc("confidence"), "proposal_id").limit(most)


def merge_patches(patches: DataFrame, order: str = "seq") -> DataFrame:
    """Edits of patches, failures before successes, the first of each fingerprint: with their place."""
    urgency = F.when(F.col("source_type") == "failure", 0).otherwise(1)
    keyed = patches.withColumns({"_u": urgency, "_key": T.edit_fingerprint(F.col("op"), F.col("content"))})
    first = F.row_number().over(Window.partitionBy("_key").orderBy("_u", order))
    return keyed.withColumn("_f", first).where("_f = 1").drop("_f", "_key").withColumnRenamed("_u", "urgency")


def infer_traces(edits: DataFrame, failures: DataFrame) -> DataFrame:
    """(edit_id, failures, first_id, checks): failures one of whose missed checks the edit's content names.

    Edits that name the same checks share their failures, so these are counted once for each set of checks.
    """
    missed = failures.select("id", F.explode("missed_checks").alias("check")).distinct()
    checks = missed.select("check").distinct().withColumn("_low", F.lower("check"))
    met = S.contained(edits.select("edit_id", T.text_key(F.col("content")).alias("_c")), "_c", checks, "_low").select("edit_id", "check").distinct()
    named = G.cut(met.groupBy("edit_id").agg(F.array_sort(F.collect_list("check")).alias("checks")))
    sets = named.select("checks").distinct().select("checks", F.explode("checks").alias("check"))
    ids = sets.join(missed, "check").select("checks", "id").distinct().groupBy("checks").agg(F.count("*").alias("failures"), F.min("id").alias("first_id"))
    return named.join(ids, "checks").select("edit_id", "failures", "first_id", "checks")


def split_edits(edits: DataFrame, content: str = "content", current: str = "current") -> DataFrame:
    """edits with problem (null: valid) and valid."""
    return edits.withColumn("problem", E.edit_problem(F.col(content), F.col(current))).withColumn("valid", F.col("problem").isNull())


# curves, evaluations, epochs

METRICS = ("selection_score", "train_score", "test_score")


def curve_series(points: DataFrame, run: str = "run", order: str = "seq", metrics=METRICS) -> DataFrame:
    """(run, seq, metric, value): each metric's points, and best_score, the largest selection score so far from 0."""
    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    wide = points.withColumn("best_score", F.greatest(F.lit(0.0), F.max(metrics[0]).over(w)))
    return wide.unpivot([run, order], [*metrics, "best_score"], "metric", "value").where("value is not null")


def rollout_metrics(results: DataFrame, by: str) -> DataFrame:
    """Pass, echo and empty rates and mean soft score, four places."""
    rate = lambda c: F.bround(F.avg(c.cast("double")), 4)
    return results.groupBy(by).agg(F.count("*").alias("items"), rate(F.col("hard") == 1).alias("pass_rate"), rate(F.col("echo")).alias("echo_rate"), rate(F.coalesce(F.col("predicted_answer"), F.lit("")) == "").alias("empty_rate"), F.bround(F.avg("soft"), 4).alias("avg_soft"))


def best_never_falls(points: DataFrame, run: str = "run", order: str = "seq", best: str = "best") -> DataFrame:
    """Whether each run's recorded best score never falls, and the first point where it does."""
    before = F.lag(best).over(Window.partitionBy(run).orderBy(order))
    return points.withColumn("_falls", F.col(best) < before).groupBy(run).agg((~F.coalesce(F.max("_falls"), F.lit(False))).alias("monotonic"), F.min(F.when(F.col("_falls"), F.col(order))).alias("first_fall"))


def eval_summary(results: DataFrame, by: str, most: int = 20) -> DataFrame:
    """Per split: items, passes, means, the first failed ids, and results by scorer as 'scorer=n' in order."""
    counts = results.groupBy(by).agg(F.count("*").alias("items"), F.sum("hard").alias("passed"), F.bround(F.avg("hard"), 3).alias("hard"), F.bround(F.avg("soft"), 3).alias("soft"))
    n = F.row_number().over(Window.partitionBy(by).orderBy("id"))
    failed = results.where("hard = 0").select(by, "id", n.alias("_n")).where(F.col("_n") <= most).groupBy(by).agg(F.array_sort(F.collect_list("id")).alias("failed_ids"))
    scorers = results.groupBy(by, "scorer").agg(F.count("*").alias("n")).groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "scorer", F.col("n").cast("string")))), ",").alias("scorers"))
    return counts.join(failed, by, "left").join(scorers, by)


def item_report(results: DataFrame, items: DataFrame, traces: DataFrame) -> DataFrame:
    """Each result with its item's question and type and its last trace; what a result has itself counts first."""
    last = traces.groupBy("id").agg(F.max_by("trace", "seq").alias("trace"))
    own = items.select("id", F.col("question").alias("_q"), F.col("task_type").alias("_t"))
    return results.join(own, "id", "left").join(last, "id", "left").select("id", F.coalesce("question", "_q", F.lit("")).alias("question"), F.coalesce("task_type", "_t", F.lit("")).alias("task_type"), "hard", F.coalesce("trace", F.lit("")).alias("trace"))


def pair_counts(pairs: DataFrame, by: str | None = None) -> DataFrame:
    """Counts of the four states, whether any asks for an update, and whether all are stable successes."""
    states = ("improved", "regressed", "persistent_fail", "stable_success")
    n = [F.count_if(F.col("state") == s).alias(s) for s in states]
    return (pairs.groupBy(by) if by else pairs.groupBy()).agg(*n, F.max(F.col("state").isin(*states[:3])).alias("actionable"), F.min(F.col("state") == "stable_success").alias("stable_only"))


def quality_gate(docs: DataFrame, text: str = "text", reject: bool = True, **bounds) -> DataFrame:
    """Scan, clean what fails, scan again: the text to go on with, and why it is refused, if it is."""
    scanned = E.quality(docs, text, **bounds).withColumn("_clean", E.sanitise(F.col(text)))
    changed = ~F.col("passed") & (F.col("_clean") != F.col(text))
    again = scanned.select(*docs.columns, F.col("passed").alias("_first"), changed.alias("sanitised"), F.when(changed, F.col("_clean")).otherwise(F.col(text)).alias("kept"))
    told = E.quality(again, "kept", **bounds)
    why = F.when(F.col("leaks") > 0, "leakage").when(F.col("duplicates") > 0, "duplicates").when(~F.col("passed"), "size")
    return told.select(*docs.columns, "kept", "sanitised", (F.when(~F.col("passed"), why) if reject else F.lit(None).cast("string")).alias("refused"))


def buffered(batches: DataFrame, size: int, batch: str = "batch") -> DataFrame:
    """Updates that take size batches each: their batches, edits, and whether the last is left over."""
    group = F.floor((F.col(batch) - 1) / size).cast("bigint")
    return batches.groupBy(group.alias("update")).agg(F.count_distinct(batch).alias("batches"), F.sum("edits").alias("edits")).withColumn("left_over", F.col("batches") < size)


def buffer_summary(steps: DataFrame, last: int = 5) -> DataFrame:
    """Per run: rejected edits of its last steps, and failures of each kind among them."""
    place = F.dense_rank().over(Window.partitionBy("run").orderBy(F.desc("step")))
    recent = steps.withColumn("_p", place).where(F.col("_p") <= last)
    return recent.groupBy("run", "failure_type").agg(F.count("*").alias("rejected"), F.max("step").alias("last_step"))


def select_parent(candidates: DataFrame, current: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Per run: the best other candidate within tolerance of the run's best score; else the current one."""
    joined = candidates.join(current, "run").where((F.col("hash") != F.col("current_hash")) & (F.col("score") >= F.col("best_score") - tolerance))
    best = joined.groupBy("run").agg(F.min(F.struct(-F.col("score"), "hash")).alias("b"))
    return current.join(best, "run", "left").select("run", F.coalesce("b.hash", "current_hash").alias("parent"))


def resume_offsets(states: DataFrame) -> DataFrame:
    """Per run: where its newest checkpoint says to go on; the next epoch once its batches are done."""
    last = states.groupBy("run").agg(F.max_by(F.struct("epoch", "batch", "step", "batches"), "seq").alias("s")).select("run", "s.*")
    done = F.col("batch") + 1 >= F.col("batches")
    return last.select("run", F.when(done, F.col("epoch") + 1).otherwise(F.col("epoch")).alias("epoch"), F.when(done, 0).otherwise(F.col("batch") + 1).alias("batch"), (F.col("step") + 1).alias("step"))


def confident_items(atoms: DataFrame, least: float = 0.8, statuses=("accepted",)) -> DataFrame:
    return atoms.where((F.col("confidence") >= least) & F.col("status").isin(*statuses))


def admitted(text: Column, include=(), exclude=()) -> Column:
    """Whether a text may come in: no excluded keyword, and one of the included ones, if there are any."""
    low = F.lower(text)
    any_of = lambda words: T.any_contained(low, [w.lower() for w in words])
    return ~any_of(exclude) & (any_of(include) if include else F.lit(True))


def merge_items(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """old with the rows of new whose id is new."""
    return old.unionByName(new.where(f"coalesce(cast({key} as string), '') <> ''").join(old.select(key), key, "left_anti").dropDuplicates([key]).select(*old.columns))


def compare_metrics(metrics: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """(metric, baseline, candidate, change) of two runs side by side."""
    wide = metrics.where(F.col("run").isin(baseline, candidate)).groupBy("metric").pivot("run", [baseline, candidate]).agg(F.max("value"))
    return wide.select("metric", F.col(f"`{baseline}`").alias("baseline"), F.col(f"`{candidate}`").alias("candidate"), (F.col(f"`{candidate}`") - F.col(f"`{baseline}`")).alias("change"))


def best_score(*sources: Column) -> Column:
    """The first source that has a score."""
    return F.coalesce(*sources)


def knowledge_edits(ranked: DataFrame, least_support: int) -> DataFrame:
    """Success edits of enough support, which go on beside the gate."""
    return ranked.where((F.col("source_type") == "success") & (F.coalesce("support_count", F.lit(0)) >= least_support))


def hygiene_summary(results: DataFrame, *by: str) -> DataFrame:
    """Results of each hygiene reason, '' for clean ones."""
    return results.groupBy(*by, F.coalesce("hygiene_reason", F.lit("")).alias("reason")).agg(F.count("*").alias("results"))


def scenario_lines(failures: DataFrame, by: str, most: int = 5) -> DataFrame:
    """Lines for the failures that miss most, most of a group: what was asked and what to cover."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(F.size("missed_checks")), "id"))
    line = F.concat(F.lit("- When asked: "), F.substring("question", 1, 60), F.lit("; cover "), F.array_join(_first(F.col("missed_checks"), 3), ", "))
    return failures.withColumn("_n", n).where(F.col("_n") <= most).select(by, F.col("_n").alias("place"), "id", line.alias("line"))


def fact_texts(facts: DataFrame, most: int = 5) -> DataFrame:
    """(id, text): each item's surest facts, a line each."""
    n = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("confidence"), "statement"))
    kept = facts.withColumn("_n", n).where(F.col("_n") <= most)
    line = F.concat(F.lit("- "), F.col("statement"), F.lit(" ("), F.format_number("confidence", 2), F.lit(")"))
    return kept.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))


def context_text(mode: Column, refs: Column, inline: Column) -> Column:
    """What an item is given: the text itself, a hint at what to read, or nothing."""
    listed = F.array_join(F.coalesce(refs, _none()), ", ")
    return F.when((mode == "inline") & (F.coalesce(inline, F.lit("")) != ""), F.concat(F.lit("Context:\n"), inline)).when((mode == "agent_read") & (listed != ""), F.concat(F.lit("Read before answering: "), listed)).otherwise("")


def gate_stats(decisions: DataFrame, run: str, order: str) -> DataFrame:
    """Accepts, rejects and the rejects in a row at the end of each run of gate decisions."""
    return decisions.groupBy(run).agg(F.count_if(F.col("action") != "reject").alias("accepts"), F.count_if(F.col("action") == "reject").alias("rejects"), F.max_by("rejects", order).alias("in_a_row"))


def semantic_checks(passed: Column, ignored=(), most: int = 6) -> Column:
    """Distinct passed checks without ignored ones and amounts."""
    low = [w.lower() for w in ignored]
    kept = F.filter(F.coalesce(passed, _none()), lambda c: ~T.is_numeric(c) & (~F.lower(c).isin(*low) if low else F.lit(True)))
    return F.slice(F.array_distinct(kept), 1, most)


def static_counts(files: DataFrame, repo: str = "repo") -> DataFrame:
    """Files and bytes of each language and kind of a repository."""
    return files.groupBy(repo, "language", "kind").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))


def by_domain(atoms: DataFrame) -> DataFrame:
    """Records of each domain they apply to, general if none, with mean confidence."""
    domain = F.coalesce(F.nullif(F.try_element_at("applicability", F.lit("domain")), F.lit("")), F.lit("general"))
    return atoms.groupBy(domain.alias("domain")).agg(F.count("*").alias("records"), F.bround(F.avg("confidence"), 3).alias("confidence"))


#: Heading, note and length of the appendix of suggested rules.
SUGGESTED, SUGGESTED_NOTE, SUGGESTIONS = "### Auto-suggested rules", "_From M3 atoms (review before gate)._", 30


def append_suggestions(skills: DataFrame, atoms: DataFrame, least: float = 0.8, include=(), exclude=()) -> DataFrame:
    """skills (project, skill) with their project's surest accepted atoms (project, seq, claim, confidence, status) as an appendix, in place of an earlier one; unchanged without any."""
    fit = atoms.where((F.col("confidence") >= least) & (F.col("status") == "accepted") & (T.strip(F.coalesce("claim", F.lit(""))) != "") & admitted(F.col("claim"), include, exclude))
    n = F.row_number().over(Window.partitionBy("project").orderBy("seq", "claim"))
    few = fit.withColumn("_n", n).where(F.col("_n") <= SUGGESTIONS).groupBy("project").agg(F.array_sort(F.collect_list(F.struct("_n", F.concat(F.lit("- "), T.strip(F.col("claim"))).alias("l")))).alias("_ls"))
    base = F.regexp_replace(F.element_at(F.split("skill", SUGGESTED), 1), rf"{T.WHITE}+$", "")
    new = F.concat(base, F.lit(f"\n\n{SUGGESTED}\n\n{SUGGESTED_NOTE}\n\n"), F.array_join(F.transform("_ls", lambda x: x["l"]), "\n"), F.lit("\n"))
    return skills.join(few, "project", "left").withColumn("skill", F.when(F.col("_ls").isNotNull(), new).otherwise(F.col("skill"))).drop("_ls")
