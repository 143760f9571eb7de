"""Rule documents: their lines, rules and sections; checks, clean-up and edits of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .scoring import contained

BULLET = r"^\s*[-*+]\s+"
#: Texts of notes that carry prompts or tools instead of rules.
LEAKS = (r"(?i)tool_calls", r"(?i)\bas an ai\b", r"(?i)^system:", r"(?i)<\s*/?\s*(think|tool)")


def rule_lines(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, pos, rule, rule_id): bullets, with the id of the last '<!-- rule_id: x -->' line before."""
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    own = F.nullif(F.regexp_extract("line", r"<!--\s*rule_id:\s*([\w.-]+)", 1), F.lit(""))
    carried = F.last(own, ignorenulls=True).over(Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("rule_id", carried).where(F.col("line").rlike(BULLET)).select("doc", "pos", T.strip(F.regexp_replace("line", BULLET, "")).alias("rule"), "rule_id")


def sections(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, pos, heading, body) of each heading and what follows it."""
    parts = F.regexp_extract_all(F.concat(F.lit("\n"), F.col(text)), F.lit(r"(?s)(\n#{1,6} .*?)(?=\n#{1,6} |$)"), F.lit(1))
    one = docs.select(F.col(doc).alias("doc"), F.posexplode(parts).alias("pos", "part"))
    return one.select("doc", "pos", F.regexp_extract("part", r"^\n#{1,6} ([^\n]*)", 1).alias("heading"), T.strip(F.regexp_replace("part", r"^\n[^\n]*", "")).alias("body"))


def bullets(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(BULLET)), lambda x: T.text_key(F.regexp_replace(x, BULLET, "")))


def count_rules(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?m)^\s*[-*+]\s+\S|^\s*\|(?!\s*[-:|\s]+$).*\|\s*$"))


def duplicate_rules(text: Column) -> Column:
    return F.size(bullets(text)) - F.size(F.array_distinct(bullets(text)))


def quality(docs: DataFrame, text: str = "text", most_tokens: int = 4000, most_rules: int = 120) -> DataFrame:
    """tokens, rules, duplicates, leaks, and passed of each document."""
    t = F.col(text)
    leaks = F.size(F.filter(F.split(t, "\n"), lambda x: _any(x, LEAKS)))
    out = docs.withColumns({"tokens": T.token_estimate(t, 1), "rules": count_rules(t), "duplicates": duplicate_rules(t), "leaks": leaks})
    return out.withColumn("passed", (F.col("tokens") <= most_tokens) & (F.col("rules") <= most_rules) & (F.col("duplicates") == 0) & (F.col("leaks") == 0))


def _any(c: Column, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(p)
    return out


def sanitise(text: Column) -> Column:
    """Without leaking lines and without bullets that repeat an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~_any(x, LEAKS))
    keyed = F.transform(lines, lambda x, i: F.named_struct(F.lit("key"), F.when(x.rlike(BULLET), T.text_key(F.regexp_replace(x, BULLET, ""))), F.lit("i"), i, F.lit("line"), x))
    # Sorted by key, a bullet repeats an earlier one if it follows its like; kept lines are sorted back by place. The
    # sorted array is named once, or it would be sorted again for each of its elements.
    fresh = lambda every: F.filter(every, lambda s, n: ~F.coalesce(s["key"] == F.get(every, n - 1)["key"], F.lit(False)))
    back = lambda every: F.array_sort(F.transform(fresh(every), lambda s: F.named_struct(F.lit("i"), s["i"], F.lit("line"), s["line"])))
    kept = F.flatten(F.transform(F.array(F.array_sort(keyed)), back))
    return F.array_join(F.transform(kept, lambda s: s["line"]), "\n")


def edit_problem(content: Column, current: Column) -> Column:
    """Why an edit is refused: too_short, leakage, duplicate or not_actionable; null if it is fine."""
    own = bullets(content)
    known = (F.size(own) > 0) & F.forall(own, lambda b: F.array_contains(bullets(current), b)) | current.contains(content)
    actionable = F.lower(content).rlike(r"\b(must|should|use|check|add|never|always|if|when|do not|avoid|include|write|return|verify)\b|[必须应当]")
    return F.when(F.length(T.strip(content)) < 20, "too_short").when(_any(content, LEAKS), "leakage").when(known, "duplicate").when(~actionable, "not_actionable")


def apply_edit(text: Column, op: Column, target: Column, content: Column) -> Column:
    """One edit: append, insert_after (append where the target is missing), replace or delete the first target."""
    at = F.position(target, text)
    head, tail = F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(target), F.length(text))
    end = F.concat(F.regexp_replace(text, r"\n+$", ""), F.lit("\n"), content)
    found = (F.coalesce(target, F.lit("")) != "") & (at > 0)
    return (
        F.when(op == "append", end).when(op == "insert_after", F.when(found, F.concat(head, target, F.lit("\n"), content, tail)).otherwise(end))
        .when((op == "replace") & found, F.concat(head, content, tail)).when((op == "delete") & found, F.concat(head, tail)).otherwise(text)
    )


def replace_region(text: Column, content: Column, begin: str = "<!-- slow_update:begin -->", end: str = "<!-- slow_update:end -->") -> Column:
    """The region between the markers replaced, or put at the end."""
    block = F.concat(F.lit(begin + "\n"), content, F.lit("\n" + end))
    at, to = F.position(F.lit(begin), text), F.position(F.lit(end), text)
    inside = F.concat(F.substring(text, F.lit(1), at - 1), block, F.substring(text, to + len(end), F.length(text)))
    return F.when((at > 0) & (to > at), inside).otherwise(F.concat(text, F.lit("\n"), block))


def dedupe_edits(edits: DataFrame, order: str = "edit_id") -> DataFrame:
    """Edits of equal operation and beginning become the first of them; their items join."""
    keyed = edits.withColumn("_key", T.edit_fingerprint(F.col("op"), F.col("content")))
    head = keyed.groupBy("_key").agg(*[F.min_by(c, order).alias(c) for c in (order, "op", "content")], F.count("*").alias("merged"))
    items = keyed.select("_key", F.explode_outer("items").alias("i")).where("i is not null").distinct().groupBy("_key").agg(F.array_sort(F.collect_list("i")).alias("items"))
    return head.join(items, "_key", "left").drop("_key")


def rank_edits(edits: DataFrame, missed: DataFrame, budget: int) -> DataFrame:
    """Edits by the share of distinct missed checks that their content names, 0.15 more if they have a target; budget at most.

    missed has (check).
    """
    total = missed.select("check").distinct()
    n = total.count()
    met = contained(edits.select("edit_id", T.text_key(F.col("content")).alias("_c")), "_c", total.select("check", F.lower("check").alias("_low")), "_low")
    hits = met.groupBy("edit_id").agg(F.count("*").alias("hits"))
    share = F.coalesce("hits", F.lit(0)) / n if n else F.lit(0.5)
    bonus = F.when(F.coalesce(F.col("target"), F.lit("")) != "", 0.15).otherwise(0.0)
    return edits.join(hits, "edit_id", "left").withColumn("coverage", F.bround(share + bonus, 4)).drop("hits").orderBy(F.desc("coverage"), "edit_id").limit(budget)


def flag_redundant(edits: DataFrame, rejected: DataFrame) -> DataFrame:
    """edits with redundant: whether one of the rejected has its fingerprint. They are told, not dropped."""
    key = T.edit_fingerprint(F.col("op"), F.col("content"))
    known = rejected.select(key.alias("_key")).distinct().withColumn("_known", F.lit(True))
    return edits.withColumn("_key", key).join(known, "_key", "left").withColumn("redundant", F.coalesce("_known", F.lit(False))).drop("_key", "_known")


def apply_edits(text: Column, edits: Column) -> Column:
    """struct(text, applied, missed): an ordered array of struct(op, target, content) applied one after the other; edits whose target is absent count as missed."""
    start = F.named_struct(F.lit("text"), text, F.lit("applied"), F.lit(0), F.lit("missed"), F.lit(0))

    def step(s, e):
        new = apply_edit(s["text"], e["op"], e["target"], e["content"])
        lost = ~(e["op"] == "append") & (~s["text"].contains(F.coalesce(e["target"], F.lit(""))) | (F.coalesce(e["target"], F.lit("")) == ""))
        return F.named_struct(F.lit("text"), new, F.lit("applied"), s["applied"] + (~lost).cast("int"), F.lit("missed"), s["missed"] + lost.cast("int"))

    return F.aggregate(edits, start, step)


def headings(text: Column, most: int = 20) -> Column:
    """The first headings with their marks."""
    return F.slice(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^#{1,6} ")), 1, most)


def insert_target(text: Column, keyword: Column) -> Column:
    """The first heading that names the keyword, else the last one, else null."""
    every = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^#{1,6} "))
    return F.coalesce(F.get(F.filter(every, lambda h: F.lower(h).contains(F.lower(keyword))), F.lit(0)), F.try_element_at(every, F.lit(-1)))


def without_fences(text: Column) -> Column:
    """Lines outside code fences; the fences go too."""
    lines = F.split(text, "\n")
    marked = F.transform(lines, lambda x, i: F.named_struct(F.lit("x"), x, F.lit("n"), F.size(F.filter(F.slice(lines, F.lit(1), i + 1), lambda y: y.startswith("```")))))
    return F.array_join(F.transform(F.filter(marked, lambda m: (m["n"] % 2 == 0) & ~m["x"].startswith("```")), lambda m: m["x"]), "\n")


def merge_traces(a: Column, b: Column) -> Column:
    """Both lists as one sorted set."""
    return F.array_sort(F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))))
