"""Knowledge records (atoms): extraction, tiered scores, merging, alignment, seeds and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import overlaps as O
from .graph import cut, drop, numbered

REFS = "array<struct<type:string,id:string,authority:string>>"
#: Roles of code that hold business rules, and of code that only wires it.
BUSINESS_ROLES = ("processor", "service", "domain", "dto", "enum", "helper", "util", "validator", "mapper", "event", "listener", "hook")
GLUE_ROLES = ("handler_only", "swagger", "configuration", "starter", "controller", "resource_api", "api_resource", "rest_controller", "repository", "config")
#: Role by the ending of a file's stem, in order, then by a folder's name.
ROLE_ENDINGS = (
    (r"Processor(?:Impl)?$", "processor"), (r"Service(?:Impl)?$", "service"), (r"Handler$", "handler_only"), (r"ApiResource(?:Swagger)?$", "swagger"), (r"Config(?:uration)?$", "configuration"),
    (r"DTO$", "dto"), (r"Enum$", "enum"), (r"Constants?$", "enum"), (r"Domain(?:Service)?$", "domain"), (r"Validator$", "validator"), (r"Mapper$", "mapper"), (r"Starter$", "starter"),
)
ROLE_FOLDERS = (("processor", "processor"), ("service", "service"), ("domain", "domain"), ("dto", "dto"), ("handler", "handler_only"), ("controller", "handler_only"), ("config", "configuration"), ("configuration", "configuration"), ("resource", "resource_api"))


def role_of(ref: Column) -> Column:
    """Role of path#symbol by the stem of its file, then by the first telling folder."""
    path = F.regexp_extract(ref, r"^([^#]*)", 1)
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    out = F.when(F.coalesce(ref, F.lit("")) == "", "unknown")
    for pattern, role in ROLE_ENDINGS:
        out = out.when(stem.rlike("(?i)" + pattern), role)
    folders = F.create_map(*[F.lit(x) for pair in ROLE_FOLDERS for x in pair])
    telling = F.filter(F.transform(F.split(F.lower(path), "/"), lambda p: F.try_element_at(folders, p)), lambda r: r.isNotNull())
    return out.otherwise(F.coalesce(F.get(telling, F.lit(0)), F.lit("unknown")))


def atoms_from_chunks(chunks: DataFrame) -> DataFrame:
    """One procedure and one constraint atom at most of each (chunk_id, text, content_type)."""
    text, kind = F.col("text"), F.col("content_type")
    found = F.filter(
        F.array(F.when((kind == "procedure") | T.has_steps(text), F.lit("procedure")), F.when((kind == "constraint") | T.has_constraint(text), F.lit("constraint"))), lambda k: k.isNotNull()
    )
    out = chunks.select("chunk_id", F.explode(found).alias("kind"), F.substring(T.collapse(text), 1, 200).alias("claim"))
    refs = F.array(F.struct(F.lit("doc").alias("type"), F.col("chunk_id").alias("id"), F.lit("").alias("authority"))).cast(REFS)
    return out.select(F.concat_ws(".", F.lit("doc"), "chunk_id", "kind").alias("atom_id"), "kind", "claim", refs.alias("source_refs"), F.lit(0.55).alias("confidence"))


def atoms_from_code(snippets: DataFrame) -> DataFrame:
    """Up to three atoms (retry, transaction, job) of each (ref, text)."""
    text = F.col("text")
    found = F.filter(F.array(F.when(T.has_retry(text), F.lit("retry_rule")), F.when(T.has_transaction(text), F.lit("transaction_rule")), F.when(T.has_job(text), F.lit("job_rule"))), lambda k: k.isNotNull())
    refs = F.array(F.struct(F.lit("code").alias("type"), F.col("ref").alias("id"), F.lit("").alias("authority"))).cast(REFS)
    out = snippets.select("ref", F.explode(found).alias("kind"), refs.alias("source_refs"))
    return out.select(F.concat_ws(".", F.lit("code"), "ref", "kind").alias("atom_id"), "kind", F.concat_ws(" ", F.lit("code at"), "ref", F.lit("holds a"), "kind").alias("claim"), "source_refs", F.lit(0.7).alias("confidence"))


def status_of(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "accepted").when(confidence >= 0.6, "candidate").when(confidence >= 0.4, "needs_review").otherwise("rejected")


def role_adjustment(refs: Column) -> Column:
    """-0.30 if all code references are glue, -0.15 from 60 % on, +0.05 for business code without glue."""
    roles = F.transform(F.filter(refs, lambda r: r["type"] == "code"), lambda r: role_of(r["id"]))
    n, glue = F.size(roles), F.size(F.filter(roles, lambda r: r.isin(*GLUE_ROLES)))
    business = F.size(F.filter(roles, lambda r: r.isin(*BUSINESS_ROLES)))
    return F.when((n > 0) & (glue == n), -0.30).when((n > 0) & (glue >= 0.6 * n), -0.15).when((business > 0) & (glue == 0), 0.05).otherwise(0.0)


def score_atoms(atoms: DataFrame, adjustment: float = 0.05) -> DataFrame:
    """Tiered confidence: base by what the references are, more for checks, negatives and actions, then the role filter."""
    has = lambda p: F.exists("source_refs", p)
    code, doc, official = has(lambda r: r["type"] == "code"), has(lambda r: r["type"] == "doc"), has(lambda r: r["authority"] == "official")
    base = F.when(code & doc, 0.85).when(code, 0.75).when(official, 0.65).when(doc, 0.55).otherwise(0.45)
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != "" if c in atoms.columns else F.lit(False)
    more = F.when(F.size("checks") > 0, adjustment).otherwise(0.0) if "checks" in atoms.columns else F.lit(0.0)
    more = more + F.when(some("negative_rule"), 0.6 * adjustment).otherwise(0.0) + F.when(some("action"), 0.4 * adjustment).otherwise(0.0)
    unfit = (F.size("source_refs") == 0) | (F.coalesce(F.col("claim"), F.lit("")) == "")
    score = F.when(unfit, 0.3).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.95), base + more + role_adjustment(F.col("source_refs")))))
    return atoms.withColumn("confidence", F.bround(score, 3)).withColumn("status", F.when(unfit, "rejected").otherwise(status_of(F.col("confidence"))))


def refresh_statuses(atoms: DataFrame, downrank: bool = True) -> DataFrame:
    """Statuses anew after merges: what references say of their roles moves the confidence once more (at most 0.95); one that moved has two digits."""
    moved = F.greatest(F.lit(0.0), F.least(F.lit(0.95), F.col("confidence") + role_adjustment(F.col("source_refs")))) if downrank else F.col("confidence")
    named = atoms.withColumn("_c", moved).withColumn("_s", status_of(F.col("_c")))
    same = (F.col("_c") == F.col("confidence")) & F.col("_s").eqNullSafe(F.col("status"))
    return named.withColumn("confidence", F.when(same, F.col("confidence")).otherwise(F.bround("_c", 2))).withColumn("status", F.col("_s")).drop("_c", "_s")


def rank_ref(r: Column) -> Column:
    return F.when((r["type"] == "code") & r["id"].contains("/"), 0).when(r["type"] == "code", 1).when(r["authority"] == "official", 2).when(r["type"] == "doc", 3).otherwise(4)


def cap_refs(refs: Column, most: int = 24) -> Column:
    """Distinct references, best rank and longest id first, most at most, a quarter kept for others than code."""
    keyed = F.array_sort(F.transform(F.array_distinct(refs), lambda r: F.named_struct(F.lit("rank"), rank_ref(r), F.lit("n"), -F.length(r["id"]), F.lit("r"), r)))
    ordered = F.transform(keyed, lambda k: k["r"])
    code, other = F.filter(ordered, lambda r: r["type"] == "code"), F.filter(ordered, lambda r: r["type"] != "code")
    kept_other = F.least(F.size(other), F.greatest(F.lit(most // 4), most - F.size(code)))
    return F.slice(F.concat(F.slice(code, F.lit(1), most - kept_other), F.slice(other, F.lit(1), kept_other)), 1, most)


def merge_by_prefix(atoms: DataFrame, order: str = "atom_id", prefix: int = 80) -> DataFrame:
    """Atoms whose claims begin alike become one: the first is the base, references join, the largest confidence stays.

    Scalars are aggregated before the shuffle; of references only distinct ones meet.
    """
    keyed = atoms.withColumn("_key", F.substring("claim", 1, prefix))
    head = keyed.groupBy("_key").agg(*[F.min_by(c, order).alias(c) for c in ("atom_id", "kind", "claim")], F.max("confidence").alias("confidence"), F.count("*").alias("merged"))
    refs = keyed.select("_key", F.explode("source_refs").alias("r")).distinct().groupBy("_key").agg(F.array_sort(F.collect_list("r")).alias("source_refs"))
    return head.join(refs, "_key", "left").withColumn("source_refs", F.coalesce("source_refs", F.array().cast(REFS))).drop("_key")


def token_classes(items: DataFrame, key: str, group: str, tokens: str) -> DataFrame:
    """(a, g, ts, copies): items of a group with equal sets of tokens as one, by the smallest key."""
    one = items.select(F.col(key).alias("k"), F.col(group).alias("g"), F.array_sort(F.array_distinct(tokens)).alias("ts"))
    return one.groupBy("g", "ts").agg(F.min("k").alias("a"), F.count("*").alias("copies"))


#: Sets of a group that meet in one task at most, and atoms that are aligned first.
SETS_PER_TASK, ALIGNED_FIRST = O.SETS_PER_TASK, 8_192


def overlap_pairs(items: DataFrame, key: str, group: str, tokens: str, least: int = 2) -> DataFrame:
    """(a, b, shared, a_copies, b_copies): pairs of a group's different token sets that share least tokens or more, a < b.

    Exact, and no token is left out: all sets of a group meet, block by block, and tokens are counted inside the
    task, so that what travels is each set once for each block and the pairs that are asked for.
    """
    return O.sharing_pairs(cut(token_classes(items, key, group, tokens).where(F.size("ts") >= least)), least, SETS_PER_TASK)


def item_pairs(items: DataFrame, key: str, group: str, tokens: str, least: int = 2) -> DataFrame:
    """(a, b, shared): all pairs of a group's items that share least tokens or more, a < b; exact, and items with equal tokens are pairs too."""
    each = cut(items.select(F.col(key).alias("k"), F.col(group).alias("g"), F.array_sort(F.array_distinct(tokens)).alias("ts")))  # tokens that a filter asks for as well are found once
    return O.item_pairs(each.where((F.size("ts") >= least) & F.col("k").isNotNull() & F.col("g").isNotNull()), least, SETS_PER_TASK)


def align_greedy(atoms: DataFrame, key: str, group: str, tokens: str, least: int = 2) -> DataFrame:
    """(key, leader): in order of key, each atom joins the first leader of its group with least tokens in common, else leads.

    In order of key the atoms go by in stretches, each three times as long as all before it. Those of a stretch meet the
    leaders so far, and only who finds none of them is compared within the stretch. Atoms with equal tokens go with
    the first of them.
    """
    each = atoms.select(F.col(key).alias("key"), F.col(group).alias("g"), F.array_sort(F.array_distinct(tokens)).alias("ts")).where("g is not null")
    alone = F.coalesce(F.size("ts"), F.lit(0)) < least  # too few tokens to join anyone, equal ones too
    classes = cut(numbered(token_classes(atoms, key, group, tokens).where((F.size("ts") >= least) & F.col("g").isNotNull()), "a"))
    total, begin, end = classes.count(), 0, ALIGNED_FIRST
    decided, leaders = classes.select("n", F.col("n").alias("leader")).where("false"), None
    while begin < total:
        rest = classes.where((F.col("n") >= begin) & (F.col("n") < end)).select("g", "n", "ts")
        if leaders is not None:
            follows = cut(O.first_sharing(rest, leaders, least, SETS_PER_TASK))
            decided = decided.unionByName(follows)
            rest = cut(rest.join(follows, "n", "left_anti"))
        led = led_within(rest, least)
        decided = decided.unionByName(led)
        new = cut(rest.join(led.where("leader = n"), "n", "left_semi").select("g", "n", "ts"))
        leaders = new if leaders is None else leaders.unionByName(new)
        begin, end = end, 4 * end
    names = classes.select(F.col("n").alias("leader"), F.col("a").alias("leads"))
    of = classes.select("g", "ts", "n").join(decided, "n").join(names, "leader").select("g", "ts", F.col("leads").alias("leader"))
    return each.where(~alone).join(of, ["g", "ts"]).select("key", "leader").unionByName(each.where(alone).select("key", F.col("key").alias("leader")))


def led_within(sets: DataFrame, least: int) -> DataFrame:
    """(n, leader) of sets (g, n, ts) among themselves, in order of n.

    Decided in rounds over the pairs that share enough: a set none of whose smaller neighbours may still
    lead leads itself, and who has a leader among them, with nobody smaller undecided, follows the smallest.
    """
    pairs = cut(O.sharing_pairs(sets.select(F.col("n").alias("a"), "g", "ts", F.lit(1).cast("bigint").alias("copies")), least, SETS_PER_TASK).select("a", "b"))
    state = cut(sets.select(F.col("n").alias("k"), F.lit(None).cast("bigint").alias("leader")))
    while True:
        known = state.select(F.col("k").alias("a"), F.col("leader").alias("a_leader"))
        leads, opened = F.col("a_leader") == F.col("a"), F.col("a_leader").isNull()
        before = pairs.join(known, "a").groupBy(F.col("b").alias("k")).agg(F.min(F.when(leads, F.col("a"))).alias("first"), F.min(F.when(opened, F.col("a"))).alias("waits"))
        settled = F.when(F.col("waits").isNull() | (F.col("first") < F.col("waits")), F.coalesce("first", "k"))
        last, state = state, cut(state.join(before, "k", "left").select("k", F.coalesce("leader", settled).alias("leader")))
        drop(last)
        undecided = state.where("leader is null").select(F.col("k").alias("b"))
        if undecided.isEmpty():
            break
        # Only pairs of an undecided set and one that leads or may still lead say anything further on.
        may_lead = state.where("leader is null or leader = k").select(F.col("k").alias("a"))
        last, pairs = pairs, cut(pairs.join(undecided, "b", "left_semi").join(may_lead, "a", "left_semi"))
        drop(last)
    drop(pairs)
    return state.withColumnRenamed("k", "n")


def merged_confidence(best: Column, members: Column, mixed: Column) -> Column:
    """Of a group of aligned atoms: more for members and for code beside documents, 1 at most."""
    return F.bround(F.least(F.lit(1.0), best + F.least(F.lit(0.15), (members - 1) * 0.05) + F.when(mixed, 0.1).otherwise(0.0)), 3)


def seeds(atoms: DataFrame, least: float = 0.6) -> DataFrame:
    """Benchmark seeds of confident atoms: their claim's five telling tokens and four references."""
    refs = F.slice(F.transform(F.filter("source_refs", lambda r: r["type"] == "code"), lambda r: r["id"]), 1, 4)
    out = atoms.where(F.col("confidence") >= least).select("atom_id", F.col("claim").alias("question"), T.seed_tokens(F.col("claim")).alias("expected_checks"), refs.alias("context_refs"))
    return out.withColumn("risk", F.when(F.size("context_refs") == 0, "needs_review").otherwise("low"))


def evidence_index(atoms: DataFrame) -> DataFrame:
    """(ref, atom_id, contribution) per code reference, keyed by the whole reference and each part of it."""
    one = atoms.select("atom_id", "confidence", F.explode("source_refs").alias("r")).where("r.type = 'code'")
    parts = F.array_distinct(F.concat(F.array(F.col("r.id")), F.split("r.id", "[#→]")))
    return one.select(F.explode(parts).alias("ref"), "atom_id", F.bround(F.least(F.lit(0.2), 0.15 * F.col("confidence")), 4).alias("contribution")).distinct()


def artifact_quality(atoms: DataFrame, seed_rows: DataFrame, least_accepted: float = 0.3, most_generic: float = 0.5) -> DataFrame:
    """One row: counts and rates of atoms and seeds, the names of failed rules, and whether all passed."""
    a = atoms.agg(F.count("*").alias("atoms"), F.coalesce(F.avg((F.col("status") == "accepted").cast("double")), F.lit(0.0)).alias("accepted_rate"), F.max(F.size("source_refs")).alias("most_refs"))
    generic = F.forall("expected_checks", lambda c: (F.length(c) < 3) | c.isin("check", "rule", "data", "value", "result", "process"))
    s = seed_rows.agg(F.count("*").alias("seeds"), F.coalesce(F.avg(generic.cast("double")), F.lit(0.0)).alias("generic_rate"))
    rules = F.filter(F.array(F.when(F.col("accepted_rate") < least_accepted, "accepted_rate"), F.when(F.col("generic_rate") > most_generic, "generic_rate"), F.when(F.col("seeds") == 0, "no_seeds")), lambda x: x.isNotNull())
    one = a.withColumn("_j", F.lit(1)).join(s.withColumn("_j", F.lit(1)), "_j").drop("_j")  # one row each
    return one.select("*", rules.alias("failures"), (F.size(rules) == 0).alias("passed"))


def role_index(nodes: DataFrame, group: list[str], symbol: str, most: int = 20) -> DataFrame:
    """The first most distinct symbols of each group, sorted, and their number."""
    one = nodes.select(*group, F.col(symbol).alias("s")).distinct()
    n = F.row_number().over(Window.partitionBy(*group).orderBy("s"))
    counts = one.groupBy(*group).agg(F.count("*").alias("symbols"))
    first = one.withColumn("n", n).where(F.col("n") <= most).groupBy(*group).agg(F.array_sort(F.collect_list("s")).alias("first_symbols"))
    return counts.join(first, group)
