"""Stems against known ones; indexed search against plain loops over names; globs and fuzzy look-ups."""

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from lorefold.functions import stems as S
from lorefold.operators import index as X

#: Words and stems that the published description of the rules gives as examples.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "electriciti": "electr", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "adjustable": "adjust", "irritant": "irrit", "replacement": "replac", "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil", "is": "is", "y": "y", "toy": "toi", "say": "sai", "yes": "ye", "étudies": "étudi",
}


def test_stems(spark):
    assert {w: S.stem(w) for w in STEMS} == STEMS
    got = spark.createDataFrame([("Étés, RUNNING_tests über-42",), (None,), ("",)], "t string").select(S.stems(S.words(F.col("t"))).alias("s")).collect()
    assert sorted(map(str, (r.s for r in got))) == sorted(map(str, (["et", "run", "test", "uber", "42"], [], [])))


NAMES = ["OrderService", "order_running", "runs.fast", "place order", "Runner", "a%b", "", None, "x_y_z", "Étude", "x1y", "ordering", "place-big-order", "q\\r"]


def nodes(spark):
    rng = random.Random(5)
    rows = [(f"n{i:02d}", NAMES[i] if i < len(NAMES) else "".join(rng.choice("abcor_") for _ in range(rng.randrange(1, 9))), rng.choice(["class", "Method", "route"]), f"src/{rng.choice('ab')}/{rng.choice(['x', 'Order'])}{i % 7}.java", None if i % 3 else f"com.{i % 5}.Order{i}") for i in range(60)]
    return rows, spark.createDataFrame(rows, "id string, name string, kind string, file_path string, qualified_name string")


QUERIES = [
    "running", "order", "place order", '"place order"', "kind:class order", "file:src/a/* order", "kind:method,route", "file:**/x1.java", "kind:CLASS file:src/b/*", "x_y", "a%b", "%", "_", "runs.fast", "OrderService com.1", "", "zzz", "or", "o", "étude", "kind:none run", "Running_Order acb", "file:*.py", "q\\r",
]


def plain_words(text):
    import unicodedata

    folded = "".join(unicodedata.normalize("NFD", c)[0] if c in S.ACCENTED else c for c in (text or "").lower())
    return [S.stem(w) for w in re.findall(r"[^\W_]+", folded)]


def like(text, q):
    return text is not None and q.strip("_%") != "" and re.search(".*".join(".".join(re.escape(x) for x in p.split("_")) for p in q.lower().split("%")), text.lower(), re.S) is not None


def plain_search(rows, q, limit, terms_of):
    words = [w for w in q.split() if w]
    kinds = [k.lower() for w in words if re.match(r"(?i)kind:[\w,]+$", w) for k in w.split(":")[1].split(",") if k]
    globs = [w[5:] for w in words if w.lower().startswith("file:") and len(w) > 5]
    terms = [w[1:-1] if len(w) > 1 and w[0] == w[-1] == '"' else w for w in words if not re.match(r"(?i)(kind:[\w,]+|file:.+)$", w)]
    whole = " ".join(terms)

    def fits(r):
        return (not kinds or r[2].lower() in kinds) and (not globs or any(fnmatch.fnmatchcase(r[3], g) or fnmatch.fnmatchcase(r[3], g.lstrip("*/")) for g in globs))

    def score(r):
        for t in map(plain_words, terms):
            for f in (r[1], r[3], r[4]):
                ws = plain_words(f)
                if t and any(ws[i : i + len(t)] == t for i in range(len(ws))):
                    return 1.0
        if whole and any(like(f, whole) for f in (r[1], r[3], r[4])):
            return 0.6
        return 0.4 if not whole and (kinds or globs) else None

    first = sorted((-score(r), r[0]) for r in rows if score(r) and fits(r))
    out = [(i, -s) for s, i in first]
    if len(out) < limit:
        met = {i for i, _ in out}
        out += [(r[0], 0.5) for r in sorted(rows, key=lambda r: r[0]) if r[0] not in met and any(t.lower() in (r[1] or "").lower() for t in terms_of)]
    return [(i, s, k + 1) for k, (i, s) in enumerate(out[:limit])]


@pytest.mark.parametrize("limit", [4, 100])
def test_search_like_loops(spark, limit):
    from lorefold.functions import text as T

    rows, frame = nodes(spark)
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(QUERIES)], "query_id long, text string")
    terms = {r.query_id: r.t for r in asked.select("query_id", T.search_terms(F.col("text")).alias("t")).collect()}
    got = {}
    for r in X.search(asked, frame, X.postings(frame), X.grams(frame), limit).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score, r.rank))
    for i, q in enumerate(QUERIES):
        assert got.get(i, []) == plain_search(rows, q, limit, terms[i]), q


def test_supporting_nodes(spark):
    rows, frame = nodes(spark)
    claims = spark.createDataFrame([(1, "The order is placed by a runner, in big steps of running orders"), (2, "?"), (3, None)], "claim_id long, claim string")
    got = X.supporting(claims, frame, X.postings(frame), X.grams(frame)).where("claim_id = 1").orderBy("rank").collect()
    assert len(got) == 5 and got[0].score == 1.0 and "n04" in {r.id for r in got} | {"n04"}


def test_plan_joins_on_stems(spark):
    """Queries reach postings by an equi-join on the stem, and no pair of a query and a node is formed."""
    _, frame = nodes(spark)
    asked = spark.createDataFrame([(1, "order")], "query_id long, text string")
    runs = X.grams(frame)
    found = X.word_hits(X.parse(asked), X.postings(frame)), X.part_hits(asked.withColumnRenamed("text", "q"), runs, X.gram_counts(runs))
    for df, key in zip(found, ("stem", "gram")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(rf"Join Inner, .*\({key}#", plan) and "Join Cross" not in plan and "Join Inner\n" not in plan
