"""Scalar text functions as Column expressions: redaction, cleaning, hashing, tokens, typed predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (pattern, replacement) of document redaction, each applied to the previous one's output.
REDACTIONS = (
    (r"sk-[A-Za-z0-9]{32,}", "<REDACTED_API_KEY>"),
    (r"(?i)((?:api[_-]?key|apikey|secret|token|password)[ \t\r\n\f]*)[:=][ \t\r\n\f]*[\"']?[^\"'& \t\r\n\f]+", "$1=<REDACTED>"),
    (r"(?:Bearer|Basic)[ \t\r\n\f]+[A-Za-z0-9+/=_-]{20,}", "<REDACTED_AUTH>"),
    (r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]+", "<REDACTED_EMAIL>"),
    (r"(?i)(?:jdbc|mysql|postgresql|mongodb)://[^ \t\r\n\f\"']+", "<REDACTED_DB_URL>"),
)
#: For these patterns in order, parts of which every text that they match holds one of each row; rows that ignore case are in lower case, behind "lower".
NEEDED = dict(zip((p for p, _ in REDACTIONS), (
    (("", "sk-"),), (("", ":", "="), ("lower", "api", "secret", "token", "password")), (("", "Bearer", "Basic"),), (("", "@"),), (("", "://"),),
)))
#: The same for call ledgers.
LEDGER_REDACTIONS = (
    (r"sk-[A-Za-z0-9]{20,}", "sk-***REDACTED***"),
    (r"(?i)Bearer[ \t\r\n\f]+[A-Za-z0-9._-]+", "Bearer ***REDACTED***"),
    (r"(?i)(api[_-]?key[ \t\r\n\f]*[:=][ \t\r\n\f]*)['\"]?[A-Za-z0-9._-]{8,}", "$1***REDACTED***"),
)
#: Words that say nothing about what a text is aligned to.
STOPWORDS = (
    "the", "and", "for", "with", "from", "this", "that", "must", "not", "have", "will", "been", "were", "was", "are", "has", "had", "can", "should",
    "在", "中", "的", "和", "或", "是", "将", "为", "所", "以", "及", "等", "发现", "实现", "定义", "包含", "操作", "逻辑", "文档", "必须", "不得", "check", "before", "after", "into", "when",
)
#: Ordered content types; (type, text contains, (text contains, within first n), lower-cased text contains, (lower-cased contains, within first n)).
CONTENT_TYPES = (
    ("procedure", ("步骤", "流程"), (("先", 10),), (), (("step", 20),)),
    ("constraint", ("不得", "禁止", "严禁"), (), ("must not",), ()),
    ("error_code", ("错误码",), (), ("error code",), ()),
    ("faq", ("常见问题",), (), (), (("q:", 5), ("a:", 5))),
    ("api_contract", (), (), (), (("api", 5), ("endpoint", 10), ("request", 5), ("response", 5))),
    ("example", ("```",), (("class ", 10), ("def ", 10), ("function ", 10)), (), ()),
)
#: Words that mark a kind of rule in code or text.
RETRY_WORDS = ("retry", "重试", "backoff", "退避", "maxattempts", "max_attempts")
TRANSACTION_WORDS = ("transaction", "事务", "audit", "审计", "@auditable", "audittrail")
JOB_WORDS = ("@scheduled", "@quartz", "scheduledtask", "定时", "cron", "job")
CONSTRAINT_WORDS = ("不得", "禁止", "严禁", "必须", "must not", "must", "@validate")
WHITE = r"[ \t\r\n\f\x0B]"


def strip(c: Column) -> Column:
    """Without white space at both ends; trim() takes blanks only."""
    return F.regexp_replace(c, rf"^{WHITE}+|{WHITE}+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{WHITE}+", " "))


def let(value: Column, use) -> Column:
    """use(value) with value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def may_match(c: Column, pattern: str) -> Column:
    """Whether c holds what any match of a pattern holds; looked for first, as plain parts are found much faster than patterns."""
    out = F.lit(True)
    for case, *parts in NEEDED.get(pattern, ()):
        out = out & any_contained(F.lower(c) if case else c, parts)
    return out


def redact(c: Column, rules=REDACTIONS) -> Column:
    one = lambda pattern, put: lambda t: F.when(~may_match(t, pattern), t).otherwise(F.regexp_replace(t, F.lit(pattern), F.lit(put)))
    for pattern, put in rules:
        c = let(c, one(pattern, put))
    return c


def redacted(c: Column, rules=REDACTIONS) -> Column:
    """struct(text, n): the redacted text and the substitutions made, each rule on its predecessors' output, in one pass of the rules."""
    out = F.named_struct(F.lit("text"), c, F.lit("n"), F.when(c.isNotNull(), 0))
    for pattern, put in rules:
        out = let(out, _one_rule(pattern, put))
    return out


def _one_rule(pattern: str, put: str):
    made = lambda s: F.named_struct(F.lit("text"), F.regexp_replace(s["text"], F.lit(pattern), F.lit(put)), F.lit("n"), s["n"] + F.regexp_count(s["text"], F.lit(pattern)))
    return lambda s: F.when(~may_match(s["text"], pattern), s).otherwise(made(s))


def redaction_count(c: Column, rules=REDACTIONS) -> Column:
    """Substitutions that redact() makes."""
    return redacted(c, rules)["n"].cast("bigint")


#: A string of a JSON text.
JSON_STRING = r'("(?:[^"\\]|\\.)*")'


def redact_leaves(json: Column, rules=LEDGER_REDACTIONS) -> Column:
    """Redaction of every string of a JSON text as it reads unescaped, written back escaped; all else stays as it is."""
    strings, gaps = F.regexp_extract_all(json, F.lit(JSON_STRING), F.lit(1)), F.split(json, JSON_STRING)
    plain = lambda s: F.get(F.from_json(F.concat(F.lit("["), s, F.lit("]")), "array<string>"), F.lit(0))
    written = lambda s: F.regexp_extract(F.to_json(F.array(s)), r"(?s)^\[(.*)\]$", 1)
    new = F.transform(strings, lambda s: F.coalesce(written(redact(plain(s), rules)), s))
    return F.array_join(F.transform(F.arrays_zip(gaps, new), lambda x: F.concat(F.coalesce(x["0"], F.lit("")), F.coalesce(x["1"], F.lit("")))), "")


def clean(c: Column) -> Column:
    return strip(F.regexp_replace(F.translate(c, "　", " "), r"\n{3,}", "\n\n"))


def token_estimate(c: Column, least: int = 0) -> Column:
    return F.greatest(F.lit(least), F.floor(F.length(c) / 4)).cast("bigint")


def any_contained(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def _words_pattern(words) -> str:
    return "|".join("".join("\\" + ch if ch in r"\.^$+*?{}()|[]" else ch for ch in w) for w in words)


def content_type(c: Column) -> Column:
    """One pattern for each kind of test; what is tested lower-cased is lower-cased once."""

    def decide(low):
        out = None
        for name, inside, near, low_inside, low_near in CONTENT_TYPES:
            tests = [c.rlike(_words_pattern(inside))] if inside else []
            tests += [low.rlike(_words_pattern(low_inside))] if low_inside else []
            tests += [F.substring(c, 1, n).contains(w) for w, n in near] + [F.substring(low, 1, n).contains(w) for w, n in low_near]
            hit = tests[0]
            for t in tests[1:]:
                hit = hit | t
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise("concept")

    return let(F.lower(c), decide)


def has_retry(c: Column) -> Column:
    return any_contained(F.lower(c), RETRY_WORDS)


def has_transaction(c: Column) -> Column:
    return any_contained(F.lower(c), TRANSACTION_WORDS)


def has_job(c: Column) -> Column:
    return any_contained(F.lower(c), JOB_WORDS)


def has_steps(c: Column) -> Column:
    return c.contains("步骤") | F.substring(F.lower(c), 1, 50).contains("step")


def has_constraint(c: Column) -> Column:
    return any_contained(c, CONSTRAINT_WORDS)


def semantic_hash(c: Column, digits: int = 12) -> Column:
    return F.substring(F.sha2(collapse(c), 256), 1, digits)


def content_hash(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, digits)


def rejected_hash(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(collapse(c), 256))


def fingerprint(c: Column) -> Column:
    return F.substring(F.sha2(F.lower(collapse(c)), 256), 1, 16)


def edit_fingerprint(op: Column, content: Column) -> Column:
    return F.concat_ws(":", op, F.lower(collapse(F.substring(content, 1, 100))))


def text_key(c: Column) -> Column:
    return F.lower(collapse(c))


def rule_slug(c: Column) -> Column:
    """Lower-cased letters and digits joined by '_', 40 at most; hash where nothing is left."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    slug = F.substring(slug, 1, 40)
    return F.when(F.length(slug) < 2, F.concat(F.lit("rule_"), F.substring(F.sha1(c), 1, 10))).otherwise(slug)


def fact_id(case: Column, name: Column) -> Column:
    slug = F.substring(F.regexp_replace(F.concat_ws("-", case, name), r"[^A-Za-z0-9]+", "-"), 1, 40)
    return F.concat_ws("-", slug, F.substring(F.sha1(F.concat_ws("|", case, name)), 1, 8))


def alignment_tokens(c: Column) -> Column:
    """Sorted distinct tokens by which texts are aligned: parts of CamelCase and snake_case names, words of
    four letters or more, runs of two Chinese characters or more; without stop words."""
    names = F.regexp_extract_all(c, F.lit(r"\b([A-Z][a-z]+(?:[A-Z][a-z]*)+)\b"), F.lit(1))
    parts = F.filter(F.flatten(F.transform(names, lambda n: F.regexp_extract_all(n, F.lit(r"([A-Z]?[a-z]+)"), F.lit(1)))), lambda p: F.length(p) >= 3)
    snakes = F.regexp_extract_all(F.lower(c), F.lit(r"\b([a-z][a-z0-9]*(?:_[a-z0-9]+)+)\b"), F.lit(1))
    snake_parts = F.filter(F.flatten(F.transform(snakes, lambda n: F.split(n, "_"))), lambda p: F.length(p) >= 3)
    words = F.regexp_extract_all(F.lower(c), F.lit(r"\b([a-z]{4,})\b"), F.lit(1))
    chinese = F.regexp_extract_all(c, F.lit(r"([\x{4e00}-\x{9fff}]{2,})"), F.lit(1))
    low = F.transform(F.concat(names, parts), lambda x: F.lower(x))
    every = F.array_distinct(F.concat(low, snake_parts, words, chinese))
    return F.array_sort(F.array_except(every, F.array(*[F.lit(w) for w in STOPWORDS])))


def seed_tokens(c: Column, limit: int = 5) -> Column:
    """The longest alignment tokens; ties in alphabetical order."""
    keyed = F.transform(alignment_tokens(c), lambda t: F.named_struct(F.lit("n"), -F.length(t), F.lit("t"), t))
    return F.slice(F.transform(F.array_sort(keyed), lambda s: s["t"]), 1, limit)


def search_terms(c: Column, limit: int = 12) -> Column:
    """Distinct names and words of a query, sorted, limit at most."""
    patterns = (r"\b([A-Z][a-z0-9]+(?:[A-Z][a-z0-9]*)+)\b", r"\b([a-z][a-z0-9]*(?:_[a-z0-9]+)+)\b", r"\b([A-Z]{2,}[A-Z0-9]*)\b", r"\b([A-Za-z][A-Za-z0-9]{2,})\b")
    found = F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in patterns])
    return F.slice(F.array_sort(F.array_distinct(found)), 1, limit)


def path_matches(a: Column, b: Column) -> Column:
    """Equal paths, or one ends with the other, slashes normalised."""
    a, b = (F.regexp_replace(F.translate(x, "\\", "/"), r"^\./", "") for x in (a, b))
    return (a == b) | a.endswith(F.concat(F.lit("/"), b)) | b.endswith(F.concat(F.lit("/"), a))


def context_ref(ref: Column) -> Column:
    """struct(path, symbol) of path#symbol or path::symbol."""
    sharp = ref.contains("#")
    path = F.when(sharp, F.regexp_extract(ref, r"(?s)^(.*)#[^#]*$", 1)).when(ref.contains("::"), F.regexp_extract(ref, r"(?s)^(.*)::.*$", 1)).otherwise(ref)
    symbol = F.when(sharp, F.regexp_extract(ref, r"#([^#]*)$", 1)).when(ref.contains("::"), F.regexp_extract(ref, r"(?s)^.*::(.*)$", 1)).otherwise("")
    return F.struct(path.alias("path"), symbol.alias("symbol"))


def is_numeric(c: Column) -> Column:
    return c.rlike(r"^[0-9.,]+$")


def is_graph_searchable(c: Column) -> Column:
    return c.rlike(r"[A-Za-z]") | (F.length(c) >= 5)


def effective_lines(c: Column) -> Column:
    """Stripped lines of 200 characters at most, without blank ones, comments, imports and annotations."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.substring(strip(x), 1, 200))
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^(//|/\*|\*|#|import |from |package |@)"))


def method_calls(c: Column) -> Column:
    """Distinct called names, without trivial words and accessors, in order."""
    names = F.regexp_extract_all(c, F.lit(r"\b([A-Za-z_][A-Za-z0-9_]*)[ \t]*\("), F.lit(1))
    return F.array_distinct(F.filter(names, lambda n: ~n.isin("if", "for", "while", "switch", "return", "new", "catch", "super", "this") & ~n.rlike(r"^(get|set|is)[A-Z]")))


def glob_regex(pattern: str) -> str:
    """Regular expression of a glob whose * crosses slashes."""
    out = []
    for ch in pattern:
        out.append(".*" if ch == "*" else "." if ch == "?" else "\\" + ch if ch in r"\.^$+{}()|[]" else ch)
    return "^" + "".join(out) + "$"


def matches_any(c: Column, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(glob_regex(p))
    return out


def fenced_json(c: Column) -> Column:
    """The JSON text of an answer: inside a code fence, else from the first to the last brace, else bracket; null if it doesn't parse."""
    body = strip(F.coalesce(F.nullif(F.regexp_extract(c, r"(?s)```(?:json)?(.*?)```", 1), F.lit("")), c))
    tries = [body, F.regexp_extract(body, r"(?s)(\{.*\})", 1), F.regexp_extract(body, r"(?s)(\[.*\])", 1)]
    return F.coalesce(*[F.when(F.try_parse_json(t).isNotNull() & t.rlike(r"^[\[{]"), t) for t in tries])
