"""What texts and paths say about code: roles, searchable words, constants, amounts and accounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

#: Words of formats and of prompts, which nothing is searched by, and stop words.
FORMAT_WORDS = ("表格", "表头", "列表", "缩进", "编号", "输出格式", "markdown", "table", "header", "footer", "format", "output", "indentation", "numbered", "bullet", "heading", "column", "row")
PROMPT_WORDS = (
    "skill", "rule", "output", "format", "task", "question", "benchmark", "rollout", "agent", "model", "answer", "verify", "ensure", "check", "validate", "require", "include", "follow", "document", "instruction", "hint", "deliverable", "response", "expected",
)
STOP_WORDS = (
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "had", "her", "was", "one", "our", "out", "has", "have", "this", "that", "with", "from", "they", "will", "been", "were", "some", "what", "when", "make", "like",
    "just", "into", "over", "such", "each", "also", "how", "its", "after", "most", "very", "get", "set",
)
#: A role by a folder of the path, then by the ending of a symbol or file name; the first that fits decides.
FOLDER_ROLES = (
    ("processor", "processor"), ("service", "service"), ("domain", "domain"), ("dto", "dto"), ("enum", "enum"), ("enums", "enum"), ("helper", "helper"), ("util", "util"), ("handler", "handler_only"), ("controller", "handler_only"),
    ("resource", "resource_api"), ("config", "configuration"), ("configuration", "configuration"),
)
ENDING_ROLES = (
    ("Processor(?:Impl)?", "processor"), ("Service(?:Impl)?", "service"), ("Handler", "handler_only"), ("CommandHandler", "handler_only"), ("ApiResource(?:Swagger)?", "swagger"), ("Resource", "resource_api"), ("Controller", "handler_only"),
    ("Config(?:uration)?", "configuration"), ("DTO", "dto"), ("Enum", "enum"), ("Constants?", "enum"), ("Domain(?:Service)?", "domain"), ("Validator", "validator"), ("Mapper", "mapper"), ("Builder", "domain"), ("Listener", "listener"),
    ("Event", "event"), ("Helper", "helper"), ("Utils?", "util"), ("Starter", "starter"),
)
#: Words of the sides, amounts and accounts of bookings, and further words of telling lines.
CREDIT, DEBIT = ("credit", "credited", "cred"), ("debit", "debited", "deb")
AMOUNT, ACCOUNT = ("amount", "transactionamount", "tranamount", "money", "value", "price"), ("account", "accountid", "glaccount", "glaccountid", "officeid", "savings", "loan")
TELLING = ("enum", "create", "process", "validate", "accounting", "journal", "entry", "transaction")


def content_words(words: Column) -> Column:
    """Words of two characters or more that are none of formats or prompts."""
    trimmed = F.transform(words, lambda w: F.trim(F.coalesce(w, F.lit(""))))
    return F.filter(trimmed, lambda w: (F.length(w) >= 2) & ~F.lower(w).isin(*FORMAT_WORDS, *PROMPT_WORDS))


def is_searchable(c: Column) -> Column:
    """Whether a text holds something that code can be searched by: Chinese, a CamelCase name, or a plain word of content."""
    bare = T.strip(F.coalesce(c, F.lit("")))
    plain = F.exists(F.split(F.lower(bare), r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(*FORMAT_WORDS, *PROMPT_WORDS, *STOP_WORDS) & w.rlike(r"^[a-z]{3,}$|\b(processor|service|domain|dto|enum|util|helper|validator|mapper|event|listener|hook|handler|controller|resource|config|repository)\b"))
    named = bare.rlike(r"[\x{4e00}-\x{9fff}]") | bare.rlike(r"\b[A-Z][a-zA-Z0-9]{2,}")
    return (bare != "") & ~F.lower(bare).isin(*FORMAT_WORDS, *PROMPT_WORDS) & (named | plain)


def role_by_place(path: Column, symbol: Column) -> Column:
    """Role by the first telling folder rule, else by the ending of the symbol or file name."""
    folders = F.transform(F.slice(F.split(F.lower(F.translate(path, "\\", "/")), "/"), F.lit(1), F.greatest(F.lit(0), F.size(F.split(path, r"[/\\]")) - 1)), lambda x: x)
    out = None
    for name, role in FOLDER_ROLES:
        hit = F.array_contains(folders, name)
        out = F.when(hit, role) if out is None else out.when(hit, role)
    file = F.element_at(F.split(path, r"[/\\]"), -1)
    for ending, role in ENDING_ROLES:
        out = out.when(F.coalesce(symbol, F.lit("")).rlike(f"(?i){ending}$") | file.rlike(f"(?i){ending}$"), role)
    return out.otherwise("unknown")


def index_role(kind: Column, name: Column, framework: Column, role: Column) -> Column:
    """struct(framework, role) for a role index: what a node's metadata says, else by kind and name."""
    low, known = F.lower(F.coalesce(name, F.lit(""))), F.coalesce(framework, F.lit(""))
    guess = (
        F.when((kind == "route") | low.contains("rest") | low.contains("controller"), "api_resource").when((kind == "job") | low.contains("scheduled"), "scheduled_job").when(low.contains("service"), "service")
        .when(low.contains("repository") | low.contains("mapper"), "repository").when(kind == "config", "config")
    )
    own = F.coalesce(role, F.lit("")) != ""
    frame = F.when(own, F.coalesce(F.nullif(known, F.lit("")), F.lit("custom"))).when(guess.isNotNull(), F.coalesce(F.nullif(known, F.lit("")), F.lit("spring"))).otherwise(known)
    return F.struct(frame.alias("framework"), F.when(own, role).otherwise(F.coalesce(guess, F.when(known != "", "component"), F.lit(""))).alias("role"))


def enum_refs(c: Column) -> Column:
    """Distinct Type.CONSTANT references: of types named as enumerations, else of any capitalised name."""
    of = lambda p: F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(p), F.lit(1)), lambda x: F.regexp_replace(x, r"\s", "")))
    typed = of(r"\b([A-Z]\w+(?:Enum(?:erations|s)?|Type|Status)\s*\.\s*[A-Z_][A-Z0-9_]*)")
    return F.when(F.size(typed) > 0, typed).otherwise(of(r"\b([A-Z]\w{3,}\.[A-Z_][A-Z0-9_]{2,})\b"))


def booking_names(c: Column, most: int = 6) -> Column:
    """'name (kind)' of identifiers that speak of bookings: accounts and amounts of a side first, then sides, accounts, amounts; in order of place."""
    has = lambda w, words: T.any_contained(w, words)

    def kind(name):
        w = F.lower(name)
        return (
            F.when(w.isin(*CREDIT), "credit").when(w.isin(*DEBIT), "debit").when(w.isin(*AMOUNT), "amount").when(w.isin(*ACCOUNT), "account").when(has(w, CREDIT) & has(w, ACCOUNT), "credit_account")
            .when(has(w, DEBIT) & has(w, ACCOUNT), "debit_account").when(has(w, CREDIT) & has(w, AMOUNT), "credit_amount").when(has(w, DEBIT) & has(w, AMOUNT), "debit_amount")
        )

    order = F.array(*map(F.lit, ("debit_account", "credit_account", "debit_amount", "credit_amount", "debit", "credit", "account", "amount")))
    names = F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b([a-zA-Z_]\w{2,})\b"), F.lit(1)))
    keyed = F.transform(names, lambda n, i: F.named_struct(F.lit("at"), F.array_position(order, kind(n)), F.lit("i"), i, F.lit("t"), F.concat(n, F.lit(" ("), kind(n), F.lit(")"))))
    return F.slice(F.transform(F.array_sort(F.filter(keyed, lambda k: k["t"].isNotNull())), lambda k: k["t"]), 1, most)


def quotes(lines: Column, most: int = 3) -> Column:
    """Lines with telling words first, each kind in order."""
    tells = lambda x: T.any_contained(F.lower(x), (*CREDIT, *DEBIT, *AMOUNT, *ACCOUNT, *TELLING))
    return F.slice(F.concat(F.filter(lines, tells), F.filter(lines, lambda x: ~tells(x))), 1, most)


def request_slug(role: Column, stage: Column, most: int = 80) -> Column:
    """File-safe name of a call."""
    return F.substring(F.regexp_replace(F.concat_ws("_", F.coalesce(role, F.lit("call")), stage), r"[^A-Za-z0-9._-]+", "_"), 1, most)
