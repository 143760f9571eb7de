"""Calls inside source text with their whole arguments, however nested; and what booking calls say."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Calls that book entries, and what names an account in their arguments.
BOOKING_CALLS = (
    "createDebitJournalEntryForLoan", "createCreditJournalEntryForLoan", "createJournalEntriesForLoan", "createDebitJournalEntryForLoanCharges", "createCreditJournalEntryForLoanCharges",
    "createCashBasedJournalEntriesAndReversalsForSavings", "createCashBasedJournalEntriesAndReversalsForSavingsCharges", "createCashBasedJournalEntriesAndReversalsForSavingsTax", "createJournalEntriesForSavings", "populateCreditDebitMaps",
)
ACCOUNT = r"\b(?:(?:Cash|Accrual)?AccountsFor(?:Loan|Savings|Shares)|FinancialActivity)\.(\w+)\b"
AMOUNT = r"(?i)\b(\w*amount\w*|transactionPartAmount|grossAmount|netAmount)\b"
#: By lower-cased call, the places (from 1) of its debited and its credited account.
PLACES = {
    "createjournalentriesforloan": (3, 4), "createcashbasedjournalentriesandreversalsforsavings": (3, 4), "createcashbasedjournalentriesandreversalsforsavingscharges": (3, 4),
    "createcashbasedjournalentriesandreversalsforsavingstax": (3, 4), "createjournalentriesforsavings": (3, 4),
}
FACTS = 4
CALLS = "array<struct<name:string,text:string,args:array<string>>>"
#: What a scan stops at: an escape with its character, quotes, brackets and commas; all else is passed in one step.
STOPS = re.compile(r"""\\.|["'()\[\]{},]""", re.S)
OPEN, CLOSE = "([{", ")]}"


def _scan(text: str, at: int, end: int, call: bool):
    """(end of the text, its parts between top-level commas) from at on; a call ends at the bracket that closes it, None if none does.

    Quoted text is passed whole; an escape counts inside quotes alone. In a call only round brackets are counted
    towards its end, as in a lexer that knows no others; commas count outside brackets of any kind.
    """
    quote, round_, depth, first, parts = "", 1, 0, at, []
    while stop := STOPS.search(text, at, end):
        c, at = stop.group(), stop.end()
        if len(c) > 1:
            if not quote:
                at = stop.start() + 1
        elif quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif call and c == ")" and round_ == 1:
            return stop.start()
        elif call:
            round_ += (c == "(") - (c == ")")
        elif c in OPEN:
            depth += 1
        elif c in CLOSE:
            depth = max(0, depth - 1)
        elif depth == 0:
            parts.append(text[first : stop.start()].strip())
            first = at
    if call:
        return None
    tail = text[first:end].strip()
    return [*parts, tail] if tail else parts


def split_args(text: str) -> list[str]:
    """Parts of an argument list, split at commas outside brackets and quotes; an empty last part is none."""
    return _scan(text, 0, len(text), False)


def find_calls(text: str, pattern: re.Pattern) -> list[tuple[str, str, list[str]]]:
    """(name, argument text, arguments) of the calls that pattern finds; one that is never closed is left out."""
    out = []
    for m in pattern.finditer(text):
        end = _scan(text, m.end(), len(text), True)
        if end is not None:
            out.append((m.group(1), text[m.end() : end], split_args(text[m.end() : end])))
    return out


def calls(text: Column, names: tuple[str, ...] = BOOKING_CALLS) -> Column:
    """array of (name, text, args): calls of the names (any case) in order of place; null texts have none."""
    pattern = re.compile(r"(?i)\b(" + "|".join(map(re.escape, names)) + r")\s*\(")

    @F.pandas_udf(CALLS)
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"name": n, "text": s, "args": a} for n, s, a in find_calls(t, pattern)] if isinstance(t, str) else [])

    return found(text)


def top_level(text: Column) -> Column:
    """The parts of an argument list; null texts have none."""

    @F.pandas_udf("array<string>")
    def parts(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_args(t) if isinstance(t, str) else [])

    return parts(text)


def booking_facts(found: Column, most: int = FACTS) -> Column:
    """What booking calls say, in order: side→account once each, or an amount while no side is known; most at most."""
    none = F.array().cast("array<string>")
    account = lambda arg: F.regexp_extract(F.coalesce(arg, F.lit("")), ACCOUNT, 1)
    sided = lambda side, arg: F.concat(F.lit(f"{side}→"), F.nullif(account(arg), F.lit("")))

    def told(call) -> Column:
        """The sides that a call names, nulls among them."""
        low, arg = F.lower(call["name"]), lambda i: F.get(call["args"], F.lit(i - 1))
        out = F.when(low.contains("debitjournalentry"), F.transform(call["args"], lambda a: sided("debit", a)))
        out = out.when(low.contains("creditjournalentry"), F.transform(call["args"], lambda a: sided("credit", a)))
        out = out.when(low == "populatecreditdebitmaps", F.array(sided("credit", arg(4)), sided("debit", arg(5))))
        for name, (debit, credit) in PLACES.items():
            out = out.when(low == name, F.array(sided("debit", arg(debit)), sided("credit", arg(credit))))
        return out.otherwise(none)

    def step(facts, call):
        new = F.array_except(F.filter(told(call), lambda x: x.isNotNull()), facts)
        both = F.concat(facts, new)
        low, amount = F.lower(call["name"]), F.regexp_extract(call["text"], AMOUNT, 1)
        prefix = F.when(low.contains("debitjournalentry"), "debit").when(low.contains("creditjournalentry"), "credit").otherwise("journal")
        silent = (amount != "") & ~F.exists(both, lambda x: x.startswith("debit→") | x.startswith("credit→"))
        return F.when(silent, F.concat(both, F.array(F.concat(prefix, F.lit(" amount="), amount)))).otherwise(both)

    return F.slice(F.aggregate(found, none, step), 1, most)
