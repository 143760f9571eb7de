"""The argument scanner against a plain one, character by character; booking facts on cases."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorefold.functions import calls as X

PIECES = ["f(", "F (", "pay(", "(", ")", "[", "]", "{", "}", ",", '"', "'", "\\", '\\"', "a", "b c", " ", "é", "\n", "x.get(1, 2)", '"a,(b"', "f"]


def plain_end(text, at):
    depth, quote, skip = 1, None, False
    for i in range(at, len(text)):
        c = text[i]
        if quote:
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == quote:
                quote = None
        elif c in "\"'":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return i
    return None


def plain_split(text):
    parts, now, depth, quote, skip = [], "", 0, None, False
    for c in text:
        if quote:
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == quote:
                quote = None
        elif c in "\"'":
            quote = c
        elif c in "([{":
            depth += 1
        elif c in ")]}":
            depth = max(0, depth - 1)
        elif c == "," and not depth:
            parts.append(now.strip())
            now = ""
            continue
        now += c
    return parts + [now.strip()] if now.strip() else parts


@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_scan_like_plain(text):
    import re

    pattern = re.compile(r"(?i)\b(f|pay)\s*\(")
    want = [(m.group(1), text[m.end() : end], plain_split(text[m.end() : end])) for m in pattern.finditer(text) if (end := plain_end(text, m.end())) is not None]
    assert X.find_calls(text, pattern) == want and X.split_args(text) == plain_split(text)


CASES = [
    ("nested", 'helper.createJournalEntriesForLoan(office, "a,b)", CashAccountsForLoan.FUND_SOURCE.getValue(), map.get(k, AccrualAccountsForLoan.LOAN_PORTFOLIO), x)', ["debit→FUND_SOURCE", "credit→LOAN_PORTFOLIO"]),
    ("sides", "createDebitJournalEntryForLoan(o, AccountsForLoan.A, AccountsForLoan.A); this.helper.createCreditJournalEntryForLoanCharges(FinancialActivity.B_1)", ["debit→A", "credit→B_1"]),
    ("maps", "populateCreditDebitMaps(a, b, c, AccountsForLoan.CR, AccountsForSavings.DR, holder)", ["credit→CR", "debit→DR"]),
    ("amount", "createDebitJournalEntryForLoan(office, netAmount); createjournalentriesforsavings(x, grossAmount)", ["debit amount=netAmount", "journal amount=grossAmount"]),
    ("amount after a side", "createDebitJournalEntryForLoan(AccountsForLoan.A); createDebitJournalEntryForLoan(amount)", ["debit→A"]),
    ("unclosed", 'createDebitJournalEntryForLoan(AccountsForLoan.A, ")"', []),
    ("unclosed quote", "createDebitJournalEntryForLoan(AccountsForLoan.A, ')", []),
    ("most", "createDebitJournalEntryForLoan(" + ", ".join(f"AccountsForLoan.N{i}" for i in range(9)) + ")", [f"debit→N{i}" for i in range(4)]),
    ("few arguments", "createJournalEntriesForLoan(a, b)", []), ("none", None, []), ("empty", "", []), ("inside a word", "xcreateDebitJournalEntryForLoan(AccountsForLoan.A)", []),
]


def test_booking_facts(spark):
    df = spark.createDataFrame([(n, t) for n, t, _ in CASES], "n string, t string")
    got = {r.n: r.f for r in df.select("n", X.booking_facts(X.calls(F.col("t"))).alias("f")).collect()}
    assert got == {n: f for n, _, f in CASES}
