"""Sources with their comments and strings blanked, line by line as they were, so that line patterns see code alone."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: By family of languages what is no code: comments, and texts whose quotes stay. A text ends with its line, but for
#: those of several lines; what is never closed runs to the end of its line or, of several lines, of the file.
LINE_TEXTS = r""""(?:\\.|[^"\\\n])*"?|'(?:\\.|[^'\\\n])*'?"""
FAMILIES = {
    "c": re.compile(r'//[^\n]*|/\*.*?(?:\*/|\Z)|""".*?(?:"""|\Z)|`(?:\\.|[^`\\])*(?:`|\Z)|' + LINE_TEXTS, re.S),
    "hash": re.compile(r'#[^\n]*|""".*?(?:"""|\Z)|\'\'\'.*?(?:\'\'\'|\Z)|' + LINE_TEXTS, re.S),
}
HASH_LANGUAGES = ("python", "ruby", "yaml")
#: Characters that no source has.
BINARY = "\0"


def blank(text: str, family: str) -> str:
    """text with spaces in place of comments and of what stands between quotes; lines and columns stay."""

    def out(m: re.Match) -> str:
        s = m.group()
        if s.startswith(("//", "/*", "#")):
            return re.sub(r"[^\n]", " ", s)
        width = 3 if s[:3] in ('"""', "'''") and len(s) >= 3 else 1
        closed = len(s) >= 2 * width and s.endswith(s[:width])
        inner = s[width : len(s) - width if closed else len(s)]
        return s[:width] + re.sub(r"[^\n]", " ", inner) + (s[:width] if closed else "")

    return FAMILIES[family].sub(out, text)


def unclosed(text: str) -> bool:
    """Whether a comment of several lines is never closed."""
    return any(m.group().startswith("/*") and (len(m.group()) < 4 or not m.group().endswith("*/")) for m in FAMILIES["c"].finditer(text))


def masked(text: Column, language: Column) -> Column:
    """struct(code, error): the blanked text, and what is wrong with a file that can't be read as source, or null."""

    @F.pandas_udf("struct<code:string,error:string>")
    def mask(texts: pd.Series, languages: pd.Series) -> pd.DataFrame:
        rows = []
        for t, lang in zip(texts, languages):
            family = "hash" if lang in HASH_LANGUAGES else "c"
            if not isinstance(t, str):
                rows.append((None, "no text"))
            elif BINARY in t:
                rows.append((None, "binary content"))
            else:
                rows.append((blank(t, family), "unclosed comment" if family == "c" and unclosed(t) else None))
        return pd.DataFrame(rows, columns=["code", "error"])

    return mask(text, language)
