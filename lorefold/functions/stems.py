"""Words as a full-text index has them: folded to plain letters and cut to their Porter stems."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented Latin letters and the plain ones they are indexed as.
ACCENTED = "".join(chr(c) for c in range(0xC0, 0x250) if unicodedata.normalize("NFD", chr(c))[0] in "abcdefghijklmnopqrstuvwxyz")
PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in ACCENTED)
#: Word endings and what stands for them, by the step of the stemming rules that has them.
STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "logi": "log", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")
#: Words of other lengths stay as they are.
SHORTEST, LONGEST = 3, 64


def shape(word: str) -> str:
    """v for each vowel (y after a consonant is one), c for each consonant."""
    out = ""
    for ch in word:
        out += "v" if ch in "aeiou" or (ch == "y" and out.endswith("c")) else "c"
    return out


def measure(word: str) -> int:
    return len(re.findall("v+c+", shape(word)))


def _short(word: str) -> bool:
    """It ends in consonant, vowel, consonant, and the last is none of w, x, y."""
    return shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """Porter's stem of a lower-cased word."""
    if not SHORTEST <= len(word) <= LONGEST:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) else word
    elif (end := _longest(word, ("ed", "ing"))) and "v" in shape(word[: -len(end)]):
        word = word[: -len(end)]
        if word.endswith(("at", "bl", "iz")) or (measure(word) == 1 and _short(word)):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c" and word[-1] not in "lsz":
            word = word[:-1]
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    for step in (STEP_2, STEP_3):
        if (end := _longest(word, step)) and measure(word[: -len(end)]):
            word = word[: -len(end)] + step[end]
    if (end := _longest(word, STEP_4)) and measure(word[: -len(end)]) > 1 and (end != "ion" or word[-4] in "st"):
        word = word[: -len(end)]
    if word.endswith("e") and (measure(word[:-1]) > 1 or (measure(word[:-1]) == 1 and not _short(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and measure(word[:-1]) > 1 else word


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased, accents of Latin letters taken off; null texts have none."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, PLAIN)
    return F.regexp_extract_all(folded, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def stems(tokens: Column) -> Column:
    """Each word of an array as its stem; words of a batch are stemmed once."""

    @F.pandas_udf("array<string>")
    def cut(batch: pd.Series) -> pd.Series:
        return batch.map(lambda ws: [stem(w) for w in ws])

    return cut(tokens)
