"""English stemming after M. F. Porter, "An algorithm for suffix stripping" (1980).

Stemming has no built-in counterpart, so this is a Python step: an
Arrow-batched function from token lists to token lists. Texts stay where they
are (no shuffle), and within a batch a repeated word is a dictionary lookup.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# Suffix tables of the paper, each tried longest suffix first.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()

_VOWEL_RUN = re.compile(r"v+c+")


def _shape(stem: str) -> str:
    """The stem as a string of v and c; y is a vowel after a consonant."""
    out = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN.findall(_shape(stem)))


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _strip_past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest(word, ("ed", "ing"))
    if ending is None or "v" not in _shape(word[: -len(ending)]):
        return word
    word = word[: -len(ending)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _double_consonant(word) and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if _measure(word) == 1 and _short_end(word) else word


def porter(word: str) -> str:
    if len(word) < 3 or not word.isascii() or not word.isalpha():
        return word
    plural = _longest(word, ("sses", "ies", "ss", "s"))
    if plural in ("sses", "ies"):
        word = word[:-2]
    elif plural == "s":
        word = word[:-1]
    word = _strip_past(word)
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP_2, STEP_3):
        suffix = _longest(word, table)
        if suffix and _measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + table[suffix]
    suffix = _longest(word, STEP_4)
    if suffix:
        stem = word[: -len(suffix)]
        if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def porter_stem_tokens(tokens: Column) -> Column:
    # Ship this module with the function, so executors need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @pandas_udf("array<string>")
    def stems(lists: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def stem(word: str) -> str:
            if word not in known:
                known[word] = porter(word)
            return known[word]

        return lists.map(lambda ts: None if ts is None else [stem(t) for t in ts])

    return stems(tokens)
