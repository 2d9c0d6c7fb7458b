"""English words: stop words, stems by M. F. Porter's published algorithm (1980), and hits of a query's stems in texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes and what takes their place, by step of the algorithm.
PLURALS = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = {s: "" for s in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")}

_WORD = re.compile("[a-z0-9]+")


def _form(w: str) -> str:
    """`v` or `c` for each letter; y is a vowel after a consonant."""
    out = ""
    for ch in w:
        out += "v" if ch in "aeiou" or (ch == "y" and out.endswith("c")) else "c"
    return out


def _measure(w: str) -> int:
    return _form(w).count("vc")


def _short(w: str) -> bool:
    return _form(w).endswith("cvc") and w[-1] not in "wxy"


def _doubled(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _form(w)[-1] == "c"


def _replace(w: str, rules: dict[str, str], least: int) -> str:
    """By the longest suffix that fits, if the measure before it is at least `least`."""
    hit = next((w[-n:] for n in range(min(7, len(w)), 0, -1) if w[-n:] in rules), None)
    if hit is None:
        return w
    rest = w[: len(w) - len(hit)]
    fits = _measure(rest) >= least and (hit != "ion" or rest.endswith(("s", "t")))
    return rest + rules[hit] if fits else w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    end = next((s for s in ("ed", "ing") if w.endswith(s)), None)
    if end is None or "v" not in _form(w[: -len(end)]):
        return w
    w = w[: -len(end)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _doubled(w) and w[-1] not in "lsz":
        return w[:-1]
    return w + "e" if _measure(w) == 1 and _short(w) else w


@lru_cache(maxsize=200_000)
def stem(w: str) -> str:
    """Stem of a lower-case word; words of one or two letters stay."""
    if len(w) < 3:
        return w
    w = _past(_replace(w, PLURALS, 0))
    if w.endswith("y") and "v" in _form(w[:-1]):
        w = w[:-1] + "i"
    w = _replace(_replace(_replace(w, STEP_2, 1), STEP_3, 1), STEP_4, 2)
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _short(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w


def query_stems(query: str) -> list[str]:
    """Distinct stems of a query's words without stop words, sorted."""
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    return sorted({stem(w) for w in _WORD.findall(query.lower()) if w not in stop})


def stem_hits(text: Column, stems: list[str]) -> Column:
    """Words of a text with one of the stems; 0 for none and for NULL.

    Every word of a stem begins with the stem but for its last letter, so texts without such a beginning are settled by
    an expression; only the others, and in them only words that begin so, are stemmed.
    """
    if not stems:
        return F.lit(0).cast("bigint")
    begins = "|".join(sorted({s[:-1] if len(s) > 2 else s[:1] for s in stems}))
    wanted, near = frozenset(stems), re.compile(rf"(?<![a-z0-9])(?:{begins})[a-z0-9]*")

    @F.pandas_udf("bigint")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: sum(stem(w) in wanted for w in near.findall(t)) if t else 0).astype("int64")

    low = F.lower(text)
    return F.coalesce(count(F.when(low.rlike(rf"(?<![a-z0-9])(?:{begins})"), low)), F.lit(0))


def stems(words: Column) -> Column:
    """Stem of each lower-case word; NULL for stop words. Meant for the distinct words of a corpus."""
    stop = frozenset(StopWordsRemover.loadDefaultStopWords("english"))

    @F.arrow_udf("string")
    def run(given: pa.Array) -> pa.Array:
        return pa.array([None if w is None or w in stop else stem(w) for w in given.to_pylist()], pa.string())

    return run(words)
