"""Text functions that Spark lacks, as vectorised UDFs: infix edit distance, accent folding, mojibake repair."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .. import config


def infix_distance(pattern: str, text: str, most: int) -> int:
    """Least edits that turn `pattern` into some substring of `text`, -1 if more than `most`.

    Bit-parallel dynamic programming (Myers 1999): a column of vertical differences is two integers, and a text
    character costs a few operations on them.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for ch in text:
        eq = masks.get(ch, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & full
        hp = minus | (full & ~(d0 | plus))
        hn = plus & d0
        score += 1 if hp & top else -1 if hn & top else 0
        hp, hn = hp << 1, hn << 1
        plus = (hn | ~(d0 | hp)) & full
        minus = hp & d0 & full
        best = min(best, score)
        if best == 0:
            break
    return best if best <= most else -1


def text_distance(a: str | None, b: str | None, most: float = config.MAX_TEXT_DISTANCE) -> float:
    """Infix distance over the shorter text's length, -1 beyond `most`; empty texts are never alike."""
    a, b = (a or "").strip(), (b or "").strip()
    if not a or not b:
        return -1.0
    if len(a) > len(b):
        a, b = b, a
    limit = int(most * len(a))
    # some piece of the shorter text must occur unchanged if at most `limit` edits suffice
    step = len(a) // (limit + 1)
    if step and not any(a[i * step : (i + 1) * step] in b for i in range(limit + 1)):
        return -1.0
    d = infix_distance(a, b, limit)
    return float(d) if d < 0 else d / len(a)


@F.pandas_udf(DoubleType())
def _similarity(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    return pd.Series([text_distance(*x) for x in zip(a, b, most, strict=True)], dtype="float64")


def infix_similarity(a: Column, b: Column, most: Column | None = None) -> Column:
    """`text_distance` as a column."""
    return _similarity(a, b, F.lit(config.MAX_TEXT_DISTANCE) if most is None else most)


_FOLDED = {"ß": "ss", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "đ": "d", "ł": "l", "Ł": "L", "œ": "oe", "Œ": "OE", "’": "'", "‘": "'", "–": "-", "—": "-"}


def fold_accents(text: str) -> str:
    text = "".join(_FOLDED.get(c, c) for c in text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def accent_fold(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else fold_accents(t))


def repair(text: str, runs: bool = False) -> str:
    """Known mojibake in order. `runs` also decodes other UTF-8 bytes that were read as Latin-1."""
    for bad, good in config.MOJIBAKE.items():
        text = text.replace(bad, good)

    def decode(m: re.Match) -> str:
        try:
            return m[0].encode("latin1").decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    return re.sub(r"[\xc2-\xf4][\x80-\xbf]+", decode, text) if runs else text


def mojibake_repair(text: Column) -> Column:
    """The same as nested built-in replacements."""
    for bad, good in config.MOJIBAKE.items():
        text = F.replace(text, F.lit(bad), F.lit(good))
    return text
