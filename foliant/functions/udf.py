"""Text functions that the JVM has no built-in for (Unicode character database, edit distance of many lines): Arrow-batched, at leaves only."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import WARNING as _WARNING

WARNINGS = T.ArrayType(_WARNING)
_BIDI = {0x061C, 0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2066, 0x206A)}
_MESSAGES = {
    "embedded_bidi_control": "bidi formatting control inside the text",
    "replacement_character": "replacement character is unresolved",
    "private_use_character": "private-use character needs a review",
    "orphan_combining_mark": "combining mark without a base before it",
}


def _private(cp: int) -> bool:
    return 0xE000 <= cp <= 0xF8FF or 0xF0000 <= cp <= 0xFFFFD or 0x100000 <= cp <= 0x10FFFD


def warnings_of(text: str) -> list[dict]:
    found, based = [], False
    for at, c in enumerate(text):
        cp, mark = ord(c), unicodedata.combining(c) != 0
        code = (
            "embedded_bidi_control" if cp in _BIDI
            else "replacement_character" if cp == 0xFFFD
            else "private_use_character" if _private(cp)
            else "orphan_combining_mark" if mark and not based
            else None
        )
        if code:
            found.append({"code_point": f"U+{cp:04X}", "character_offset": at, "code": code, "message": _MESSAGES[code]})
        based = False if c.isspace() else based or not mark
    return found


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition, never compatibility."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(WARNINGS)
def unicode_warnings(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [] if t is None else warnings_of(t))


#: Characters of each side that are compared at once.
CHARS = 1 << 20


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance over code points: a row of the table is two whole numbers (Myers 1999, Hyyro 2003)."""
    start = 0
    least = min(len(a), len(b))
    while start < least and a[start] == b[start]:
        start += 1
    end = 0
    while end < least - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every, last, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = every, 0
    for c in b:
        eq = at.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | x) & every
        more, less = down | ~(d | up) & every, up & d
        score += ((more & last) != 0) - ((less & last) != 0)
        more, less = (more << 1 | 1) & every, less << 1 & every
        up, down = less | ~(x | more) & every, more & x
    return score


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def distances(left: list[str], right: list[str]) -> np.ndarray:
    """Edit distances of pairs.  For equal lengths the number of differing places is an upper bound and what the two
    multisets of characters there do not share is a lower one; where they meet no table is needed."""
    n, m = np.fromiter(map(len, left), np.int64, len(left)), np.fromiter(map(len, right), np.int64, len(right))
    out, same = np.full(len(left), -1, np.int64), np.flatnonzero(n == m)
    p, q = _points([left[i] for i in same]), _points([right[i] for i in same])
    places = np.flatnonzero(p != q)
    pair = np.searchsorted(np.cumsum(n[same]), places, side="right")
    upper = np.bincount(pair, minlength=len(same))
    key = np.concatenate([pair << 21 | p[places], pair << 21 | q[places]])
    keys, of = np.unique(key, return_inverse=True)
    surplus = np.bincount(of, np.repeat([1, -1], len(places)), len(keys)).astype(np.int64)
    lower = np.bincount(keys >> 21, np.maximum(surplus, 0), len(same)).astype(np.int64)
    out[same] = np.where(upper == lower, upper, -1)
    for i in np.flatnonzero(out < 0):
        out[i] = edit_distance(left[i], right[i])
    return out


def _rates(left: list[str], right: list[str]) -> list[float]:
    found, at = [], 0
    while at < len(left):
        end, chars = at, 0
        while end < len(left) and (end == at or chars + max(len(left[end]), len(right[end])) <= CHARS):
            chars += max(len(left[end]), len(right[end]))
            end += 1
        a, b = left[at:end], right[at:end]
        found += [d / (max(len(x), len(y)) or 1) for d, x, y in zip(distances(a, b).tolist(), a, b)]
        at = end
    return found


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def disagreements(left: pd.Series, right: pd.Series) -> pd.Series:
    """Arrays of readings: edit distance over the longer length, pair by pair; 1 where one is missing, as ``metrics.disagreement``."""
    rows = [([], []) if a is None or b is None else (list(a), list(b)) for a, b in zip(left, right)]
    a, b = [x for r in rows for x in r[0]], [x for r in rows for x in r[1]]
    there = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
    rates = [1.0] * len(a)
    for i, d in zip(there, _rates([a[i] for i in there], [b[i] for i in there])):
        rates[i] = d
    out, at = [], 0
    for r in rows:
        out.append(rates[at : at + len(r[0])])
        at += len(r[0])
    return pd.Series(out, dtype=object)
