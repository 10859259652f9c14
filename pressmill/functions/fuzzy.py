"""Fuzzy ratios on Arrow batches, from their published definitions (0 to 100).

ratio: normalised Indel similarity, 100 * 2 * LCS / (len a + len b), by bit-parallel LCS on Python integers.
token_set_ratio: 100 when one side's words contain the other's; else the best ratio among the sorted common
words and the common words with either rest. partial_ratio: the best ratio of the shorter text against windows
of the longer. Nulls are empty texts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    common = " ".join(both)
    one, two = " ".join([*both, *left]), " ".join([*both, *right])
    best = ratio(one, two)
    return max(best, ratio(common, one), ratio(common, two)) if both else best


def partial_ratio(a: str, b: str) -> float:
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    if not n:
        return 100.0 if not long_ else 0.0
    windows = [long_[max(0, i) : i + n] for i in range(1 - n, len(long_))]
    return max(ratio(short, w) for w in windows if w)


def partial_reaches(a: str, b: str, least: float) -> bool:
    """Whether partial_ratio(a, b) is ``least`` or more: windows are compared where they hold enough of the shorter text's characters."""
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    if not n:
        return partial_ratio(a, b) >= least
    counts = Counter(short)
    most = sum(min(c, long_.count(ch)) for ch, c in counts.items())
    if 200.0 * most < least * (n + most):  # a window has at least the characters in common
        return False
    text = np.frombuffer(long_.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.arange(1 - n, len(long_))
    low, high = np.maximum(starts, 0), np.minimum(starts + n, len(long_))
    held = np.zeros(len(starts), np.int64)
    for ch, c in counts.items():
        seen = np.concatenate([[0], np.cumsum(text == ord(ch))])
        held += np.minimum(c, seen[high] - seen[low])
    return any(ratio(short, long_[low[i] : high[i]]) >= least for i in np.flatnonzero(200.0 * held >= least * (n + high - low)))


def _udf(f):
    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)

    return scored


ratio_udf, token_set_udf, partial_udf = _udf(ratio), _udf(token_set_ratio), _udf(partial_ratio)
