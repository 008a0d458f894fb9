"""String similarities. Token-set measures are array expressions; those that need a longest common
subsequence run on Arrow batches, with a bit-parallel kernel on Python integers."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from poiweave.functions.text import AREAL_WORDS, GENERIC_WORDS, _words


def _places(a: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(a):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _common(places: dict[str, int], n: int, b: str) -> int:
    s = (1 << n) - 1
    for c in b:
        u = s & places.get(c, 0)
        s = (s + u) | (s - u)
    return n - (s & (1 << n) - 1).bit_count()


def ratio_of(a: str, b: str) -> float:
    """200 * longest common subsequence / sum of lengths."""
    return 200.0 * _common(_places(a), len(a), b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_of(a: str, b: str) -> float:
    return ratio_of(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_of(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    size = len(" ".join(sorted(both)))
    gap = size > 0
    l1, l2 = size + gap + len(left), size + gap + len(right)
    edits = len(left) + len(right) - 2 * _common(_places(left), len(left), right)
    best = 100.0 - 100.0 * edits / (l1 + l2)
    if size:
        best = max(best, 100.0 - 100.0 * (gap + len(left)) / (size + l1), 100.0 - 100.0 * (gap + len(right)) / (size + l2))
    return best


def partial_of(a: str, b: str) -> float:
    """The best ratio of the shorter text against any window of the longer, clipped at both ends."""
    if not a or not b:
        return 0.0

    def best(short: str, long: str) -> float:
        n, places = len(short), _places(short)
        top = 0.0
        for start in range(1 - n, len(long)):
            window = long[max(0, start) : start + n]
            top = max(top, 200.0 * _common(places, n, window) / (n + len(window)))
        return top

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(a, b) if len(a) < len(b) else best(b, a)


@lru_cache(maxsize=200_000)
def match_score(a: str, b: str) -> float:
    """The matcher's name similarity of two matched names, 0 to 1."""
    return max(token_set_of(a, b), token_sort_of(a, b), partial_of(a, b)) / 100 if a and b else 0.0


@lru_cache(maxsize=200_000)
def name_score(a: str, b: str) -> float:
    """The enrichment similarity of two normalised names, 0 to 1."""
    return max(token_set_of(a, b), ratio_of(a, b), token_sort_of(a, b)) / 100 if a and b else 0.0


def _udf(f):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


ratio, token_sort_ratio, token_set_ratio, partial_ratio = map(_udf, (ratio_of, token_sort_of, token_set_of, partial_of))
match_similarity, name_similarity = _udf(match_score), _udf(name_score)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct tokens; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def has_substring(a: Column, b: Column) -> Column:
    """The shorter of the sorted, joined token lists (three letters at least) lies inside the longer."""
    x, y = F.array_join(F.array_sort(a), " "), F.array_join(F.array_sort(b), " ")
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    return (F.length(short) >= 3) & F.contains(long, short)


def type_overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(F.array_intersect(a, _words(GENERIC_WORDS)), b)


def is_areal(a: Column) -> Column:
    return F.arrays_overlap(a, _words(AREAL_WORDS))


@F.pandas_udf(ArrayType(StringType()))
def top_distinct(texts: pd.Series) -> pd.Series:
    """Of each list, longest first (ties by text), the first two that are below 90 against all taken so far."""

    def pick(values) -> list[str]:
        out: list[str] = []
        for t in sorted((v for v in values if v), key=lambda t: (-len(t), t)):
            if all(token_set_of(t, o) < 90 for o in out):
                out.append(t)
                if len(out) == 2:
                    break
        return out

    return texts.map(lambda v: None if v is None else pick(v))
