"""Fuzzy string scores that SQL has no built-in for, as one Arrow-batched function.

Scores are Indel similarities: 2 * LCS / (len a + len b). The longest common subsequence is found
bit-parallel over Python integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructField, StructType

NAMES = ("ratio", "token_sort", "token_set", "partial", "weighted")


def _masks(a: str) -> dict[str, int]:
    """The places of each character of a, as bits."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _lengths(masks: dict[str, int], n: int, text: str) -> Iterator[int]:
    """After each character of text, how many of the n characters behind masks that part has in common with them, in order."""
    full = s = (1 << n) - 1
    get = masks.get
    for c in text:
        if u := s & get(c, 0):
            s = ((s + u) | (s - u)) & full
        yield n - s.bit_count()


def _common(masks: dict[str, int], n: int, text: str) -> int:
    full = s = (1 << n) - 1
    get = masks.get
    for c in text:
        if u := s & get(c, 0):
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def lcs(a: str, b: str) -> int:
    if len(a) > len(b):
        a, b = b, a
    return _common(_masks(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """1 for two empty strings."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def _sorted(a: str) -> str:
    return " ".join(sorted(a.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    with_left, with_right = (f"{both} {s}".strip() for s in (left, right))
    found = ratio(with_left, with_right)
    return max(found, ratio(both, with_left), ratio(both, with_right)) if both else found


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer one, cut windows at the ends included.

    The windows cut by the front are prefixes, which one pass scores together; those cut by the end
    are prefixes of the reversed strings. A whole window moved by k characters gains at most k, so
    windows that can't beat the best so far are passed over.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 1.0 if not b else 0.0
    n, masks = len(a), _masks(a)
    most = start = 0
    while start <= len(b) - n and most < n:
        found = _common(masks, n, b[start : start + n])
        most = max(most, found)
        start += most - found + 1
    best = most / n
    if best < 1.0:
        for m, text in ((masks, b[: n - 1]), (_masks(a[::-1]), b[: -n : -1])):
            best = max([best, *(2 * k / (n + w) for w, k in enumerate(_lengths(m, n, text), 1))])
    return best


def partial_token(a: str, b: str) -> float:
    """The better of sorted and of differing tokens; 1 where a token is shared."""
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 1.0
    return max(partial(_sorted(a), _sorted(b)), partial(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted(a: str, b: str) -> float:
    return scores(a, b)[4] if a and b else 0.0


def scores(a: str, b: str) -> tuple[float, float, float, float, float]:
    """All of NAMES for two strings that aren't empty; the weighted score is made of the others."""
    found = (ratio(a, b), token_sort(a, b), token_set(a, b), partial(a, b))
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return (*found, max(found[0], 0.95 * max(found[1:3])))
    scale = 0.6 if longer > 8 else 0.9
    return (*found, max(found[0], scale * found[3], 0.95 * scale * partial_token(a, b)))


def guarded(a: str, b: str) -> tuple[float, float, float, float, float]:
    """scores; two empty strings are equal, one empty string is like nothing."""
    if not a or not b:
        return (1.0 if a == b else 0.0,) * 5
    return scores(a, b)


@F.pandas_udf(StructType([StructField(n, FloatType()) for n in NAMES]))
def _scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    known: dict[tuple[str, str], tuple[float, ...]] = {}
    rows = []
    for key in zip(a.fillna(""), b.fillna(""), strict=True):
        if key not in known:
            known[key] = guarded(*key)
        rows.append(known[key])
    return pd.DataFrame(rows, columns=list(NAMES)) if rows else pd.DataFrame({n: pd.Series([], dtype="float32") for n in NAMES})


def fuzzy_scores(a: Column, b: Column) -> Column:
    """A struct of the five scores of two normalised strings."""
    return _scores(a, b)
