"""Similarities of texts and token sets, as columns."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step for each character of b (Hyyrö 2004)."""
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        at[c] |= 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at[c]
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@F.pandas_udf(T.LongType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS lengths; equal texts and empty ones need no table."""
    return pd.Series([len(x) if x == y else lcs_length(x, y) if x and y else 0 for x, y in zip(a, b, strict=True)], dtype="int64")


def indel(a: Column, b: Column) -> Column:
    """2 * LCS / (sum of lengths); both empty 1, one empty 0."""
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, F.lit(1.0)).when(a == b, F.lit(1.0)).otherwise(2.0 * lcs(a, b) / F.greatest(total, F.lit(1)))


def token_overlap(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """(Jaccard, containment, common) on distinct tokens; both empty (1, 1, 0), one empty (0, 0, 0)."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    nx, ny, common = F.size(x), F.size(y), F.size(F.array_intersect(x, y))
    both, one = (nx == 0) & (ny == 0), (nx == 0) | (ny == 0)
    ratio = lambda low: F.when(both, 1.0).when(one, 0.0).otherwise(common / F.greatest(low, F.lit(1)))
    return ratio(nx + ny - common), ratio(F.least(nx, ny)), common.cast("double")


def ngrams(c: Column, n: int) -> Column:
    """Distinct character n-grams; none if the text is shorter."""
    return F.when(F.char_length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(c) - n + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def gram_codes(c: Column, n: int) -> Column:
    """ngrams() as numbers, for n up to 3: 21 bits a character, so different grams have different numbers."""
    code = lambda i: sum((F.shiftleft(F.ascii(F.substr(c, i + j, F.lit(1))).cast("long"), 21 * j) for j in range(1, n)), F.ascii(F.substr(c, i, F.lit(1))).cast("long"))
    return F.when(F.char_length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(c) - n + 1, F.lit(1))), code))).otherwise(F.array().cast("array<bigint>"))


def ngram_jaccard(a: Column, b: Column, n: int = 3, sets: tuple[Column, Column] | None = None) -> Column:
    """Both empty 1, one empty 0, equal 1, one shorter than n 0, else Jaccard of the n-gram sets. sets: of a and b, if they are known."""
    la, lb = F.char_length(a), F.char_length(b)
    x, y = sets or (ngrams(a, n), ngrams(b, n))
    common = F.size(F.array_intersect(x, y))
    return F.when(a == b, 1.0).when((la < n) | (lb < n), 0.0).otherwise(common / F.greatest(F.size(x) + F.size(y) - common, F.lit(1)))


def numeric_overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """(share of the smaller set, common); both empty (0.5, 0), one empty (0, 0)."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    nx, ny, common = F.size(x), F.size(y), F.size(F.array_intersect(x, y))
    share = F.when((nx == 0) & (ny == 0), 0.5).when((nx == 0) | (ny == 0), 0.0).otherwise(common / F.greatest(F.least(nx, ny), F.lit(1)))
    return share, common.cast("double")


def sigmoid_score(composite: Column) -> Column:
    """Calibrated probability of a composite similarity, below 0.999."""
    return F.least(1 / (1 + F.exp(-10.0 * (composite - 0.58))), F.lit(0.999))


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    below = beta * beta * precision + recall
    return F.when(below > 0, (1 + beta * beta) * precision * recall / below).otherwise(0.0)
