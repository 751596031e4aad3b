"""Token-set similarity of names, as an Arrow-batched function."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits for each character of b."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def token_set_ratio_of(a: str | None, b: str | None) -> float:
    """From 0 to 100: how alike two texts are as sets of words, by insertions and deletions."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (left and right):
        return 100.0
    space = 1 if both else 0
    n, m = len(both) + space + len(left), len(both) + space + len(right)
    edits = len(left) + len(right) - 2 * common_length(left, right)
    best = 1 - edits / (n + m)
    if both:
        best = max(best, *(1 - (space + len(own)) / (len(both) + size) for own, size in ((left, n), (right, m))))
    return 100.0 * best


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """Each different pair of a batch is compared once."""
    pairs = list(zip(a, b, strict=True))
    of = {p: token_set_ratio_of(*p) for p in set(pairs)}
    return pd.Series([of[p] for p in pairs], dtype=float)


def token_set_ratio(a: Column, b: Column) -> Column:
    """Equal names that have a word don't go to Python."""
    same = F.when((a == b) & a.rlike(r"(?U)\S"), F.lit(100.0))
    return F.coalesce(same, pandas_udf(_ratios, DoubleType())(a, b))
