"""Exact order statistics and quantiles of an unbounded column, without a hot task.

``percentile`` and ``median`` keep every distinct value of a group in one task's buffer: fine for
bounded groups (a grid's hours, a bucket's days), not for a global quantile over a whole fact.

``order_statistic`` narrows an open value range around the wanted rank. Each round brackets the rank by
two values of a quantile sketch (one aggregate), counts the rows below, at and between them (one
aggregate), and goes on inside the part that holds the rank. The counts are exact, so the answer never
depends on the sketch; the sketch only makes the part small, whatever the distribution. A value that
many rows share is found by the count at it. Once at most ``few`` rows are left in the range, these, and
never more, are sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW = 50_000        # rows that may meet in one task
ACCURACY = 10_000   # of the sketch: rank error 1 / ACCURACY of the range's rows
ROUNDS = 200        # far beyond any need (each round leaves a small share of the rows): then it raises


def order_statistic(df: DataFrame, col: str, rank: int, few: int = FEW, accuracy: int = ACCURACY):
    """The value at ``rank`` (from 0) of the sorted non-null values of a numeric column.

    NaN sorts last. Raises IndexError for a rank outside. Callers should pass a stored frame: every round
    reads the column twice.
    """
    x = df.select(F.col(col).alias("x")).where(F.col("x").isNotNull())
    inside = x                                # rows of the open range at hand
    left = x.agg(F.count(F.lit(1))).first()[0]
    if not 0 <= rank < left:
        raise IndexError(f"rank {rank} of {left} values")
    at = rank                                 # the rank within the range
    for _ in range(ROUNDS):
        if left <= few:
            return inside.orderBy("x").limit(few).agg(F.array_sort(F.collect_list("x")).alias("v")).first()["v"][at]
        share = (at + 0.5) / left
        margin = 3.0 / accuracy + 2.0 / left
        low, high = inside.agg(F.percentile_approx("x", F.array(F.lit(max(share - margin, 0.0)), F.lit(min(share + margin, 1.0))),
                                                   accuracy)).first()[0]
        c, lo, hi = F.col("x"), F.lit(low), F.lit(high)
        n = inside.agg(*(F.count_if(condition) for condition in (c < lo, c <= lo, c < hi, c <= hi))).first()
        below_low, upto_low, below_high, upto_high = n
        if below_low <= at < upto_low:
            return low
        if below_high <= at < upto_high:
            return high
        if at < below_low:
            inside, left = inside.where(c < lo), below_low
        elif at < below_high:
            inside, at, left = inside.where((c > lo) & (c < hi)), at - upto_low, below_high - upto_low
        else:
            inside, at, left = inside.where(c > hi), at - upto_high, left - upto_high
    raise RuntimeError("the range around the rank does not get smaller")


def exact_quantile(df: DataFrame, col: str, p: float, few: int = FEW, accuracy: int = ACCURACY):
    """Exact linear-interpolated ``p``-quantile of ``col`` (NULLs skipped), as ``percentile`` gives it.

    None when there is no value. No task holds more than ``few`` values, whatever the number of rows.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    n = x.agg(F.count(F.lit(1))).first()[0]
    if n == 0:
        return None
    position = (n - 1) * p
    low, high = math.floor(position), math.ceil(position)
    first = order_statistic(x, "x", low, few, accuracy)
    if low == high:
        return float(first)
    # The next order statistic: the same value if enough rows share it, else the least above it.
    c, v = F.col("x"), F.lit(first)
    upto, above = x.agg(F.count_if(c <= v), F.min(F.when(c > v, c))).first()
    second = first if upto > high else above
    share = position - low
    return float((1.0 - share) * first + share * second)
