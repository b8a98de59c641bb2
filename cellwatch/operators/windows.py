"""Window operators.

Partitions are (grid) or (grid, date): a fact has one row per grid and hour, so a window
partition holds at most the number of hours of one grid, however skewed the raw input was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.session import written


def previous_value(df: DataFrame, value: str = "total_activity", partition=("grid_id", "date"),
                   time: str = "timestamp", out: str = "previous_hour_activity", offset: int = 1) -> DataFrame:
    """The value ``offset`` rows earlier in time within the partition."""
    w = Window.partitionBy(*partition).orderBy(time)
    return df.withColumn(out, F.lag(value, offset).over(w))


def leave_one_out_median(df: DataFrame, value: str = "total_activity", partition=("grid_id", "date"),
                         time: str = "timestamp", out: str = "baseline_activity") -> DataFrame:
    """Median of the other rows of the partition, for every row, without arrays or loops.

    With rank r (1-based, by value) and partition size n, the other n-1 values have their
    middle positions lo = n div 2 and hi = (n-1) div 2 + 1. Position p of the reduced list is
    x[p] when p < r else x[p+1]. x[lo], x[lo+1], x[hi], x[hi+1] depend on n only, so four
    whole-partition conditional maxima fetch them. n = 1 gives NULL.
    """
    by_value = Window.partitionBy(*partition).orderBy(F.col(value), F.col(time))
    whole = Window.partitionBy(*partition)
    r = F.col("__r")
    n = F.col("__n")
    lo = F.floor(n / 2).cast("int")
    hi = (F.floor((n - 1) / 2) + 1).cast("int")

    def at(pos: Column) -> Column:
        return F.max(F.when(r == pos, F.col(value))).over(whole)

    staged = (df.withColumn("__r", F.row_number().over(by_value))
                .withColumn("__n", F.count(F.lit(1)).over(whole))
                .withColumns({"__xlo": at(lo), "__xlo1": at(lo + 1), "__xhi": at(hi), "__xhi1": at(hi + 1)}))
    y_lo = F.when(lo < r, F.col("__xlo")).otherwise(F.col("__xlo1"))
    y_hi = F.when(hi < r, F.col("__xhi")).otherwise(F.col("__xhi1"))
    return staged.withColumn(out, (y_lo + y_hi) / 2).drop("__r", "__n", "__xlo", "__xlo1", "__xhi", "__xhi1")


def keep_first(df: DataFrame, key, order) -> DataFrame:
    """One row per key, the first by the stated order (no reliance on file order)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def trailing_rows(df: DataFrame, as_of: Column, hours: int = 24, time: str = "timestamp") -> DataFrame:
    """Rows with ``as_of - (hours-1)h <= ts <= as_of`` (a filter, pushed to the scan)."""
    start = as_of - F.expr(f"INTERVAL {hours - 1} HOURS")
    return df.where((F.col(time) >= start) & (F.col(time) <= as_of))


def number_rows(df: DataFrame, part: str, row: str, out: str) -> DataFrame:
    """Rows numbered from 1 by (part, row), where ``row`` counts up without gaps within each part.

    Only the parts' row counts are ordered, on the driver: one number for each file or partition of a
    table, which the driver lists anyway. The rows are not moved.
    """
    counts = df.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("first")).collect()
    shifts, before = [], 0
    for c in sorted(counts, key=lambda c: c[part]):
        shifts.append((c[part], before - c["first"] + 1))
        before += c["n"]
    kind = dict(df.dtypes)[part]
    shift = df.sparkSession.createDataFrame(shifts, f"`{part}` {kind}, __shift bigint")
    return df.join(shift, part).withColumn(out, F.col(row) + F.col("__shift")).drop("__shift", part, row)


def surrogate_key(distinct_keys: DataFrame, order_col: str, out: str) -> DataFrame:
    """1..n in key order (NULL first) over a distinct set of any size.

    The keys are range-partitioned and sorted, each partition counts its own rows, and the counts before
    it are added: no task sees more than its range. The sorted keys are stored, so the counts and the
    numbers come from one partitioning.
    """
    ordered = (distinct_keys.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
               .withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}))
    return number_rows(written(ordered, "keys"), "__part", "__row", out)
