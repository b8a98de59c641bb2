"""Rolling features of the ML layer (D14; W3-W5, W9).

One window specification per frame, partitioned by grid and ordered by epoch seconds:
RANGE frames include both ends, so a 24 h frame spans 25 hourly points as in the
reference. A grid's partition holds its hours only (the fact has one row per grid-hour).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import epoch_seconds


def rolling_features(fact: DataFrame, recent: int = S.RECENT_HOURS, baseline: int = S.BASELINE_HOURS,
                     min_history: int = S.MIN_HISTORY_HOURS, key: str = "grid_id",
                     time: str = "timestamp") -> DataFrame:
    """Avg / growth / active hours / peak ratio / variability / internet share per grid-hour,
    kept where the trailing ``min_history`` h frame holds at least ``min_history`` rows."""
    if recent <= 0 or baseline <= 0:
        raise ValueError("window sizes must be greater than zero")
    if min_history < recent + baseline:
        raise ValueError("min_history must cover both windows")
    src = (fact.select(F.col(key).alias("grid_id"), F.col(time).alias("feature_timestamp"),
                       F.coalesce(F.col("total_activity"), F.lit(0.0)).alias("a"),
                       F.coalesce(F.col("internet_activity"), F.lit(0.0)).alias("i"))
           .withColumn("__t", epoch_seconds("feature_timestamp")))
    # One row per (grid, time): the first by activity, then internet, desc. Done inside the
    # same grid partitioning as the frames below, so it adds no shuffle.
    first_w = Window.partitionBy("grid_id").orderBy("__t", F.desc("a"), F.desc("i"))
    src = (src.withColumn("__prev_t", F.lag("__t").over(first_w))
           .where(F.col("__prev_t").isNull() | (F.col("__prev_t") != F.col("__t"))).drop("__prev_t"))
    by_time = Window.partitionBy("grid_id").orderBy("__t")
    recent_w = by_time.rangeBetween(-recent * 3600, 0)
    base_w = by_time.rangeBetween(-baseline * 3600, 0)
    hist_w = by_time.rangeBetween(-min_history * 3600, 0)
    staged = src.withColumns({
        "__shift": F.lag("a", recent).over(by_time),
        "__avg": F.avg("a").over(recent_w),
        "__peak": F.max("a").over(recent_w),
        "__std": F.stddev_samp("a").over(recent_w),
        "__active": F.sum(F.when(F.col("a") > 0, 1).otherwise(0)).over(recent_w),
        "__isum": F.sum("i").over(recent_w),
        "__asum": F.sum("a").over(recent_w),
        "__hist": F.count("a").over(hist_w),
    }).withColumn("__base", F.avg("__shift").over(base_w))
    avg, base = F.col("__avg"), F.col("__base")
    return staged.where(F.col("__hist") >= min_history).select(
        "grid_id", "feature_timestamp",
        avg.alias("avg_activity"),
        F.when(base == 0, F.lit(0.0)).otherwise((avg - base) / base).alias("activity_growth"),
        F.col("__active").cast("long").alias("active_hours"),
        F.when(avg != 0, F.col("__peak") / avg).otherwise(F.lit(0.0)).alias("peak_ratio"),
        F.coalesce(F.col("__std"), F.lit(0.0)).alias("variability"),
        F.when(F.col("__asum") != 0, F.col("__isum") / F.col("__asum")).otherwise(F.lit(0.0)).alias("internet_share"))
