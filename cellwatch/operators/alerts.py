"""Rule alerts (D6) and their checks.

One run of the reference covers one day, so the day is part of every partition: the
previous hour, the leave-one-out baseline and the activity floor are all per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import exact_sum, exact_sum_over, fmt4, round6
from cellwatch.operators.windows import leave_one_out_median, previous_value

DAY = ("grid_id", "date")


def activity_floor(dense: DataFrame, p: float = S.FLOOR_PERCENTILE) -> DataFrame:
    """Per date, the exact p-quantile of the grids' daily totals (bounded: one value per grid)."""
    daily = dense.groupBy("date", "grid_id").agg(exact_sum("total_activity").alias("daily_total"))
    return daily.groupBy("date").agg(F.percentile(F.col("daily_total"), F.lit(p)).alias("activity_floor"))


def baseline(dense: DataFrame) -> DataFrame:
    """W1 + W2 on the dense fact: previous hour, leave-one-out median and the daily total,
    all over the same (grid, date) partitioning (one exchange, at most 24 rows per window)."""
    from pyspark.sql import Window
    cols = dense.select("grid_id", "timestamp", "date", "total_activity")
    staged = leave_one_out_median(previous_value(cols, partition=DAY), partition=DAY)
    day = Window.partitionBy(*DAY)
    return staged.withColumn("daily_total", exact_sum_over("total_activity", day))


def rule_alerts(dense: DataFrame, high: float = S.HIGH_ACTIVITY_MULTIPLIER, drop: float = S.DROP_MULTIPLIER,
                spike: float = S.SPIKE_MULTIPLIER, floor_p: float = S.FLOOR_PERCENTILE) -> DataFrame:
    """HIGH_ACTIVITY / ACTIVITY_DROP / ACTIVITY_SPIKE rows in one pass (explode of a filtered array).

    Grids whose daily total is below that day's floor are skipped, rows without a baseline too.
    The floor has one row per date; AQE broadcasts it from its measured size, so the floor's
    aggregate runs once.
    """
    base = baseline(dense)
    floor = activity_floor(dense, floor_p).withColumnRenamed("activity_floor", "floor")
    eligible = (base.join(floor, "date")
                .where((F.col("daily_total") >= F.col("floor")) & F.col("baseline_activity").isNotNull()))
    cur, b, prev = F.col("total_activity"), F.col("baseline_activity"), F.col("previous_hour_activity")
    types = F.array(
        F.when((b > 0) & (cur >= F.lit(high) * b), F.lit("HIGH_ACTIVITY")),
        F.when((b > 0) & (cur <= F.lit(drop) * b), F.lit("ACTIVITY_DROP")),
        F.when(prev.isNotNull() & (prev > 0) & (cur >= F.lit(spike) * prev), F.lit("ACTIVITY_SPIKE")),
    )
    hits = (eligible
            .select("grid_id", "timestamp", "total_activity", "baseline_activity",
                    F.explode(F.filter(types, lambda t: t.isNotNull())).alias("alert_type")))
    c4, b4 = fmt4(cur), fmt4(b)
    reason = (F.when(F.col("alert_type") == "HIGH_ACTIVITY",
                     F.concat(F.lit("HIGH_ACTIVITY: current activity "), c4,
                              F.lit(" is at least 50% above the within-day baseline "), b4, F.lit(".")))
              .when(F.col("alert_type") == "ACTIVITY_DROP",
                    F.concat(F.lit("ACTIVITY_DROP: current activity "), c4,
                             F.lit(" is at or below 50% of the within-day baseline "), b4, F.lit(".")))
              .otherwise(F.concat(F.lit("ACTIVITY_SPIKE: current activity "), c4,
                                  F.lit(" increased by at least 50% from the preceding hour; within-day baseline is "),
                                  b4, F.lit("."))))
    return hits.select("grid_id", "timestamp", "alert_type",
                       F.col("total_activity").alias("current_activity"),
                       "baseline_activity", reason.alias("reason"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Per grid, alert rows, alerted hours and rows per type."""
    t = F.col("alert_type")
    return (alerts.groupBy("grid_id")
            .agg(F.count(F.lit(1)).alias("alerts"),
                 F.count_distinct("timestamp").alias("alerted_hours"),
                 F.sum(F.when(t == "HIGH_ACTIVITY", 1).otherwise(0)).alias("high_activity"),
                 F.sum(F.when(t == "ACTIVITY_DROP", 1).otherwise(0)).alias("activity_drop"),
                 F.sum(F.when(t == "ACTIVITY_SPIKE", 1).otherwise(0)).alias("activity_spike")))


def top_alerted_grids(alerts: DataFrame, n: int = 10) -> DataFrame:
    """K8: grids with most alerts, ties by grid id."""
    return (alerts.groupBy("grid_id").agg(F.count(F.lit(1)).alias("alerts"))
            .orderBy(F.desc("alerts"), F.asc("grid_id")).limit(n))


def alert_volume(alerts: DataFrame, evaluated: DataFrame, max_share: float = S.MAX_ALERT_SHARE) -> DataFrame:
    """Share of evaluated grid-hours with at least one alert; passes below ``max_share``."""
    alerted = alerts.select("grid_id", "timestamp").distinct().agg(F.count(F.lit(1)).alias("alerted_grid_hours"))
    total = evaluated.agg(F.count(F.lit(1)).alias("evaluated_rows")).select("evaluated_rows").scalar()
    return (alerted.withColumn("evaluated_rows", total)
            .withColumn("max_share", F.lit(max_share))
            .withColumn("passed", F.col("alerted_grid_hours") / F.col("evaluated_rows") < F.lit(max_share))
            .select("alerted_grid_hours", "evaluated_rows",
                    round6(F.col("alerted_grid_hours") / F.col("evaluated_rows")).alias("alert_share"),
                    "max_share", "passed"))


def reason_check(alerts: DataFrame) -> DataFrame:
    """Every reason names its type and both formatted values."""
    ok = (F.col("reason").contains(F.col("alert_type"))
          & F.col("reason").contains(fmt4(F.col("current_activity")))
          & F.col("reason").contains(fmt4(F.col("baseline_activity"))))
    return alerts.agg(F.count(F.lit(1)).alias("alerts"),
                      F.sum(F.when(ok, 1).otherwise(0)).alias("valid_reasons")) \
                 .withColumn("passed", F.col("alerts") == F.col("valid_reasons"))


def hours_per_grid_day(fact: DataFrame, expected: int = 24) -> DataFrame:
    """(grid, date) groups that do not have ``expected`` distinct hours."""
    return (fact.groupBy("grid_id", "date").agg(F.count_distinct("hour").alias("hours"))
            .where(F.col("hours") != expected))
