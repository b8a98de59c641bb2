"""Hour-of-day anomaly scores (D15; A14, A18, W6, P16, P17) and the three-way comparison
(D16; J9, J10, P18, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import fmt2, relative_deviation


def hour_of_day_baseline(fact: DataFrame, value: str = "total_activity") -> DataFrame:
    """Median per (grid, hour of day) attached to every row of the bucket.

    A whole-partition window over (grid, hour): one exchange, no join back. A bucket holds
    one value per day, so the window stays small however large the table is. The median
    covers every day of the bucket, the row's own day included (retrospective, as in the
    reference).
    """
    from pyspark.sql import Window
    src = (fact.where(F.col("grid_id").isNotNull() & F.col("timestamp").isNotNull() & F.col(value).isNotNull())
           .select("grid_id", "timestamp", F.hour("timestamp").alias("hour"), F.col(value).alias("total_activity")))
    bucket = Window.partitionBy("grid_id", "hour")
    return src.withColumns({"hour_of_day_baseline": F.median("total_activity").over(bucket),
                            "bucket_rows": F.count(F.lit(1)).over(bucket)})


def bucket_sizes(fact: DataFrame) -> DataFrame:
    """Observations per (grid, hour) bucket: min, max and buckets with several days."""
    b = fact.groupBy("grid_id", F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return b.agg(F.min("n").alias("min_observations"), F.max("n").alias("max_observations"),
                 F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("multi_day_buckets"))


def anomaly_scores(fact: DataFrame, threshold: float = S.ANOMALY_THRESHOLD) -> DataFrame:
    """Deviation from the hour-of-day median in percent, direction, flag and reason."""
    b = hour_of_day_baseline(fact)
    base = F.col("hour_of_day_baseline")
    dev = F.col("total_activity") - base
    score = relative_deviation(F.col("total_activity"), base)
    out = b.withColumns({"deviation": dev, "anomaly_score": score})
    s = F.col("anomaly_score")
    direction = F.when(s >= threshold, "HIGH").when(s <= -threshold, "LOW").otherwise("NORMAL")
    out = out.withColumn("direction", direction)
    reason = (F.when(F.col("direction") == "HIGH",
                     F.concat(F.lit("Current activity is "), fmt2(s),
                              F.lit("% above the historical hour-of-day baseline")))
              .when(F.col("direction") == "LOW",
                    F.concat(F.lit("Current activity is "), fmt2(F.abs(s)),
                             F.lit("% below the historical hour-of-day baseline")))
              .otherwise(F.lit("Activity is within the historical hour-of-day baseline range")))
    return out.select("grid_id", "timestamp", "hour", "total_activity", "hour_of_day_baseline", "deviation",
                      "anomaly_score", "direction",
                      (F.col("direction") != "NORMAL").cast("int").alias("anomaly_flag"),
                      reason.alias("reason"))


def extreme_cases(scores: DataFrame, n: int = 2) -> DataFrame:
    """K7: the n highest HIGH and the n lowest LOW scores (two top-k, then a union)."""
    cols = ["grid_id", "timestamp", "total_activity", "hour_of_day_baseline", "anomaly_score", "reason", "direction"]
    high = (scores.where(F.col("direction") == "HIGH")
            .orderBy(F.desc("anomaly_score"), "grid_id", "timestamp").limit(n).select(*cols))
    low = (scores.where(F.col("direction") == "LOW")
           .orderBy(F.asc("anomaly_score"), "grid_id", "timestamp").limit(n).select(*cols))
    return high.unionByName(low)


def presence_flag(keys: DataFrame, key_cols, out: str) -> DataFrame:
    """J9 helper: distinct keys with a constant 1 flag, for a left join + coalesce(0)."""
    return keys.select(*key_cols).distinct().withColumn(out, F.lit(1))


def three_way(scores: DataFrame, alerts: DataFrame, predictions: DataFrame,
              prediction_col: str = "model_prediction") -> DataFrame:
    """Anomaly flag vs rule alert vs model flag on (grid, timestamp), with a category."""
    np3 = presence_flag(alerts, ["grid_id", "timestamp"], "np3_alert")
    w = predictions.select("grid_id", F.col("feature_timestamp").alias("timestamp"),
                           F.col(prediction_col).cast("int").alias("ml3_flag"))
    ml3 = w.groupBy("grid_id", "timestamp").agg(F.max("ml3_flag").alias("ml3_flag"))
    j = (scores.select("grid_id", "timestamp", "anomaly_flag")
         .join(np3, ["grid_id", "timestamp"], "left")
         .join(ml3, ["grid_id", "timestamp"], "left")
         .withColumns({"np3_alert": F.coalesce(F.col("np3_alert"), F.lit(0)),
                       "ml3_flag": F.coalesce(F.col("ml3_flag"), F.lit(0))}))
    a, n, m = F.col("anomaly_flag"), F.col("np3_alert"), F.col("ml3_flag")
    cat = F.lit(S.DISAGREEMENT_DEFAULT)
    for (fa, fn, fm), name in reversed(S.DISAGREEMENT_CATEGORIES):
        cat = F.when((a == fa) & (n == fn) & (m == fm), F.lit(name)).otherwise(cat)
    return j.select("grid_id", "timestamp", F.col("anomaly_flag").alias("anomaly_alert"),
                    F.col("np3_alert").cast("int").alias("np3_alert"), F.col("ml3_flag").cast("int").alias("ml3_flag"),
                    ((a == n) & (a == m)).alias("all_agree"), cat.alias("disagreement_type"))
