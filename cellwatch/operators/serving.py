"""Point-in-time queries (D9-D13), for every grid at once.

``as_of`` defaults to the latest timestamp of the data, evaluated once as a scalar
subquery. Every as-of filter is a plain predicate on the timestamp (and the date, so a
date-partitioned table prunes partitions).
"""

from __future__ import annotations

from datetime import date as Date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import exact_sum, guarded_ratio, ntz_literal, severity_band
from cellwatch.operators.windows import trailing_rows


def effective_as_of(rows: DataFrame, as_of: datetime | None = None, date: Date | None = None,
                    hour: int | None = None, time: str = "timestamp") -> Column:
    """The as-of instant: given, else max(timestamp); optionally moved to ``date`` / ``hour`` (Q6)."""
    t = ntz_literal(as_of) if as_of is not None else rows.select(F.max(time)).scalar()
    if date is not None:
        t = F.make_timestamp_ntz(F.lit(date.year), F.lit(date.month), F.lit(date.day),
                                 F.hour(t), F.minute(t), F.second(t))
    if hour is not None:
        t = F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.lit(hour), F.minute(t), F.second(t))
    return t


def as_of_rows(rows: DataFrame, t: Column, time: str = "timestamp") -> DataFrame:
    """Rows at or before ``t``; the redundant date predicate lets date partitions prune."""
    cond = F.col(time) <= t
    if "date" in rows.columns:
        cond = cond & (F.col("date") <= F.to_date(t))
    return rows.where(cond)


def network_summary(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Total activity, active grids, peak hour of day and top grid as of ``as_of``.

    One scan: grouping sets (hour), (grid_id) and () in a single aggregate, then a one-row
    pick over that small result (at most 24 + grids + 1 rows). Ties: smallest hour / grid.
    """
    t = effective_as_of(rows, as_of)
    cur = as_of_rows(rows, t)
    g = cur.groupingSets([["hour"], ["grid_id"], []], "hour", "grid_id").agg(
        exact_sum("total_activity").alias("v"), F.grouping_id().alias("gid"))
    # gid: 1 = grouped by hour (grid_id aggregated away), 2 = by grid_id, 3 = grand total
    by_hour, by_grid = F.col("gid") == 1, F.col("gid") == 2
    best_hour = F.max(F.when(by_hour, F.struct(F.col("v"), (-F.col("hour")).alias("k"))))
    best_grid = F.max(F.when(by_grid, F.struct(F.col("v"), (-F.col("grid_id")).alias("k"))))
    return g.agg(F.max(F.when(F.col("gid") == 3, F.col("v"))).alias("total_activity"),
                 F.count(F.when(by_grid, F.lit(1))).alias("active_grids"),
                 best_hour.alias("h"), best_grid.alias("g")) \
            .select(t.alias("as_of"), "total_activity", "active_grids",
                    (-F.col("h.k")).cast("int").alias("peak_hour"), (-F.col("g.k")).cast("int").alias("top_grid"))


def grid_activity(rows: DataFrame, grid_id: int | None = None, as_of: datetime | None = None,
                  date: Date | None = None, hour: int | None = None) -> DataFrame:
    """Trailing 24 hourly points up to as-of (all grids, or one), totals recomputed with
    NULL measures as 0 and the guarded internet share."""
    t = effective_as_of(rows, as_of, date, hour)
    cur = rows if grid_id is None else rows.where(F.col("grid_id") == grid_id)
    cur = trailing_rows(cur, t)
    m = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in S.MEASURES}
    out = cur.select("grid_id", "timestamp", *[m[c].alias(c) for c in S.MEASURES])
    out = out.withColumns({"total_sms": F.col("sms_in") + F.col("sms_out"),
                           "total_calls": F.col("call_in") + F.col("call_out")})
    out = out.withColumn("total_activity", F.col("total_sms") + F.col("total_calls") + F.col("internet_activity"))
    return out.withColumn("internet_share", guarded_ratio(F.col("internet_activity"), F.col("total_activity")))


def _ranked_items(rows: DataFrame, limit: int, severity: str | None, as_of, bands, filter_first: bool,
                  reasons: dict) -> DataFrame:
    if severity is not None and severity.lower() not in reasons:
        raise ValueError(f"invalid severity {severity!r}")
    t = effective_as_of(rows, as_of)
    total = F.coalesce(F.col("total_activity"), F.lit(0.0))
    cur = as_of_rows(rows, t).withColumn("severity", severity_band(total, bands))
    order = [F.desc("total_activity"), F.asc("grid_id"), F.asc("timestamp")]
    if severity is not None and filter_first:
        cur = cur.where(F.col("severity") == severity.lower()).orderBy(*order).limit(limit)
    else:
        cur = cur.orderBy(*order).limit(limit)
        if severity is not None:  # the reference filters after the limit (Q7)
            cur = cur.where(F.col("severity") == severity.lower())
    reason = F.lit(None).cast("string")
    for level in ("critical", "high", "medium", "low"):
        reason = F.when(F.col("severity") == level, F.lit(reasons[level])).otherwise(reason)
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return cur.select(F.col("grid_id").cast("int").alias("grid_id"), "timestamp",
                      total.alias("total_activity"),
                      (z("sms_in") + z("sms_out")).alias("sms_activity"),
                      (z("call_in") + z("call_out")).alias("call_activity"),
                      z("internet_activity").alias("internet_activity"),
                      F.when(F.col("severity") != "low", "hotspot").otherwise("normal").alias("status"),
                      "severity", reason.alias("reason"))


def hotspots(rows: DataFrame, limit: int = 10, severity: str | None = None, as_of=None,
             bands=S.SEVERITY_BANDS, filter_first: bool = False) -> DataFrame:
    """The ``limit`` largest grid-hours as of ``as_of`` with severity and status."""
    return _ranked_items(rows, limit, severity, as_of, bands, filter_first, S.HOTSPOT_REASONS)


def severity_alerts(rows: DataFrame, limit: int = 10, severity: str | None = None, as_of=None,
                    bands=S.SEVERITY_BANDS, filter_first: bool = False) -> DataFrame:
    """Same ranking as D11 with the alert texts."""
    return _ranked_items(rows, limit, severity, as_of, bands, filter_first, S.ALERT_REASONS)


def point_features(rows: DataFrame, as_of: datetime | None = None, stale_hours: int = 3) -> DataFrame:
    """Per grid, features over its trailing 24 h rows up to as-of, with quality labels.

    growth = last value vs mean of the earlier rows; variability = population std / mean.
    """
    t = effective_as_of(rows, as_of)
    cur = trailing_rows(rows, t).select(
        "grid_id", "timestamp",
        F.coalesce(F.col("total_activity"), F.lit(0.0)).alias("a"),
        F.coalesce(F.col("internet_activity"), F.lit(0.0)).alias("i"))
    g = cur.groupBy("grid_id").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("a").alias("s"), F.max("a").alias("peak"),
        F.sum(F.when(F.col("a") > 0, 1).otherwise(0)).alias("active_hours"),
        exact_sum("i").alias("si"), F.stddev_pop("a").alias("sd"),
        F.max_by("a", "timestamp").alias("last"), F.max("timestamp").alias("feature_timestamp"))
    avg = F.col("s") / F.col("n")
    prev_avg = (F.col("s") - F.col("last")) / (F.col("n") - 1)
    growth = F.when((F.col("n") >= 2) & (prev_avg > 0), (F.col("last") - prev_avg) / prev_avg).otherwise(0.0)
    variability = F.when((F.col("n") > 1) & (avg > 0), F.col("sd") / avg).otherwise(0.0)
    lag_s = F.timestamp_diff("SECOND", F.col("feature_timestamp"), t)
    freshness = (F.when(F.col("feature_timestamp") >= t, "fresh")
                 .when(lag_s <= stale_hours * 3600, "stale").otherwise("very_stale"))
    return g.select(
        "grid_id", "feature_timestamp",
        F.round(avg, 6).alias("avg_activity"),
        F.round(growth, 6).alias("activity_growth"),
        F.col("active_hours").cast("int").alias("active_hours"),
        F.round(guarded_ratio(F.col("peak"), avg), 6).alias("peak_ratio"),
        F.round(variability, 6).alias("variability"),
        F.round(guarded_ratio(F.col("si"), F.col("s")), 6).alias("internet_share"),
        F.when(F.col("n") < 24, "incomplete").otherwise("valid").alias("data_quality"),
        freshness.alias("feature_freshness"))
