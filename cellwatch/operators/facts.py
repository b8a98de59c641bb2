"""Hourly grid fact and the aggregates over it.

Sums keep the full precision of their inputs (see ``functions.columns.exact_sum``); every
aggregate is a hash aggregate with map-side partial aggregation, so a hot grid or a hot
hour is collapsed before the shuffle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import day_floor, exact_sum, round6
from cellwatch.functions.quantiles import order_statistic


def hourly_grid_summary(clean: DataFrame) -> DataFrame:
    """D3 / A1: exactly one row per (timestamp, grid_id); no country_code, no geometry."""
    summed = clean.groupBy(*S.FACT_KEY).agg(*[exact_sum(m).alias(m) for m in S.MEASURES])
    return finish_fact(summed)


_FACT_EXPRS = {
    "timestamp": "`timestamp`", "grid_id": "grid_id", "sms_in": "sms_in", "sms_out": "sms_out",
    "call_in": "call_in", "call_out": "call_out",
    "total_sms": "sms_in + sms_out AS total_sms", "total_calls": "call_in + call_out AS total_calls",
    "internet_activity": "internet_activity",
    "total_activity": "(sms_in + sms_out) + (call_in + call_out) + internet_activity AS total_activity",
    "internet_share": ("CASE WHEN (sms_in + sms_out) + (call_in + call_out) + internet_activity > 0 "
                       "THEN internet_activity / ((sms_in + sms_out) + (call_in + call_out) + internet_activity) "
                       "ELSE 0D END AS internet_share"),
    "hour": "hour(`timestamp`) AS hour", "day_of_week": "dayofweek(`timestamp`) AS day_of_week",
    "date": "to_date(`timestamp`) AS date",
}


def finish_fact(summed: DataFrame) -> DataFrame:
    """P7-P10 on a (timestamp, grid_id, 5 measures) frame: totals, share, time parts, order."""
    return summed.selectExpr(*[_FACT_EXPRS[c] for c in S.FACT_COLUMNS])


def day_bounds(fact: DataFrame, ts: str = "timestamp"):
    """(first day 00:00, last day 23:00) as fields of ONE scalar subquery (evaluated once)."""
    b = fact.select(F.struct(
        F.expr(day_floor(f"min({ts})")).alias("lo"),
        F.expr(day_floor(f"max({ts})") + " + INTERVAL 23 HOURS").alias("hi"))).scalar()
    return b["lo"], b["hi"]


def plausible_span(fact: DataFrame, share: float = 0.05, reach: float = 3.0):
    """First and last plausible date of a table, from the mass of its rows; None for no rows.

    The dates below which ``share`` of the rows lie, and above which ``share`` do, bound the bulk (at least one
    row is left out on each side where there are three); the span is the bulk and ``reach`` times its days on both sides.
    """
    days = fact.where(F.col("date").isNotNull()).select(F.datediff("date", F.lit(_FIRST_DAY)).alias("d"))
    n = days.agg(F.count(F.lit(1))).first()[0]
    if not n:
        return None
    cut = min(max(int(share * n), 1), (n - 1) // 2)
    low, high = order_statistic(days, "d", cut), order_statistic(days, "d", n - 1 - cut)
    margin = int(reach * (high - low + 1))
    return _day(low - margin), _day(high + margin)


_FIRST_DAY = date(1970, 1, 1)


def _day(number: int) -> date:
    """The date of a day number, kept within the calendar."""
    return date.fromordinal(min(max(_FIRST_DAY.toordinal() + number, 1), date.max.toordinal()))


def span_findings(fact: DataFrame, span) -> DataFrame:
    """D4 gate: rows dated outside the plausible span (they are kept, but multiply nothing)."""
    from cellwatch.operators.quality import _finding
    inside = F.col("date").between(F.lit(span[0]), F.lit(span[1])) if span else F.lit(True)
    return fact.agg(F.count_if(~F.coalesce(inside, F.lit(False))).alias("n")).select(
        *_finding("plausible_dates", F.col("n") == 0, F.col("n"), "0"))


def densify_hours(fact: DataFrame, span=None, by_grid: bool = False) -> DataFrame:
    """Every grid x every hour from the first day 00:00 to the last day 23:00, 0-filled.

    Each distinct grid generates its own hour sequence (a generator, no cross join); the
    result is bounded by grids x hours and is left-joined to the fact on the full key. With a ``span``
    (see ``plausible_span``) only its days are filled; rows outside come through as they are. With
    ``by_grid`` a grid's hours run between its own first and last day.
    """
    inside = fact if span is None else fact.where(F.col("date").between(F.lit(span[0]), F.lit(span[1])))
    if by_grid:
        bounds = inside.groupBy("grid_id").agg(F.expr(day_floor("min(`timestamp`)")).alias("lo"),
                                               (F.expr(day_floor("max(`timestamp`)")) + F.expr("INTERVAL 23 HOURS")).alias("hi"))
        grids, lo, hi = bounds, F.col("lo"), F.col("hi")
    else:
        grids = inside.select("grid_id").distinct()
        lo, hi = day_bounds(inside)
    skeleton = grids.select("grid_id", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("timestamp"))
    joined = skeleton.join(inside.select(*S.FACT_KEY, *S.MEASURES), on=S.FACT_KEY, how="left")
    filled = finish_fact(joined.withColumns({m: F.coalesce(F.col(m), F.lit(0.0)) for m in S.MEASURES}))
    if span is None:
        return filled
    return filled.unionByName(fact.where(~F.col("date").between(F.lit(span[0]), F.lit(span[1]))).select(*S.FACT_COLUMNS))


def daily_grid_summary(fact: DataFrame) -> DataFrame:
    """A2: sums by (date, grid_id); active_hours = number of fact rows."""
    return (fact.groupBy("date", "grid_id")
            .agg(*[exact_sum(c).alias(c) for c in ["total_sms", "total_calls", "internet_activity", "total_activity"]],
                 F.count(F.lit(1)).alias("active_hours")))


def daily_kpi(fact: DataFrame) -> DataFrame:
    """A3: totals and distinct grids by date."""
    return (fact.groupBy("date")
            .agg(exact_sum("total_sms").alias("total_sms"),
                 exact_sum("total_calls").alias("total_calls"),
                 exact_sum("total_activity").alias("total_activity"),
                 exact_sum("internet_activity").alias("total_internet"),
                 F.count_distinct("grid_id").alias("unique_grids")))


def grid_kpi(fact: DataFrame) -> DataFrame:
    """A4: totals and distinct hours of day by grid."""
    return (fact.groupBy("grid_id")
            .agg(exact_sum("total_sms").alias("total_sms"),
                 exact_sum("total_calls").alias("total_calls"),
                 exact_sum("total_activity").alias("total_activity"),
                 exact_sum("internet_activity").alias("total_internet"),
                 F.count_distinct("hour").alias("active_hours")))


def dashboard_summary(fact: DataFrame) -> DataFrame:
    """A5: by date, sums, mean internet share and active grids."""
    return (fact.groupBy("date")
            .agg(exact_sum("total_sms").alias("total_sms"),
                 exact_sum("total_calls").alias("total_calls"),
                 exact_sum("internet_activity").alias("internet_activity"),
                 exact_sum("total_activity").alias("total_activity"),
                 round6(F.avg("internet_share")).alias("average_internet_share"),
                 F.count_distinct("grid_id").alias("active_grids")))


def hourly_trend(fact: DataFrame) -> DataFrame:
    """Network-wide totals per timestamp."""
    return (fact.groupBy("timestamp")
            .agg(exact_sum("total_sms").alias("total_sms"),
                 exact_sum("total_calls").alias("total_calls"),
                 exact_sum("internet_activity").alias("internet_activity"),
                 exact_sum("total_activity").alias("total_activity"),
                 F.count(F.lit(1)).alias("active_grids")))


def internet_heavy_windows(fact: DataFrame, n: int = 20) -> DataFrame:
    """Timestamps with the highest internet share of total activity (total > 0), top n."""
    t = (fact.groupBy("timestamp")
         .agg(exact_sum("internet_activity").alias("internet_activity"),
              exact_sum("total_activity").alias("total_activity"))
         .where(F.col("total_activity") > 0)
         .withColumn("internet_share", F.col("internet_activity") / F.col("total_activity")))
    # Ranked by the raw share; only the output is rounded.
    top = t.orderBy(F.desc("internet_share"), F.asc("timestamp")).limit(n)
    return top.withColumn("internet_share", round6(F.col("internet_share")))


def top_grids(fact: DataFrame, n: int = 10) -> DataFrame:
    """K1: grids by total activity, ties broken by grid id; a TakeOrderedAndProject top-k."""
    g = (fact.groupBy("grid_id")
         .agg(exact_sum("total_activity").alias("total_activity"),
              exact_sum("total_sms").alias("total_sms"),
              exact_sum("total_calls").alias("total_calls"),
              exact_sum("internet_activity").alias("internet_activity")))
    return g.orderBy(F.desc("total_activity"), F.asc("grid_id")).limit(n)


def peak_hour(fact: DataFrame) -> DataFrame:
    """Hour of day with the largest total activity, and that total."""
    by_hour = fact.groupBy("hour").agg(exact_sum("total_activity").alias("total_activity"))
    best = by_hour.agg(F.max(F.struct(F.col("total_activity").alias("v"), (-F.col("hour")).alias("k"))).alias("b"))
    return best.select((-F.col("b.k")).cast("int").alias("peak_hour"), F.col("b.v").alias("total_activity"))


def peak_timestamp(fact: DataFrame) -> DataFrame:
    """K3 (timestamp form): the single busiest timestamp network-wide."""
    by_ts = fact.groupBy("timestamp").agg(exact_sum("total_activity").alias("total_activity"))
    return by_ts.orderBy(F.desc("total_activity"), F.asc("timestamp")).limit(1)


def busiest_grid(fact: DataFrame) -> DataFrame:
    """K4: grid with the largest total activity (smallest id on ties)."""
    by_grid = fact.groupBy("grid_id").agg(exact_sum("total_activity").alias("total_activity"))
    best = by_grid.agg(F.max(F.struct(F.col("total_activity").alias("v"), (-F.col("grid_id")).alias("k"))).alias("b"))
    return best.select((-F.col("b.k")).cast("int").alias("grid_id"), F.col("b.v").alias("total_activity"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def dataset_profile(activity: DataFrame, approximate: bool = False) -> DataFrame:
    """A10: profile of canonical activity (rows, distincts, range, NULLs, negatives, exact duplicate
    rows). Rows are grouped as a whole once; everything else is computed from their counts.
    ``approximate`` swaps the exact distincts of single columns for HLL sketches."""
    cd = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.count_distinct(c))
    activity = activity.groupBy(*activity.columns).agg(F.count(F.lit(1)).alias("_n"))
    aggs = [F.sum("_n").alias("rows"),
            cd("grid_id").alias("distinct_grids"),
            cd("country_code").alias("distinct_countries"),
            cd("timestamp").alias("distinct_timestamps"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp")]
    for m in S.MEASURES:
        aggs.append(F.sum(F.when(F.col(m).isNull(), F.col("_n")).otherwise(0)).alias(f"null_{m}"))
    for m in S.MEASURES:
        aggs.append(F.sum(F.when(F.col(m) < 0, F.col("_n")).otherwise(0)).alias(f"negative_{m}"))
    aggs.append(F.sum(F.col("_n") - 1).alias("duplicate_rows"))
    return activity.agg(*aggs)


def null_profile(df: DataFrame) -> DataFrame:
    """NULL cells per column from a single aggregate, unpivoted to (column_name, null_cells)."""
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c) for c in df.columns],
                  F.count(F.lit(1)).alias("__rows"))
    return (wide.unpivot("__rows", list(df.columns), "column_name", "null_cells")
            .withColumnRenamed("__rows", "total_rows"))


def source_report(activity: DataFrame, source_col: str = "date") -> DataFrame:
    """Per source (daily file = date): rows and distinct grids / timestamps / countries."""
    return (activity.groupBy(source_col)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_distinct("grid_id").alias("distinct_grids"),
                 F.count_distinct("timestamp").alias("distinct_timestamps"),
                 F.count_distinct("country_code").alias("distinct_countries")))


def duplicate_grain(df: DataFrame, key=S.FACT_KEY) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))
