"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus its oracle SQL.

Every query reads the test tables (through the adapters) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.operators import facts as Fa
from cellwatch.plans import oracle as O
from cellwatch.plans import pipeline as P
from cellwatch.plans.oracle import sql
from cellwatch.sources import fixtures as X

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _dsum(c: str, alias: str | None = None) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) AS {alias or c}"


# ---------------------------------------------------------------- cleaning

@register("clean_activity", sql("""
SELECT timestamp, grid_id, country_code,
       coalesce(sms_in, 0.0) AS sms_in, coalesce(sms_out, 0.0) AS sms_out,
       coalesce(call_in, 0.0) AS call_in, coalesce(call_out, 0.0) AS call_out,
       coalesce(internet_activity, 0.0) AS internet_activity,
       coalesce(sms_in, 0.0) + coalesce(sms_out, 0.0) AS total_sms,
       coalesce(call_in, 0.0) + coalesce(call_out, 0.0) AS total_calls,
       (coalesce(sms_in, 0.0) + coalesce(sms_out, 0.0)) + (coalesce(call_in, 0.0) + coalesce(call_out, 0.0))
         + coalesce(internet_activity, 0.0) AS total_activity,
       CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week
FROM dirty_tagged WHERE reject_reason IS NULL""", "dirty_tagged"))
def q_clean_activity(spark, sf_dir):
    return P.clean_split(spark, sf_dir)[0]


@register("rejected_activity", sql("""
SELECT event_id, source_file, timestamp, grid_id, country_code, sms_in, sms_out, call_in, call_out,
       internet_activity, reject_reason
FROM dirty_tagged WHERE reject_reason IS NOT NULL""", "dirty_tagged"))
def q_rejected_activity(spark, sf_dir):
    return P.clean_split(spark, sf_dir)[1]


@register("cleaning_counts", sql("""
SELECT count(*) AS input_rows,
       CAST(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS clean_rows,
       CAST(sum(CASE WHEN reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows,
       CAST(sum(CASE WHEN reject_reason = 'invalid_timestamp' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_timestamp_rows,
       CAST(sum(CASE WHEN reject_reason = 'invalid_grid_id' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_grid_rows,
       CAST(sum(CASE WHEN reject_reason = 'negative_activity' THEN 1 ELSE 0 END) AS BIGINT) AS negative_activity_rows,
       CAST(sum(CASE WHEN reject_reason IS NULL AND (sms_in IS NULL OR sms_out IS NULL OR call_in IS NULL
                 OR call_out IS NULL OR internet_activity IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS clean_rows_null_filled
FROM dirty_tagged""", "dirty_tagged"))
def q_cleaning_counts(spark, sf_dir):
    return P.clean_split(spark, sf_dir)[2]


# ---------------------------------------------------------------- fact and KPIs

@register("hourly_grid_summary", sql("SELECT * FROM fact", "fact"))
def q_hourly_grid_summary(spark, sf_dir):
    return P.fact(spark, sf_dir)


@register("dense_hours", sql("SELECT * FROM dense", "dense"))
def q_dense_hours(spark, sf_dir):
    return P.dense_fact(spark, sf_dir)


@register("daily_grid_summary", sql(f"""
SELECT date, grid_id, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('internet_activity')},
       {_dsum('total_activity')}, count(*) AS active_hours
FROM fact GROUP BY date, grid_id""", "fact"))
def q_daily_grid_summary(spark, sf_dir):
    return Fa.daily_grid_summary(P.fact_table(spark, sf_dir))


@register("daily_kpi", sql(f"""
SELECT date, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('total_activity')},
       {_dsum('internet_activity', 'total_internet')}, count(DISTINCT grid_id) AS unique_grids
FROM fact GROUP BY date""", "fact"))
def q_daily_kpi(spark, sf_dir):
    return Fa.daily_kpi(P.fact_table(spark, sf_dir))


@register("grid_kpi", sql(f"""
SELECT grid_id, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('total_activity')},
       {_dsum('internet_activity', 'total_internet')}, count(DISTINCT hour) AS active_hours
FROM fact GROUP BY grid_id""", "fact"))
def q_grid_kpi(spark, sf_dir):
    return Fa.grid_kpi(P.fact_table(spark, sf_dir))


@register("dashboard_summary", sql(f"""
SELECT date, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('internet_activity')},
       {_dsum('total_activity')}, round(avg(internet_share), 6) AS average_internet_share,
       count(DISTINCT grid_id) AS active_grids
FROM fact GROUP BY date""", "fact"))
def q_dashboard_summary(spark, sf_dir):
    return Fa.dashboard_summary(P.fact_table(spark, sf_dir))


@register("hourly_trend", sql(f"""
SELECT timestamp, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('internet_activity')},
       {_dsum('total_activity')}, count(*) AS active_grids
FROM fact GROUP BY timestamp""", "fact"))
def q_hourly_trend(spark, sf_dir):
    return Fa.hourly_trend(P.fact_table(spark, sf_dir))


@register("internet_heavy_windows", sql(f"""
SELECT timestamp, internet_activity, total_activity,
       round(internet_activity / total_activity, 6) AS internet_share
FROM (SELECT timestamp, {_dsum('internet_activity')}, {_dsum('total_activity')} FROM fact GROUP BY timestamp)
WHERE total_activity > 0
ORDER BY internet_activity / total_activity DESC, timestamp LIMIT 20""", "fact"))
def q_internet_heavy_windows(spark, sf_dir):
    return Fa.internet_heavy_windows(P.fact_table(spark, sf_dir))


@register("top_grids", sql(f"""
SELECT grid_id, {_dsum('total_activity')}, {_dsum('total_sms')}, {_dsum('total_calls')},
       {_dsum('internet_activity')}
FROM fact GROUP BY grid_id ORDER BY total_activity DESC, grid_id LIMIT 10""", "fact"))
def q_top_grids(spark, sf_dir):
    return Fa.top_grids(P.fact_table(spark, sf_dir))


@register("peak_hour", sql(f"""
SELECT hour AS peak_hour, total_activity
FROM (SELECT hour, {_dsum('total_activity')} FROM fact GROUP BY hour)
ORDER BY total_activity DESC, hour LIMIT 1""", "fact"))
def q_peak_hour(spark, sf_dir):
    return Fa.peak_hour(P.fact_table(spark, sf_dir))


@register("busiest_grid", sql(f"""
SELECT grid_id, total_activity
FROM (SELECT grid_id, {_dsum('total_activity')} FROM fact GROUP BY grid_id)
ORDER BY total_activity DESC, grid_id LIMIT 1""", "fact"))
def q_busiest_grid(spark, sf_dir):
    return Fa.busiest_grid(P.fact_table(spark, sf_dir))


# ---------------------------------------------------------------- profiles

_MEAS = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity"]


@register("dataset_profile", sql(
    "SELECT count(*) AS rows, count(DISTINCT grid_id) AS distinct_grids, "
    "count(DISTINCT country_code) AS distinct_countries, count(DISTINCT timestamp) AS distinct_timestamps, "
    "min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp, "
    + ", ".join(f"CAST(sum(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{m}" for m in _MEAS) + ", "
    + ", ".join(f"CAST(sum(CASE WHEN {m} < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_{m}" for m in _MEAS) + ", "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM activity_raw)) AS duplicate_rows "
    "FROM activity_raw", "activity_raw"))
def q_dataset_profile(spark, sf_dir):
    return Fa.dataset_profile(P.canonical_raw(spark, sf_dir))


_TYPED_COLS = ["event_id", "timestamp", "grid_id", "country_code", *_MEAS]


@register("null_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_cells, "
    f"count(*) AS total_rows FROM dirty_typed" for c in _TYPED_COLS), "dirty_typed"))
def q_null_profile(spark, sf_dir):
    from cellwatch.operators import clean as C
    typed = C.typed_columns(C.rename_canonical(P.dirty_activity(spark, sf_dir)))
    return Fa.null_profile(typed.select(*_TYPED_COLS))


@register("file_or_source_report", sql("""
SELECT CAST(timestamp AS DATE) AS date, count(*) AS rows, count(DISTINCT grid_id) AS distinct_grids,
       count(DISTINCT timestamp) AS distinct_timestamps, count(DISTINCT country_code) AS distinct_countries
FROM activity_raw GROUP BY 1""", "activity_raw"))
def q_source_report(spark, sf_dir):
    raw = P.canonical_raw(spark, sf_dir)
    return Fa.source_report(raw.withColumn("date", F.to_date("timestamp")))


@register("duplicate_grain", sql("""
SELECT timestamp, grid_id, count(*) AS rows FROM activity_raw GROUP BY timestamp, grid_id HAVING count(*) > 1""",
    "activity_raw"))
def q_duplicate_grain(spark, sf_dir):
    return Fa.duplicate_grain(P.canonical_raw(spark, sf_dir))


@register("country_counts", sql("SELECT country_code, count(*) AS rows FROM activity_raw GROUP BY country_code",
                                "activity_raw"))
def q_country_counts(spark, sf_dir):
    return Fa.value_counts(P.canonical_raw(spark, sf_dir), "country_code")


# ---------------------------------------------------------------- cadence and completeness

from cellwatch.functions.columns import round6  # noqa: E402
from cellwatch.operators import alerts as Al  # noqa: E402
from cellwatch.operators import quality as Q  # noqa: E402
from cellwatch.operators import windows as Wi  # noqa: E402


@register("missing_hours", sql("""
SELECT CAST(h AS TIMESTAMP) AS missing_timestamp
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
      FROM (SELECT date_trunc('day', min(timestamp)) AS lo,
                   CAST(date_trunc('day', max(timestamp)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi FROM activity_raw))
WHERE CAST(h AS TIMESTAMP) NOT IN (SELECT timestamp FROM activity_raw WHERE timestamp IS NOT NULL)""",
    "activity_raw"))
def q_missing_hours(spark, sf_dir):
    return Q.missing_hours(P.canonical_raw(spark, sf_dir))


@register("missing_grid_hours", sql("""
SELECT s.grid_id, s.timestamp FROM skeleton s
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.grid_id = s.grid_id AND f.timestamp = s.timestamp)""",
    "skeleton", "fact"))
def q_missing_grid_hours(spark, sf_dir):
    return Q.missing_grid_hours(P.fact_table(spark, sf_dir))


@register("cadence_check", sql("""
SELECT date, count(*) AS timestamps, max(gap) AS max_gap_seconds,
       count(*) = 24 AND coalesce(max(gap), 3600) = 3600 AS passed
FROM (SELECT CAST(timestamp AS DATE) AS date,
             CAST(epoch(timestamp) - epoch(lag(timestamp) OVER (PARTITION BY CAST(timestamp AS DATE) ORDER BY timestamp))
                  AS BIGINT) AS gap
      FROM (SELECT DISTINCT timestamp FROM activity_raw WHERE timestamp IS NOT NULL))
GROUP BY date""", "activity_raw"))
def q_cadence_check(spark, sf_dir):
    return Q.cadence_check(P.canonical_raw(spark, sf_dir))


@register("incomplete_grid_days", sql("""
SELECT grid_id, date, count(DISTINCT hour) AS hours FROM fact GROUP BY grid_id, date
HAVING count(DISTINCT hour) <> 24""", "fact"))
def q_incomplete_grid_days(spark, sf_dir):
    return Al.hours_per_grid_day(P.fact_table(spark, sf_dir))


# ---------------------------------------------------------------- rule alerts

@register("previous_hour", sql("""
SELECT grid_id, timestamp, total_activity, previous_hour_activity FROM dense_base""", "dense_base"))
def q_previous_hour(spark, sf_dir):
    d = P.dense_fact(spark, sf_dir).select("grid_id", "timestamp", "date", "total_activity")
    return Wi.previous_value(d).drop("date")


@register("leave_one_out_baseline", sql("""
SELECT grid_id, timestamp, round(baseline_activity, 6) AS baseline_activity FROM loo""", "loo"))
def q_leave_one_out_baseline(spark, sf_dir):
    d = P.dense_fact(spark, sf_dir).select("grid_id", "timestamp", "date", "total_activity")
    return (Wi.leave_one_out_median(d)
            .select("grid_id", "timestamp", round6(F.col("baseline_activity")).alias("baseline_activity")))


@register("activity_floor", sql("""
SELECT date, round(floor, 6) AS activity_floor FROM floors""", "floors"))
def q_activity_floor(spark, sf_dir):
    f = Al.activity_floor(P.dense_fact(spark, sf_dir))
    return f.withColumn("activity_floor", round6(F.col("activity_floor")))


def _alerts(spark, sf_dir):
    return Al.rule_alerts(P.dense_fact(spark, sf_dir))


@register("rule_alerts", sql("""
SELECT grid_id, timestamp, alert_type, current_activity, round(baseline_activity, 6) AS baseline_activity, reason
FROM alerts""", "alerts"))
def q_rule_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).withColumn("baseline_activity", round6(F.col("baseline_activity")))


@register("alert_counts", sql("""
SELECT grid_id, count(*) AS alerts, count(DISTINCT timestamp) AS alerted_hours,
       CAST(sum(CASE WHEN alert_type = 'HIGH_ACTIVITY' THEN 1 ELSE 0 END) AS BIGINT) AS high_activity,
       CAST(sum(CASE WHEN alert_type = 'ACTIVITY_DROP' THEN 1 ELSE 0 END) AS BIGINT) AS activity_drop,
       CAST(sum(CASE WHEN alert_type = 'ACTIVITY_SPIKE' THEN 1 ELSE 0 END) AS BIGINT) AS activity_spike
FROM alerts GROUP BY grid_id""", "alerts"))
def q_alert_counts(spark, sf_dir):
    return Al.alert_counts(_alerts(spark, sf_dir))


@register("top_alerted_grids", sql("""
SELECT grid_id, count(*) AS alerts FROM alerts GROUP BY grid_id ORDER BY alerts DESC, grid_id LIMIT 10""",
    "alerts"))
def q_top_alerted_grids(spark, sf_dir):
    return Al.top_alerted_grids(_alerts(spark, sf_dir))


@register("alert_volume", sql("""
SELECT a.n AS alerted_grid_hours, d.n AS evaluated_rows, round(a.n / d.n, 6) AS alert_share,
       CAST(0.25 AS DOUBLE) AS max_share, a.n / d.n < 0.25 AS passed
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT grid_id, timestamp FROM alerts)) a,
     (SELECT count(*) AS n FROM dense) d""", "alerts", "dense"))
def q_alert_volume(spark, sf_dir):
    dense = P.dense_fact(spark, sf_dir)
    return Al.alert_volume(Al.rule_alerts(dense), dense)


@register("alert_reason_check", sql("""
SELECT count(*) AS alerts,
       CAST(sum(CASE WHEN contains(reason, alert_type) AND contains(reason, printf('%.4f', current_activity))
                 AND contains(reason, printf('%.4f', baseline_activity)) THEN 1 ELSE 0 END) AS BIGINT) AS valid_reasons,
       count(*) = sum(CASE WHEN contains(reason, alert_type) AND contains(reason, printf('%.4f', current_activity))
                 AND contains(reason, printf('%.4f', baseline_activity)) THEN 1 ELSE 0 END) AS passed
FROM alerts""", "alerts"))
def q_alert_reason_check(spark, sf_dir):
    return Al.reason_check(_alerts(spark, sf_dir))


# ---------------------------------------------------------------- geo

from cellwatch.operators import geo as Geo  # noqa: E402


@register("geo_lookup", sql("""
SELECT grid_id, 'Polygon' AS geometry_type, 5 AS ring_points,
       'milano-grid.geojson#cellId=' || CAST(grid_id AS VARCHAR) AS geometry_reference
FROM ref""", "ref"))
def q_geo_lookup(spark, sf_dir):
    poly = F.from_json(F.col("geometry"), Geo.POLYGON_DDL)
    return P.grid_lookup(spark, sf_dir).select(
        "grid_id", F.get_json_object(F.col("geometry"), "$.type").alias("geometry_type"),
        F.size(F.get(poly["coordinates"], 0)).alias("ring_points"),
        Geo.geometry_reference(F.col("grid_id")).alias("geometry_reference"))


@register("centroid_area", sql("""
SELECT grid_id, round(centroid_longitude, 6) AS centroid_longitude, round(centroid_latitude, 6) AS centroid_latitude
FROM ref_centroids""", "ref_centroids"))
def q_centroid_area(spark, sf_dir):
    c = Geo.area_centroid(F.col("geometry"))
    return P.grid_lookup(spark, sf_dir).select(
        "grid_id", round6(c["lon"]).alias("centroid_longitude"), round6(c["lat"]).alias("centroid_latitude"))


@register("centroid_vertex", sql("""
SELECT grid_id, round(vertex_longitude, 6) AS centroid_longitude, round(vertex_latitude, 6) AS centroid_latitude
FROM ref_centroids""", "ref_centroids"))
def q_centroid_vertex(spark, sf_dir):
    c = Geo.vertex_centroid(F.col("geometry"))
    return P.grid_lookup(spark, sf_dir).select(
        "grid_id", round6(c["lon"]).alias("centroid_longitude"), round6(c["lat"]).alias("centroid_latitude"))


@register("centroid_distance", sql("""
SELECT a.grid_id, b.grid_id AS neighbour_id,
       round(sqrt(pow(a.centroid_longitude - b.centroid_longitude, 2)
                  + pow(a.centroid_latitude - b.centroid_latitude, 2)), 6) AS distance,
       round(sqrt(pow(a.centroid_longitude - b.centroid_longitude, 2)
                  + pow(a.centroid_latitude - b.centroid_latitude, 2)), 6) > 0 AS passed
FROM ref_centroids a JOIN ref_centroids b ON b.grid_id = a.grid_id + 1""", "ref_centroids"))
def q_centroid_distance(spark, sf_dir):
    return Geo.neighbour_distances(P.grid_lookup(spark, sf_dir))


@register("geo_enrich", sql("""
SELECT * REPLACE (round(centroid_longitude, 6) AS centroid_longitude, round(centroid_latitude, 6) AS centroid_latitude)
FROM enriched""", "enriched"))
def q_geo_enrich(spark, sf_dir):
    e = Geo.geo_enrich(P.fact_table(spark, sf_dir), P.grid_lookup(spark, sf_dir))
    return e.withColumns({"centroid_longitude": round6(F.col("centroid_longitude")),
                          "centroid_latitude": round6(F.col("centroid_latitude"))})


@register("enrichment_coverage", sql("""
SELECT count(*) AS enriched_rows, count(DISTINCT grid_id) AS enriched_grids,
       CAST(sum(CASE WHEN centroid_longitude IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS matched_rows,
       count(DISTINCT CASE WHEN centroid_longitude IS NOT NULL THEN grid_id END) AS matched_grids,
       (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(DISTINCT grid_id) FROM fact) AS fact_grids,
       round(count(DISTINCT CASE WHEN centroid_longitude IS NOT NULL THEN grid_id END) * 100.0
             / (SELECT count(DISTINCT grid_id) FROM fact), 2) AS coverage_pct,
       count(*) = (SELECT count(*) FROM fact) AND count(DISTINCT grid_id) = (SELECT count(DISTINCT grid_id) FROM fact)
         AND count(DISTINCT CASE WHEN centroid_longitude IS NOT NULL THEN grid_id END)
             = (SELECT count(DISTINCT grid_id) FROM fact) AS passed
FROM enriched""", "enriched", "fact"))
def q_enrichment_coverage(spark, sf_dir):
    fact = P.fact_table(spark, sf_dir)
    return Geo.enrichment_coverage(fact, Geo.geo_enrich(fact, P.grid_lookup(spark, sf_dir)))


@register("unmatched_grids", sql("""
SELECT DISTINCT grid_id FROM fact WHERE grid_id NOT IN (SELECT grid_id FROM ref)""", "fact", "ref"))
def q_unmatched_grids(spark, sf_dir):
    return Geo.unmatched_grids(P.fact_table(spark, sf_dir), P.grid_lookup(spark, sf_dir))


@register("top_grids_geo", sql("""
SELECT t.grid_id, t.total_activity, round(r.centroid_longitude, 6) AS centroid_longitude,
       round(r.centroid_latitude, 6) AS centroid_latitude
FROM (SELECT grid_id, CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) AS total_activity
      FROM fact GROUP BY grid_id ORDER BY total_activity DESC, grid_id LIMIT 10) t
LEFT JOIN ref_centroids r USING (grid_id)""", "fact", "ref_centroids"))
def q_top_grids_geo(spark, sf_dir):
    t = Geo.top_grids_with_geometry(P.fact_table(spark, sf_dir), P.grid_lookup(spark, sf_dir))
    return t.withColumns({"centroid_longitude": round6(F.col("centroid_longitude")),
                          "centroid_latitude": round6(F.col("centroid_latitude"))})


# ---------------------------------------------------------------- warehouse

from cellwatch.operators import serving as Sv  # noqa: E402
from cellwatch.operators import warehouse as Wh  # noqa: E402


@register("dim_time", sql("SELECT * FROM dim_time", "dim_time"))
def q_dim_time(spark, sf_dir):
    return P.star(spark, sf_dir)[0]


@register("dim_grid", sql("""
SELECT grid_key, grid_id, round(centroid_latitude, 6) AS centroid_latitude,
       round(centroid_longitude, 6) AS centroid_longitude, geometry_reference FROM dim_grid""", "dim_grid"))
def q_dim_grid(spark, sf_dir):
    d = P.star(spark, sf_dir)[1]
    return d.withColumns({"centroid_latitude": round6(F.col("centroid_latitude")),
                          "centroid_longitude": round6(F.col("centroid_longitude"))})


@register("fact_activity", sql("SELECT * FROM fact_activity", "fact_activity"))
def q_fact_activity(spark, sf_dir):
    return P.star(spark, sf_dir)[2]


@register("orphan_facts", sql("""
SELECT f.*, 'time_key' AS missing FROM fact_activity f WHERE time_key NOT IN (SELECT time_key FROM dim_time)
   OR time_key IS NULL
UNION ALL
SELECT f.*, 'grid_key' AS missing FROM fact_activity f WHERE grid_key NOT IN (SELECT grid_key FROM dim_grid)
   OR grid_key IS NULL""", "fact_activity", "dim_time", "dim_grid"))
def q_orphan_facts(spark, sf_dir):
    return Wh.orphan_facts(*P.star(spark, sf_dir))


@register("warehouse_integrity", sql("""
SELECT (SELECT count(*) FROM fact_activity) AS fact_rows, (SELECT count(*) FROM dim_time) AS dim_time_rows,
       (SELECT count(*) FROM dim_grid) AS dim_grid_rows,
       (SELECT count(*) FROM fact_activity WHERE time_key IS NULL OR grid_key IS NULL) AS orphan_rows,
       (SELECT count(*) FROM (SELECT timestamp FROM dim_time GROUP BY 1 HAVING count(*) > 1)) AS duplicate_time_keys,
       (SELECT count(*) FROM (SELECT grid_id FROM dim_grid GROUP BY 1 HAVING count(*) > 1)) AS duplicate_grid_ids,
       (SELECT count(*) FROM fact_activity WHERE time_key IS NULL OR grid_key IS NULL) = 0 AS passed""",
    "fact_activity", "dim_time", "dim_grid"))
def q_warehouse_integrity(spark, sf_dir):
    return Wh.integrity(*P.star(spark, sf_dir))


_TOP = """(SELECT grid_id FROM (SELECT grid_id, CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) AS v
                              FROM fact GROUP BY grid_id) ORDER BY v DESC, grid_id LIMIT 1)"""


@register("reconciliation", sql(f"""
SELECT (SELECT count(*) FROM fact) AS source_rows, (SELECT count(*) FROM fact_activity) AS warehouse_rows,
       (SELECT CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) FROM fact) AS source_total,
       (SELECT CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) FROM fact_activity) AS warehouse_total,
       {_TOP} AS source_top_grid, {_TOP} AS warehouse_top_grid,
       (SELECT count(*) FROM fact) = (SELECT count(*) FROM fact_activity) AS passed""",
    "fact", "fact_activity"))
def q_reconciliation(spark, sf_dir):
    return Wh.reconciliation(P.fact_table(spark, sf_dir), P.star_rows(spark, sf_dir))


@register("star_hourly_trend", sql(f"""
SELECT timestamp, {_dsum('total_activity')}, count(*) AS active_grids FROM fact GROUP BY timestamp""", "fact"))
def q_star_hourly_trend(spark, sf_dir):
    s = P.star_rows(spark, sf_dir)
    return (s.groupBy("timestamp").agg(F.sum(F.col("total_activity").cast("decimal(38,4)")).cast("double")
                                       .alias("total_activity"), F.count(F.lit(1)).alias("active_grids")))


# ---------------------------------------------------------------- serving

@register("network_summary", sql(f"""
SELECT (SELECT t FROM as_of_t) AS as_of,
       CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) AS total_activity,
       count(DISTINCT grid_id) AS active_grids,
       (SELECT hour FROM (SELECT hour, {_dsum('total_activity', 'v')} FROM fact
                          WHERE timestamp <= (SELECT t FROM as_of_t) GROUP BY hour) ORDER BY v DESC, hour LIMIT 1)
         AS peak_hour,
       (SELECT grid_id FROM (SELECT grid_id, {_dsum('total_activity', 'v')} FROM fact
                          WHERE timestamp <= (SELECT t FROM as_of_t) GROUP BY grid_id) ORDER BY v DESC, grid_id LIMIT 1)
         AS top_grid
FROM fact WHERE timestamp <= (SELECT t FROM as_of_t)""", "fact", "as_of_t"))
def q_network_summary(spark, sf_dir):
    return Sv.network_summary(P.star_rows(spark, sf_dir))


@register("grid_drilldown", sql("""
SELECT grid_id, timestamp, sms_in, sms_out, call_in, call_out, internet_activity, total_sms, total_calls,
       total_activity, internet_share
FROM fact WHERE timestamp >= (SELECT t FROM as_of_t) - INTERVAL 23 HOUR AND timestamp <= (SELECT t FROM as_of_t)""",
    "fact", "as_of_t"))
def q_grid_drilldown(spark, sf_dir):
    return Sv.grid_activity(P.star_rows(spark, sf_dir))


def _items_sql(reasons: dict, bands=(1000.0, 5000.0, 10000.0), limit: int = 10) -> str:
    m, h, c = bands
    sev = (f"CASE WHEN total_activity >= {c} THEN 'critical' WHEN total_activity >= {h} THEN 'high' "
           f"WHEN total_activity >= {m} THEN 'medium' ELSE 'low' END")
    reason = "CASE severity " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reasons.items()) + " END"
    return sql(f"""
SELECT grid_id, timestamp, total_activity, sms_in + sms_out AS sms_activity, call_in + call_out AS call_activity,
       internet_activity, CASE WHEN severity <> 'low' THEN 'hotspot' ELSE 'normal' END AS status, severity,
       {reason} AS reason
FROM (SELECT *, {sev} AS severity FROM fact WHERE timestamp <= (SELECT t FROM as_of_t)
      ORDER BY total_activity DESC, grid_id, timestamp LIMIT {limit})""", "fact", "as_of_t")


from cellwatch import schema as _S  # noqa: E402

TEST_BANDS = (125.0, 240.0, 350.0)


@register("hotspots", _items_sql(_S.HOTSPOT_REASONS))
def q_hotspots(spark, sf_dir):
    return Sv.hotspots(P.star_rows(spark, sf_dir))


@register("severity_alerts", _items_sql(_S.ALERT_REASONS, TEST_BANDS, 50))
def q_severity_alerts(spark, sf_dir):
    return Sv.severity_alerts(P.star_rows(spark, sf_dir), limit=50, bands=TEST_BANDS)


@register("point_features", sql("""
SELECT grid_id, feature_timestamp, round(s / n, 6) AS avg_activity,
       round(CASE WHEN n >= 2 AND (s - last) / (n - 1) > 0 THEN (last - (s - last) / (n - 1)) / ((s - last) / (n - 1))
                  ELSE 0.0 END, 6) AS activity_growth,
       CAST(active_hours AS INTEGER) AS active_hours,
       round(CASE WHEN s / n > 0 THEN peak / (s / n) ELSE 0.0 END, 6) AS peak_ratio,
       round(CASE WHEN n > 1 AND s / n > 0 THEN sd / (s / n) ELSE 0.0 END, 6) AS variability,
       round(CASE WHEN s > 0 THEN si / s ELSE 0.0 END, 6) AS internet_share,
       CASE WHEN n < 24 THEN 'incomplete' ELSE 'valid' END AS data_quality,
       CASE WHEN feature_timestamp >= (SELECT t FROM as_of_t) THEN 'fresh'
            WHEN (SELECT t FROM as_of_t) - feature_timestamp <= INTERVAL 3 HOUR THEN 'stale'
            ELSE 'very_stale' END AS feature_freshness
FROM (SELECT grid_id, count(*) AS n, CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) AS s,
             max(total_activity) AS peak,
             sum(CASE WHEN total_activity > 0 THEN 1 ELSE 0 END) AS active_hours,
             CAST(SUM(CAST(internet_activity AS DECIMAL(38,10))) AS DOUBLE) AS si,
             stddev_pop(total_activity) AS sd, arg_max(total_activity, timestamp) AS last,
             max(timestamp) AS feature_timestamp
      FROM fact WHERE timestamp >= (SELECT t FROM as_of_t) - INTERVAL 23 HOUR AND timestamp <= (SELECT t FROM as_of_t)
      GROUP BY grid_id)""", "fact", "as_of_t"))
def q_point_features(spark, sf_dir):
    return Sv.point_features(P.star_rows(spark, sf_dir))


# ---------------------------------------------------------------- ML layer

from cellwatch.operators import anomaly as An  # noqa: E402
from cellwatch.operators import risk as R  # noqa: E402

_FEAT_ROUND = ["avg_activity", "activity_growth", "peak_ratio", "variability", "internet_share"]


def _round_cols(df, cols):
    return df.withColumns({c: round6(F.col(c)) for c in cols})


def _round_sql(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@register("rolling_features", sql(f"SELECT * REPLACE ({_round_sql(_FEAT_ROUND)}) FROM features", "features"))
def q_rolling_features(spark, sf_dir):
    return _round_cols(P.features(spark, sf_dir), _FEAT_ROUND)


@register("future_labels", sql(f"SELECT * REPLACE ({_round_sql(_FEAT_ROUND)}) FROM labelled0", "labelled0"))
def q_future_labels(spark, sf_dir):
    return _round_cols(P.labels(spark, sf_dir), _FEAT_ROUND)


@register("chrono_split", sql("""
SELECT split, count(*) AS rows, min(feature_timestamp) AS first_timestamp, max(feature_timestamp) AS last_timestamp,
       count(DISTINCT feature_timestamp) AS timestamps
FROM split GROUP BY split""", "split"))
def q_chrono_split(spark, sf_dir):
    return (R.chrono_split(P.labels(spark, sf_dir)).groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("feature_timestamp").alias("first_timestamp"),
                 F.max("feature_timestamp").alias("last_timestamp"),
                 F.count_distinct("feature_timestamp").alias("timestamps")))


@register("risk_labels", sql("""
SELECT grid_id, feature_timestamp, future_activity, split, round(_threshold, 6) AS _threshold,
       CAST(future_activity >= _threshold AS INTEGER) AS risk_label
FROM labelled""", "labelled"))
def q_risk_labels(spark, sf_dir):
    return (P.labelled(spark, sf_dir)
            .select("grid_id", "feature_timestamp", "future_activity", "split",
                    round6(F.col("_threshold")).alias("_threshold"), "risk_label"))


@register("class_balance", sql("""
SELECT split, CAST(future_activity >= _threshold AS INTEGER) AS risk_label, count(*) AS rows
FROM labelled GROUP BY 1, 2""", "labelled"))
def q_class_balance(spark, sf_dir):
    return R.class_balance(P.labelled(spark, sf_dir))


@register("agreement_matrix", sql("""
SELECT count(*) AS rows, CAST(sum(CASE WHEN m = a THEN 1 ELSE 0 END) AS BIGINT) AS agreement,
       round(avg(CASE WHEN m = a THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       CAST(sum(CASE WHEN m = 1 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both_alert,
       CAST(sum(CASE WHEN m = 0 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS both_no_alert,
       CAST(sum(CASE WHEN m = 1 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS model_only,
       CAST(sum(CASE WHEN m = 0 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rules_only
FROM (SELECT CAST(l.future_activity >= l._threshold AS INTEGER) AS m,
             CASE WHEN EXISTS (SELECT 1 FROM alerts x WHERE x.grid_id = l.grid_id
                               AND x.timestamp = l.feature_timestamp) THEN 1 ELSE 0 END AS a
      FROM labelled l)""", "labelled", "alerts"))
def q_agreement_matrix(spark, sf_dir):
    """The label rule stands in for the model flag so that the matrix has an exact oracle."""
    return R.agreement_matrix(P.labelled(spark, sf_dir), P.alerts(spark, sf_dir), prediction_col="risk_label")


_SCORE_ROUND = ["hour_of_day_baseline", "deviation", "anomaly_score"]


@register("anomaly_scores", sql(f"""
SELECT grid_id, timestamp, hour, total_activity, {_round_sql(_SCORE_ROUND)}, direction,
       CAST(direction <> 'NORMAL' AS INTEGER) AS anomaly_flag,
       CASE direction
         WHEN 'HIGH' THEN 'Current activity is ' || printf('%.2f', anomaly_score)
                          || '% above the historical hour-of-day baseline'
         WHEN 'LOW' THEN 'Current activity is ' || printf('%.2f', abs(anomaly_score))
                         || '% below the historical hour-of-day baseline'
         ELSE 'Activity is within the historical hour-of-day baseline range' END AS reason
FROM scored""", "scored"))
def q_anomaly_scores(spark, sf_dir):
    return _round_cols(P.anomalies(spark, sf_dir), _SCORE_ROUND)


@register("hour_bucket_sizes", sql("""
SELECT min(n) AS min_observations, max(n) AS max_observations,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multi_day_buckets
FROM (SELECT grid_id, hour, count(*) AS n FROM hod_src GROUP BY grid_id, hour)""", "hod_src"))
def q_hour_bucket_sizes(spark, sf_dir):
    return An.bucket_sizes(P.dense_fact(spark, sf_dir))


@register("extreme_cases", sql("""
(SELECT grid_id, timestamp, total_activity, round(hour_of_day_baseline, 6) AS hour_of_day_baseline,
        round(anomaly_score, 6) AS anomaly_score, 'HIGH' AS direction
 FROM scored WHERE direction = 'HIGH' ORDER BY anomaly_score DESC, grid_id, timestamp LIMIT 2)
UNION ALL
(SELECT grid_id, timestamp, total_activity, round(hour_of_day_baseline, 6), round(anomaly_score, 6), 'LOW'
 FROM scored WHERE direction = 'LOW' ORDER BY anomaly_score, grid_id, timestamp LIMIT 2)""", "scored"))
def q_extreme_cases(spark, sf_dir):
    e = An.extreme_cases(P.anomalies(spark, sf_dir))
    return _round_cols(e, ["hour_of_day_baseline", "anomaly_score"]).drop("reason")


@register("three_way_comparison", sql("""
SELECT grid_id, timestamp, anomaly_alert, np3_alert, ml3_flag,
       anomaly_alert = np3_alert AND anomaly_alert = ml3_flag AS all_agree,
       CASE WHEN anomaly_alert = 1 AND np3_alert = 0 AND ml3_flag = 0 THEN 'ANOMALY_ONLY'
            WHEN anomaly_alert = 0 AND np3_alert = 1 AND ml3_flag = 0 THEN 'NP3_ONLY'
            WHEN anomaly_alert = 0 AND np3_alert = 0 AND ml3_flag = 1 THEN 'ML3_ONLY'
            WHEN anomaly_alert = 1 AND np3_alert = 1 AND ml3_flag = 0 THEN 'ANOMALY_NP3_ONLY'
            WHEN anomaly_alert = 1 AND np3_alert = 0 AND ml3_flag = 1 THEN 'ANOMALY_ML3_ONLY'
            WHEN anomaly_alert = 0 AND np3_alert = 1 AND ml3_flag = 1 THEN 'NP3_ML3_ONLY'
            ELSE 'ALL_AGREE' END AS disagreement_type
FROM (SELECT s.grid_id, s.timestamp, CAST(s.direction <> 'NORMAL' AS INTEGER) AS anomaly_alert,
             CASE WHEN EXISTS (SELECT 1 FROM alerts x WHERE x.grid_id = s.grid_id AND x.timestamp = s.timestamp)
                  THEN 1 ELSE 0 END AS np3_alert,
             coalesce((SELECT max(CAST(l.future_activity >= l._threshold AS INTEGER)) FROM labelled l
                       WHERE l.grid_id = s.grid_id AND l.feature_timestamp = s.timestamp), 0) AS ml3_flag
      FROM scored s)""", "scored", "alerts", "labelled"))
def q_three_way_comparison(spark, sf_dir):
    """The label rule stands in for the model flag so that the comparison has an exact oracle."""
    return An.three_way(P.anomalies(spark, sf_dir), P.alerts(spark, sf_dir), P.labelled(spark, sf_dir),
                        prediction_col="risk_label")


# ---------------------------------------------------------------- run health and metrics

from cellwatch.operators import clean as Cl  # noqa: E402
from cellwatch.operators import health as He  # noqa: E402

add_health = """
SELECT 'RUN-' || regexp_extract(source_file, '(\\d{4}-\\d{2}-\\d{2})', 1) || '-001' AS run_id,
       'telecom_network_pipeline' AS pipeline_name, start_time, end_time,
       CASE WHEN failed = '' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       source_file AS input_file, input_rows, rejected_rows, output_rows,
       CASE WHEN failed = '' THEN 'PASS' ELSE 'FAIL' END AS validation_status,
       CASE WHEN failed = '' THEN NULL ELSE 'failed gates: ' || failed END
         AS error_message,
       CAST(NULL AS DOUBLE) AS duration_seconds
FROM (SELECT source_file, count(*) AS input_rows,
             concat_ws(', ', CASE WHEN bool_or(coalesce(reject_reason = 'invalid_timestamp', false)) THEN 'valid_timestamp' END,
                       CASE WHEN bool_or(coalesce(reject_reason = 'invalid_grid_id', false)) THEN 'valid_grid_id' END) AS failed,
             CAST(sum(CASE WHEN reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows,
             count(DISTINCT CASE WHEN reject_reason IS NULL THEN (date_trunc('hour', timestamp), grid_id) END)
               AS output_rows,
             min(timestamp) AS start_time, max(timestamp) AS end_time
      FROM dirty_tagged GROUP BY source_file)"""
from cellwatch.plans.oracle import add_cte as _add_cte  # noqa: E402

_add_cte("health", ["dirty_tagged"], add_health)


def _health(spark, sf_dir):
    return He.file_runs(Cl.tag_rows(P.dirty_activity(spark, sf_dir)))


@register("pipeline_health", sql("SELECT * FROM health", "health"))
def q_pipeline_health(spark, sf_dir):
    return _health(spark, sf_dir)


@register("pipeline_health_latest", sql("""
SELECT pipeline_name, status, arg_max(run_id, (end_time, run_id)) AS run_id, max(end_time) AS end_time,
       arg_max(input_file, (end_time, run_id)) AS input_file, arg_max(input_rows, (end_time, run_id)) AS input_rows,
       arg_max(rejected_rows, (end_time, run_id)) AS rejected_rows,
       arg_max(output_rows, (end_time, run_id)) AS output_rows,
       arg_max(validation_status, (end_time, run_id)) AS validation_status
FROM health GROUP BY pipeline_name, status""", "health"))
def q_pipeline_health_latest(spark, sf_dir):
    return He.latest_runs(_health(spark, sf_dir))


@register("cleaning_metrics", sql("""
SELECT 'sf-run' AS run_id, 'clean' AS stage, name, value FROM (
  SELECT 'input_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM dirty_tagged
  UNION ALL SELECT 'clean_rows', CAST(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) AS DOUBLE) FROM dirty_tagged
  UNION ALL SELECT 'rejected_rows', CAST(sum(CASE WHEN reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE)
            FROM dirty_tagged)""", "dirty_tagged"))
def q_cleaning_metrics(spark, sf_dir):
    counts = P.clean_split(spark, sf_dir)[2].select("input_rows", "clean_rows", "rejected_rows")
    return He.stage_metrics("sf-run", "clean", counts)


@register("file_traceability", sql("""
SELECT 'file_traceability' AS "check",
       sum(CASE WHEN source_file IS NULL OR source_file = '' THEN 1 ELSE 0 END) = 0 AS passed,
       CAST(CAST(sum(CASE WHEN source_file IS NULL OR source_file = '' THEN 1 ELSE 0 END) AS BIGINT) AS VARCHAR)
         AS observed, '0' AS expected
FROM activity_dirty""", "activity_dirty"))
def q_file_traceability(spark, sf_dir):
    return Q.file_traceability(P.dirty_activity(spark, sf_dir))


# ---------------------------------------------------------------- model

# A documented constant model, so that the scoring operators have an exact oracle: imputation values
# and coefficients by feature column, then the intercept. The trained queries follow it.
FIXED_MODEL = {"avg_activity": (40.0, 0.01), "activity_growth": (0.0, 0.3), "active_hours": (18.0, -0.05),
               "peak_ratio": (2.0, 0.2), "variability": (0.5, -0.4), "internet_share": (0.2, 0.6)}
FIXED_INTERCEPT = -0.5

_LOGIT = " + ".join([str(FIXED_INTERCEPT), *(
    f"{w} * coalesce(CASE WHEN isinf({c}) THEN NULL ELSE CAST({c} AS DOUBLE) END, {m})" for c, (m, w) in FIXED_MODEL.items())])
O.add_cte("fixed_scores", ["labelled0", "features"], f"""
SELECT grid_id, feature_timestamp, 1 / (1 + exp(-({_LOGIT}))) AS p FROM features""")
O.add_cte("fixed_predictions", ["labelled", "fixed_scores"], """
SELECT l.split, CAST(l.future_activity >= l._threshold AS INTEGER) AS y, CAST(s.p >= 0.5 AS INTEGER) AS yh,
       l.grid_id, l.feature_timestamp
FROM labelled l JOIN fixed_scores s ON s.grid_id = l.grid_id AND s.feature_timestamp = l.feature_timestamp""")


def _fixed(df):
    return R.predict_linear(df, FIXED_MODEL, FIXED_INTERCEPT)


@register("risk_scores_fixed", sql("""
SELECT grid_id, feature_timestamp, round(p, 6) AS risk_score,
       CASE WHEN p >= 0.5 THEN 'high' ELSE 'low' END AS risk_level, 'fixed-v1' AS model_version
FROM fixed_scores""", "fixed_scores"))
def q_risk_scores_fixed(spark, sf_dir):
    """M8 / P19 / P20 over every feature row."""
    return R.score_rows(_fixed(P.features(spark, sf_dir)), version="fixed-v1")


@register("top_risk_fixed", sql("""
SELECT grid_id, feature_timestamp, round(p, 6) AS risk_score,
       CASE WHEN p >= 0.5 THEN 'high' ELSE 'low' END AS risk_level, 'fixed-v1' AS model_version
FROM fixed_scores ORDER BY round(p, 6) DESC, grid_id, feature_timestamp LIMIT 20""", "fixed_scores"))
def q_top_risk_fixed(spark, sf_dir):
    return R.top_risk(R.score_rows(_fixed(P.features(spark, sf_dir)), version="fixed-v1"))


@register("model_evaluation_fixed", sql("""
SELECT split, count(*) AS rows, round(avg(CAST(y AS DOUBLE)), 6) AS base_rate,
       round(avg(CASE WHEN y = yh THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(coalesce(sum(y * yh) / nullif(sum(yh), 0), 0.0), 6) AS precision,
       round(coalesce(sum(y * yh) / nullif(sum(y), 0), 0.0), 6) AS recall
FROM fixed_predictions GROUP BY split""", "fixed_predictions"))
def q_model_evaluation_fixed(spark, sf_dir):
    e = R.evaluate(_fixed(P.labelled(spark, sf_dir)))
    return _round_cols(e, ["base_rate", "accuracy", "precision", "recall"])


@register("class_report_fixed", sql("""
SELECT split, class, support, round(p, 6) AS precision, round(r, 6) AS recall,
       round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) AS f1
FROM (SELECT split, class, CAST(sum(CASE WHEN y = class THEN 1 ELSE 0 END) AS BIGINT) AS support,
             coalesce(sum(CASE WHEN y = class AND yh = class THEN 1.0 ELSE 0.0 END)
                      / nullif(sum(CASE WHEN yh = class THEN 1.0 ELSE 0.0 END), 0), 0.0) AS p,
             coalesce(sum(CASE WHEN y = class AND yh = class THEN 1.0 ELSE 0.0 END)
                      / nullif(sum(CASE WHEN y = class THEN 1.0 ELSE 0.0 END), 0), 0.0) AS r
      FROM fixed_predictions, (SELECT unnest([0, 1]) AS class) GROUP BY split, class)""", "fixed_predictions"))
def q_class_report_fixed(spark, sf_dir):
    return _round_cols(R.class_report(_fixed(P.labelled(spark, sf_dir))), ["precision", "recall", "f1"])


@register("model_agreement_fixed", sql("""
SELECT count(*) AS rows, CAST(sum(CASE WHEN m = a THEN 1 ELSE 0 END) AS BIGINT) AS agreement,
       round(avg(CASE WHEN m = a THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       CAST(sum(CASE WHEN m = 1 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both_alert,
       CAST(sum(CASE WHEN m = 0 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS both_no_alert,
       CAST(sum(CASE WHEN m = 1 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS model_only,
       CAST(sum(CASE WHEN m = 0 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rules_only
FROM (SELECT l.yh AS m, CASE WHEN EXISTS (SELECT 1 FROM alerts x WHERE x.grid_id = l.grid_id
                               AND x.timestamp = l.feature_timestamp) THEN 1 ELSE 0 END AS a
      FROM fixed_predictions l)""", "fixed_predictions", "alerts"))
def q_model_agreement_fixed(spark, sf_dir):
    return R.agreement_matrix(_fixed(P.labelled(spark, sf_dir)), P.alerts(spark, sf_dir))


# ---------------------------------------------------------------- streaming form of the clean path

@register("stream_clean_activity", ORACLES["clean_activity"])
def q_stream_clean_activity(spark, sf_dir):
    """The events table read as a file stream, cleaned per micro-batch, appended exactly once
    to date partitions under the shared checkpoint folder, and read back as a table."""
    from cellwatch.sources.fixtures import EVENT_COLUMNS, activity_dirty
    from cellwatch.streaming import daily_files as D
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    ev = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
          .parquet(sf_dir).select(*EVENT_COLUMNS))
    out, ck = D.shared_path(spark, "stream-clean"), D.shared_path(spark, "stream-clean-ckpt")
    D.run_to_completion(D.write_clean(D.clean_stream(activity_dirty(ev)), out, ck))
    return spark.read.parquet(out)


# ---------------------------------------------------------------- remaining inventory items

from cellwatch.operators import gates as Ga  # noqa: E402


@register("geo_enrich_shuffle", ORACLES["geo_enrich"])
def q_geo_enrich_shuffle(spark, sf_dir):
    """The enrichment planned as a shuffle (sort-merge) join, the reference's baseline."""
    e = Geo.geo_enrich(P.fact_table(spark, sf_dir), P.grid_lookup(spark, sf_dir), broadcast=False)
    return e.withColumns({"centroid_longitude": round6(F.col("centroid_longitude")),
                          "centroid_latitude": round6(F.col("centroid_latitude"))})


@register("latest_features", sql(f"""
SELECT * REPLACE ({_round_sql(_FEAT_ROUND)}) FROM features
WHERE (grid_id, feature_timestamp) IN (SELECT grid_id, max(feature_timestamp) FROM features GROUP BY grid_id)""",
    "features"))
def q_latest_features(spark, sf_dir):
    return _round_cols(R.latest_features(P.features(spark, sf_dir)), _FEAT_ROUND)


@register("drilldown_totals", sql(f"""
SELECT grid_id, count(*) AS points, {_dsum('total_sms')}, {_dsum('total_calls')}, {_dsum('internet_activity')},
       {_dsum('total_activity')}
FROM fact WHERE timestamp >= (SELECT t FROM as_of_t) - INTERVAL 23 HOUR AND timestamp <= (SELECT t FROM as_of_t)
GROUP BY grid_id""", "fact", "as_of_t"))
def q_drilldown_totals(spark, sf_dir):
    """The client-side totals over the 24 returned points, per grid."""
    from cellwatch.functions.columns import exact_sum
    d = Sv.grid_activity(P.fact_table(spark, sf_dir))
    return d.groupBy("grid_id").agg(F.count(F.lit(1)).alias("points"),
                                    *[exact_sum(c).alias(c) for c in ["total_sms", "total_calls",
                                                                      "internet_activity", "total_activity"]])


@register("alert_type_counts", sql("SELECT alert_type, count(*) AS rows FROM alerts GROUP BY alert_type", "alerts"))
def q_alert_type_counts(spark, sf_dir):
    return Fa.value_counts(P.alerts(spark, sf_dir), "alert_type")


@register("processed_gate", sql("""
SELECT 'processed' AS gate, 'unique_grain' AS "check", d = 0 AS passed, CAST(d AS VARCHAR) AS observed,
       '0' AS expected
FROM (SELECT count(*) AS d FROM (SELECT timestamp, grid_id FROM fact GROUP BY 1, 2 HAVING count(*) > 1))
UNION ALL
SELECT 'processed', 'expected_timestamps', t = dd * 24, CAST(t AS VARCHAR), CAST(dd * 24 AS VARCHAR)
FROM (SELECT count(DISTINCT timestamp) AS t, count(DISTINCT CAST(timestamp AS DATE)) AS dd FROM fact)
UNION ALL SELECT 'processed', 'forbidden_columns', true, '-', '-'
UNION ALL SELECT 'processed', 'required_columns', true, '-', '-'""", "fact"))
def q_processed_gate(spark, sf_dir):
    return Ga.processed_gate(P.fact_table(spark, sf_dir))


# ---------------------------------------------------------------- full precision, ids of any size, gates

@register("hourly_grid_summary_fine", sql(f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp, CAST(user_id // 15 + 9996 AS INTEGER) AS grid_id,
       {", ".join(f"coalesce(round(fsum(CASE WHEN event_type = '{et}' THEN value / 7e5 END), 9), 0) AS {name}"
                  for et, name in (("click", "sms_in"), ("view", "sms_out"), ("signup", "call_in"),
                                   ("error", "call_out"), ("purchase", "internet_activity")))}
FROM events GROUP BY 1, 2"""))
def q_hourly_grid_summary_fine(spark, sf_dir):
    """A1 / D2 on small values of many decimals and ids beyond 10,000: nothing is rounded or rejected."""
    ev = P.events(spark, sf_dir).withColumns({"value": F.col("value") / 7e5, "user_id": F.col("user_id") + 15 * 9995})
    fact = Fa.hourly_grid_summary(Cl.clean(X.activity_raw(ev), with_counts=False)[0])
    return fact.select("timestamp", "grid_id", *(F.round(m, 9).alias(m) for m in _S.MEASURES))


@register("grid_range_gate", """
SELECT 'valid_timestamp' AS "check", TRUE AS passed, '0' AS observed, '0' AS expected
UNION ALL
SELECT 'valid_grid_id', n = 0, CAST(n AS VARCHAR), '0'
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT date_trunc('hour', ts), user_id // 15, event_id % 7
                                 FROM events WHERE user_id // 15 + 9996 > 10000))""")
def q_grid_range_gate(spark, sf_dir):
    """P11 as a gate (G2): ids beyond the domain fail the run, they are not quarantined."""
    ev = P.events(spark, sf_dir).withColumn("user_id", F.col("user_id") + 15 * 9995)
    return Q.valid_values(Cl.typed_columns(Cl.rename_canonical(X.activity_raw(ev))))


@register("key_lookup_findings", """
SELECT * FROM (VALUES ('grid_key_many_to_one', TRUE, '0', '0'), ('grid_key_found', TRUE, '0', '0'))
  t("check", passed, observed, expected)""")
def q_key_lookup_findings(spark, sf_dir):
    """J5 guard of the grid dimension."""
    return Wh.lookup_findings(P.fact_table(spark, sf_dir), P.star(spark, sf_dir)[1], "grid_id", "grid_key")


@register("peak_timestamp", sql(f"""
SELECT timestamp, {_dsum('total_activity')} FROM fact GROUP BY timestamp
ORDER BY total_activity DESC, timestamp LIMIT 1""", "fact"))
def q_peak_timestamp(spark, sf_dir):
    return Fa.peak_timestamp(P.fact_table(spark, sf_dir))


# ---------------------------------------------------------------- serving with parameters

_PAST = "2024-01-12 13:00:00"
_AT = "2024-01-15 09:00:00"


def _as_of(oracle: str, instant: str) -> str:
    """The oracle with a given as-of instead of the newest timestamp."""
    newest = "SELECT max(timestamp) AS t FROM fact"
    assert newest in oracle
    return oracle.replace(newest, f"SELECT TIMESTAMP '{instant}' AS t")


def _past() -> datetime:
    return datetime.fromisoformat(_PAST)


@register("network_summary_past", _as_of(ORACLES["network_summary"], _PAST))
def q_network_summary_past(spark, sf_dir):
    return Sv.network_summary(P.star_rows(spark, sf_dir), as_of=_past())


@register("point_features_past", _as_of(ORACLES["point_features"], _PAST))
def q_point_features_past(spark, sf_dir):
    return Sv.point_features(P.star_rows(spark, sf_dir), as_of=_past())


@register("grid_drilldown_at", "SELECT * FROM (" + _as_of(ORACLES["grid_drilldown"], _AT) + ") WHERE grid_id = 1")
def q_grid_drilldown_at(spark, sf_dir):
    """D10 for one grid, moved to a date and an hour of day."""
    t = datetime.fromisoformat(_AT)
    return Sv.grid_activity(P.star_rows(spark, sf_dir), grid_id=1, date=t.date(), hour=t.hour)


@register("hotspots_filter_first", f"""
SELECT * FROM ({_as_of(_items_sql(_S.HOTSPOT_REASONS, TEST_BANDS, 1_000_000_000), _PAST)})
WHERE severity = 'medium' ORDER BY total_activity DESC, grid_id, timestamp LIMIT 40""")
def q_hotspots_filter_first(spark, sf_dir):
    return Sv.hotspots(P.star_rows(spark, sf_dir), limit=40, severity="medium", as_of=_past(), bands=TEST_BANDS,
                       filter_first=True)


@register("hotspots_limit_first", f"""
SELECT * FROM ({_as_of(_items_sql(_S.HOTSPOT_REASONS, TEST_BANDS, 200), _PAST)}) WHERE severity = 'high'""")
def q_hotspots_limit_first(spark, sf_dir):
    return Sv.hotspots(P.star_rows(spark, sf_dir), limit=200, severity="HIGH", as_of=_past(), bands=TEST_BANDS)


@register("hotspots_bands", _items_sql(_S.HOTSPOT_REASONS, (5.0, 125.0, 240.0), 100_000))
def q_hotspots_bands(spark, sf_dir):
    """Bands that give all four levels."""
    return Sv.hotspots(P.star_rows(spark, sf_dir), limit=100_000, bands=(5.0, 125.0, 240.0))


# ---------------------------------------------------------------- the largest table: lineitem as activity

_LINEITEM = (("l_quantity", "sms_in"), ("l_extendedprice", "sms_out"), ("l_discount", "call_in"),
             ("l_tax", "call_out"), ("l_linenumber", "internet_activity"))


def lineitem_fact(spark, sf_dir):
    from cellwatch.sources.tables import read_table
    raw = X.activity_from_lineitem(read_table(spark, sf_dir, "lineitem", [
        "l_shipdate", "l_suppkey", "l_orderkey", *(c for c, _ in _LINEITEM)]))
    return Fa.hourly_grid_summary(Cl.clean(raw, with_counts=False)[0])


@register("lineitem_fact", f"""
SELECT CAST(l_shipdate AS TIMESTAMP) AS timestamp, CAST(l_suppkey AS INTEGER) AS grid_id,
       {", ".join(_dsum(c, name) for c, name in _LINEITEM)}
FROM lineitem GROUP BY 1, 2""")
def q_lineitem_fact(spark, sf_dir):
    return lineitem_fact(spark, sf_dir).select("timestamp", "grid_id", *_S.MEASURES)


@register("lineitem_top_grids", f"""
SELECT CAST(l_suppkey AS INTEGER) AS grid_id, round(CAST(SUM({" + ".join(
    f"CAST({c} AS DECIMAL(38,10))" for c, _ in _LINEITEM)}) AS DOUBLE), 4) AS total_activity
FROM lineitem GROUP BY 1 ORDER BY total_activity DESC, grid_id LIMIT 10""")
def q_lineitem_top_grids(spark, sf_dir):
    top = Fa.top_grids(lineitem_fact(spark, sf_dir))
    return top.select("grid_id", F.round("total_activity", 4).alias("total_activity"))


# ---------------------------------------------------------------- geometry from the data

O.add_cte("data_boxes", [], """
SELECT CAST(user_id // 15 + 1 AS INTEGER) AS g, min(value) AS x0, max(value) AS x1,
       min(CAST(event_id % 1000 AS DOUBLE)) AS y0, max(CAST(event_id % 1000 AS DOUBLE)) AS y1
FROM events GROUP BY 1""")


@register("data_centroids", sql("""
SELECT g AS grid_id,
       round(CASE g % 4 WHEN 0 THEN (2 * x0 + x1) / 3 WHEN 1 THEN (x0 + x1) / 2 WHEN 3 THEN (2 * x0 + x1) / 3 END, 6)
         AS centroid_longitude,
       round(CASE g % 4 WHEN 0 THEN (2 * y0 + y1) / 3 WHEN 1 THEN (y0 + y1) / 2 WHEN 3 THEN y0 END, 6)
         AS centroid_latitude,
       round(CASE g % 4 WHEN 0 THEN (3 * x0 + x1) / 4 WHEN 1 THEN (3 * x0 + 2 * x1) / 5
             WHEN 2 THEN (6 * x0 + 3 * x1) / 9 ELSE (2 * x0 + x1) / 3 END, 6) AS vertex_longitude,
       round(CASE g % 4 WHEN 0 THEN (3 * y0 + y1) / 4 WHEN 1 THEN (3 * y0 + 2 * y1) / 5
             WHEN 2 THEN (6 * y0 + 3 * y1) / 9 ELSE y0 END, 6) AS vertex_latitude
FROM data_boxes WHERE g % 5 <> 0""", "data_boxes"))
def q_data_centroids(spark, sf_dir):
    """Both centroids of polygons, multi-polygons and rings without area made from the events."""
    from cellwatch.sources.geojson import grid_lookup, parse_features
    lookup = Geo.reference_lookup(grid_lookup(parse_features(X.data_features(P.events(spark, sf_dir)))))
    c = Geo.with_centroids(lookup).where("grid_id % 5 <> 0").drop("geometry")
    return _round_cols(c, ["centroid_longitude", "centroid_latitude", "vertex_longitude", "vertex_latitude"])


@register("data_geo_duplicates", sql("""
SELECT count(*) AS features, count(*) - count(DISTINCT g) AS duplicates,
       count(DISTINCT g) AS grids FROM (SELECT g FROM data_boxes UNION ALL SELECT g FROM data_boxes WHERE g % 5 = 0)""",
    "data_boxes"))
def q_data_geo_duplicates(spark, sf_dir):
    """Features with a repeated id: the lookup has one row per id."""
    from cellwatch.sources.geojson import grid_lookup, parse_features
    raw = grid_lookup(parse_features(X.data_features(P.events(spark, sf_dir))))
    once = Geo.reference_lookup(raw).agg(F.count(F.lit(1))).scalar()
    return raw.agg(F.count(F.lit(1)).alias("features")).select(
        "features", (F.col("features") - once).alias("duplicates"), once.alias("grids"))


# ---------------------------------------------------------------- further gates and helpers as queries

@register("first_event_per_user", """
SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events)
WHERE r = 1""")
def q_first_event_per_user(spark, sf_dir):
    """W9 on rows that do repeat."""
    e = P.events(spark, sf_dir).select("user_id", "event_id", "ts")
    return Wi.keep_first(e, ["user_id"], ["ts", "event_id"])


@register("row_count_gate", sql("""
SELECT 'row_count_bounds' AS "check", a <= b AND a <= d * 240000 AS passed, CAST(a AS VARCHAR) AS observed,
       '<= ' || CAST(least(b, d * 240000) AS VARCHAR) AS expected
FROM (SELECT (SELECT count(*) FROM clean) AS b, (SELECT count(*) FROM fact) AS a,
             (SELECT count(DISTINCT date) FROM fact) AS d)""", "clean", "fact"))
def q_row_count_gate(spark, sf_dir):
    """G5."""
    return Q.row_count_bounds(P.clean_activity(spark, sf_dir), P.fact_table(spark, sf_dir))


@register("raw_grain_gate", sql("""
SELECT 'raw_grain_unique' AS "check", n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected
FROM (SELECT count(*) AS n FROM (SELECT timestamp, grid_id, country_code FROM activity_raw
                                 GROUP BY ALL HAVING count(*) > 1))""", "activity_raw"))
def q_raw_grain_gate(spark, sf_dir):
    """G8."""
    return Q.grain_preserved(P.canonical_raw(spark, sf_dir))


@register("dirty_grain_gate", sql("""
SELECT 'raw_grain_unique' AS "check", n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected
FROM (SELECT count(*) AS n FROM (SELECT timestamp, grid_id, country_code FROM dirty_typed
                                 GROUP BY ALL HAVING count(*) > 1))""", "dirty_typed"))
def q_dirty_grain_gate(spark, sf_dir):
    """G8 where it fails: missing times and ids repeat."""
    return Q.grain_preserved(Cl.typed_columns(Cl.rename_canonical(P.dirty_activity(spark, sf_dir))))


@register("blank_counts", sql(", ".join([f"SELECT CAST(sum(CASE WHEN trim({c}) = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_{c}"
                                          if k == 0 else f"CAST(sum(CASE WHEN trim({c}) = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_{c}"
                                          for k, c in enumerate(("smsin", "smsout", "datetime"))])
                              + " FROM activity_dirty", "activity_dirty"))
def q_blank_counts(spark, sf_dir):
    """P5 / A10: blank cells of the text columns."""
    return P.dirty_activity(spark, sf_dir).agg(*Cl.blank_counts(None, ("smsin", "smsout", "datetime")))


# ---------------------------------------------------------------- the named gates on dirty and clean input

@register("landing_gate", sql("""
SELECT 'landing' AS gate, "check", passed, observed, expected FROM (
  SELECT 'required_columns' AS "check", TRUE AS passed, '-' AS observed, '-' AS expected
  UNION ALL SELECT 'valid_timestamp', n = 0, CAST(n AS VARCHAR), '0' FROM (SELECT count(*) AS n FROM dirty_typed WHERE timestamp IS NULL)
  UNION ALL SELECT 'valid_grid_id', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM dirty_typed WHERE grid_id IS NULL OR NOT grid_id BETWEEN 1 AND 10000)
  UNION ALL SELECT 'valid_measure_types', TRUE, '0', '0'
  UNION ALL SELECT 'duplicate_records', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (event_id, source_file) FROM activity_dirty)) AS n
          FROM activity_dirty))""", "dirty_typed", "activity_dirty"))
def q_landing_gate(spark, sf_dir):
    """Gate 1: fails on the injected junk."""
    return Ga.landing_gate(P.dirty_activity(spark, sf_dir))


@register("raw_gate", sql("""
SELECT 'raw' AS gate, "check", passed, observed, expected FROM (
  SELECT 'required_columns' AS "check", TRUE AS passed, '-' AS observed, '-' AS expected
  UNION ALL SELECT 'valid_timestamp', n = 0, CAST(n AS VARCHAR), '0' FROM (SELECT count(*) AS n FROM activity_raw WHERE timestamp IS NULL)
  UNION ALL SELECT 'valid_grid_id', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM activity_raw WHERE grid_id IS NULL OR NOT grid_id BETWEEN 1 AND 10000)
  UNION ALL SELECT 'raw_grain_unique', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM (SELECT timestamp, grid_id, country_code FROM activity_raw GROUP BY ALL HAVING count(*) > 1)))""",
    "activity_raw"))
def q_raw_gate(spark, sf_dir):
    """Gate 2."""
    return Ga.raw_gate(P.canonical_raw(spark, sf_dir))


@register("analytics_gate", sql("""
SELECT 'analytics' AS gate, "check", passed, observed, expected FROM (
  SELECT 'unique_grain' AS "check", n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected
    FROM (SELECT count(*) AS n FROM (SELECT timestamp, grid_id FROM fact GROUP BY ALL HAVING count(*) > 1))
  UNION ALL SELECT 'warehouse_rows', a = b, CAST(a AS VARCHAR), CAST(b AS VARCHAR)
    FROM (SELECT (SELECT count(*) FROM fact_activity) AS a, (SELECT count(*) FROM fact) AS b)
  UNION ALL SELECT 'warehouse_keys', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM fact_activity WHERE time_key IS NULL OR grid_key IS NULL)
  UNION ALL SELECT 'unique_time_key', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM (SELECT time_key FROM dim_time GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique_grid_key', n = 0, CAST(n AS VARCHAR), '0'
    FROM (SELECT count(*) AS n FROM (SELECT grid_key FROM dim_grid GROUP BY 1 HAVING count(*) > 1)))""",
    "fact", "fact_activity", "dim_time", "dim_grid"))
def q_analytics_gate(spark, sf_dir):
    """Gate 4."""
    dim_t, dim_g, loaded = P.star(spark, sf_dir)
    return Ga.analytics_gate(P.fact_table(spark, sf_dir), loaded, dim_t, dim_g)


@register("serve_gate", sql("""
SELECT 'serve' AS gate, "check", passed, observed, expected FROM (
  SELECT unnest([{'check': 'latest_run_succeeded', 'passed': status = 'SUCCESS', 'observed': status, 'expected': 'SUCCESS'},
                 {'check': 'latest_run_validated', 'passed': validation_status = 'PASS', 'observed': validation_status, 'expected': 'PASS'},
                 {'check': 'latest_run_published', 'passed': output_rows > 0, 'observed': CAST(output_rows AS VARCHAR), 'expected': '> 0'}],
                recursive := true)
  FROM health ORDER BY end_time DESC, run_id DESC LIMIT 3)""", "health"))
def q_serve_gate(spark, sf_dir):
    """Gate 5: the newest file's run."""
    return Ga.serve_gate(_health(spark, sf_dir))


# The queries of what is delivered (runs, published tables, read-back) and of the trained model.
from cellwatch.plans import catalog_delivery, catalog_model  # noqa: E402, F401
