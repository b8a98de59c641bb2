"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Shared steps are CTEs; ``sql(body, *ctes)`` prepends the named CTEs and everything they
depend on, in dependency order. DuckDB notes: ``//`` is integer division, ``dayofweek`` is
0 = Sunday (Spark: 1 = Sunday), ``quantile_cont`` equals Spark's ``percentile``.
"""

from __future__ import annotations

MEASURES = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity"]


def _dsum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE)"


def _fact_from(summed: str) -> str:
    """Totals, share and time parts over a (timestamp, grid_id, 5 measures) relation."""
    return f"""SELECT timestamp, grid_id, sms_in, sms_out, call_in, call_out,
       sms_in + sms_out AS total_sms, call_in + call_out AS total_calls, internet_activity,
       (sms_in + sms_out) + (call_in + call_out) + internet_activity AS total_activity,
       CASE WHEN (sms_in + sms_out) + (call_in + call_out) + internet_activity > 0
            THEN internet_activity / ((sms_in + sms_out) + (call_in + call_out) + internet_activity)
            ELSE 0.0 END AS internet_share,
       CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week,
       CAST(timestamp AS DATE) AS date
FROM {summed}"""


_NEG = " OR ".join(f"coalesce({m} < 0, false)" for m in MEASURES)
_REASON = f"""CASE WHEN timestamp IS NULL THEN 'invalid_timestamp'
     WHEN grid_id IS NULL THEN 'invalid_grid_id'
     WHEN {_NEG} THEN 'negative_activity' END"""
_CLEAN_SELECT = ("timestamp, grid_id, country_code, "
                 + ", ".join(f"coalesce({m}, 0.0) AS {m}" for m in MEASURES))

CTES: dict[str, tuple[list[str], str]] = {
    "activity_raw": ([], """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp,
       CAST(user_id // 15 + 1 AS INTEGER) AS grid_id,
       CAST(event_id % 7 AS INTEGER) AS country_code,
       CAST(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(38,10)) END) AS DOUBLE) AS sms_in,
       CAST(SUM(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(38,10)) END) AS DOUBLE) AS sms_out,
       CAST(SUM(CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(38,10)) END) AS DOUBLE) AS call_in,
       CAST(SUM(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(38,10)) END) AS DOUBLE) AS call_out,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(38,10)) END) AS DOUBLE) AS internet_activity
FROM events GROUP BY 1, 2, 3"""),
    "activity_dirty": ([], """
SELECT event_id, 'sms-call-internet-mi-' || strftime(ts, '%Y-%m-%d') || '.csv' AS source_file,
       CASE WHEN event_id % 103 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS datetime,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(CAST(user_id // 15 + 1 AS INTEGER) AS VARCHAR) END AS CellID,
       CAST(event_id % 7 AS VARCHAR) AS countrycode,
       CASE WHEN event_type = 'click' THEN (CASE WHEN event_id % 97 = 0 THEN '-1.5'
                                                 WHEN event_id % 89 = 0 THEN ' '
                                                 ELSE CAST(value AS VARCHAR) END) END AS smsin,
       CASE WHEN event_type = 'view' THEN CAST(value AS VARCHAR) END AS smsout,
       CASE WHEN event_type = 'signup' THEN CAST(value AS VARCHAR) END AS callin,
       CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) END AS callout,
       CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) END AS internet
FROM events"""),
    "dirty_typed": (["activity_dirty"], """
SELECT event_id, source_file,
       try_strptime(nullif(trim(datetime), ''), '%Y-%m-%d %H:%M:%S') AS timestamp,
       TRY_CAST(nullif(trim(CellID), '') AS INTEGER) AS grid_id,
       TRY_CAST(nullif(trim(countrycode), '') AS INTEGER) AS country_code,
       TRY_CAST(nullif(trim(smsin), '') AS DOUBLE) AS sms_in,
       TRY_CAST(nullif(trim(smsout), '') AS DOUBLE) AS sms_out,
       TRY_CAST(nullif(trim(callin), '') AS DOUBLE) AS call_in,
       TRY_CAST(nullif(trim(callout), '') AS DOUBLE) AS call_out,
       TRY_CAST(nullif(trim(internet), '') AS DOUBLE) AS internet_activity
FROM activity_dirty"""),
    "dirty_tagged": (["dirty_typed"], f"SELECT *, {_REASON} AS reject_reason FROM dirty_typed"),
    "raw_tagged": (["activity_raw"], f"SELECT *, {_REASON} AS reject_reason FROM activity_raw"),
    "clean": (["raw_tagged"], f"SELECT {_CLEAN_SELECT} FROM raw_tagged WHERE reject_reason IS NULL"),
    "fact_sum": (["clean"], "SELECT timestamp, grid_id, "
                 + ", ".join(f"{_dsum(m)} AS {m}" for m in MEASURES)
                 + " FROM clean GROUP BY timestamp, grid_id"),
    "fact": (["fact_sum"], _fact_from("fact_sum")),
    "bounds": (["fact"], """
SELECT date_trunc('day', min(timestamp)) AS lo,
       CAST(date_trunc('day', max(timestamp)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi FROM fact"""),
    "skeleton": (["fact", "bounds"], """
SELECT g.grid_id, CAST(h.timestamp AS TIMESTAMP) AS timestamp
FROM (SELECT DISTINCT grid_id FROM fact) g,
     (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM bounds) h"""),
    "dense_sum": (["skeleton", "fact"], "SELECT s.grid_id, s.timestamp, "
                  + ", ".join(f"coalesce(f.{m}, 0.0) AS {m}" for m in MEASURES)
                  + " FROM skeleton s LEFT JOIN fact f ON s.grid_id = f.grid_id AND s.timestamp = f.timestamp"),
    "dense": (["dense_sum"], _fact_from("dense_sum")),
}


def sql(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def add_cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- alert chain CTEs
add_cte("dense_base", ["dense"], """
SELECT grid_id, timestamp, date, total_activity,
       lag(total_activity) OVER (PARTITION BY grid_id, date ORDER BY timestamp) AS previous_hour_activity
FROM dense""")
# Brute force on purpose: the median of the other rows of the same grid and day.
add_cte("loo", ["dense"], """
SELECT a.grid_id, a.timestamp, median(b.total_activity) AS baseline_activity
FROM dense a LEFT JOIN dense b
  ON a.grid_id = b.grid_id AND a.date = b.date AND a.timestamp <> b.timestamp
GROUP BY a.grid_id, a.timestamp""")
add_cte("base", ["dense_base", "loo"], """
SELECT d.*, l.baseline_activity FROM dense_base d JOIN loo l USING (grid_id, timestamp)""")
add_cte("daily_totals", ["dense"], """
SELECT date, grid_id, CAST(SUM(CAST(total_activity AS DECIMAL(38,10))) AS DOUBLE) AS daily_total
FROM dense GROUP BY date, grid_id""")
add_cte("floors", ["daily_totals"], """
SELECT date, quantile_cont(daily_total, 0.25) AS floor FROM daily_totals GROUP BY date""")
add_cte("eligible", ["daily_totals", "floors"], """
SELECT d.date, d.grid_id FROM daily_totals d JOIN floors f USING (date) WHERE d.daily_total >= f.floor""")
add_cte("alerts", ["base", "eligible"], """
SELECT grid_id, timestamp, alert_type, total_activity AS current_activity, baseline_activity,
       CASE alert_type
         WHEN 'HIGH_ACTIVITY' THEN 'HIGH_ACTIVITY: current activity ' || printf('%.4f', total_activity)
              || ' is at least 50% above the within-day baseline ' || printf('%.4f', baseline_activity) || '.'
         WHEN 'ACTIVITY_DROP' THEN 'ACTIVITY_DROP: current activity ' || printf('%.4f', total_activity)
              || ' is at or below 50% of the within-day baseline ' || printf('%.4f', baseline_activity) || '.'
         ELSE 'ACTIVITY_SPIKE: current activity ' || printf('%.4f', total_activity)
              || ' increased by at least 50% from the preceding hour; within-day baseline is '
              || printf('%.4f', baseline_activity) || '.' END AS reason
FROM (
  SELECT b.*, 'HIGH_ACTIVITY' AS alert_type FROM base b
   WHERE baseline_activity > 0 AND total_activity >= 1.5 * baseline_activity
  UNION ALL
  SELECT b.*, 'ACTIVITY_DROP' FROM base b
   WHERE baseline_activity > 0 AND total_activity <= 0.5 * baseline_activity
  UNION ALL
  SELECT b.*, 'ACTIVITY_SPIKE' FROM base b
   WHERE baseline_activity IS NOT NULL AND previous_hour_activity > 0
     AND total_activity >= 1.5 * previous_hour_activity
) h
WHERE (date, grid_id) IN (SELECT date, grid_id FROM eligible)""")


# ---------------------------------------------------------------- geo CTEs (lattice rule of the fixture)
add_cte("ref", [], """
SELECT grid_id, x0, y0, round(x0 + 0.003, 6) AS x1, round(y0 + 0.002, 6) AS y1
FROM (SELECT grid_id, round(9.01 + 0.003 * ((grid_id - 1) % 100), 6) AS x0,
             round(45.35 + 0.002 * ((grid_id - 1) // 100), 6) AS y0
      FROM (SELECT CAST(unnest(generate_series(1, max(user_id) // 15)) AS INTEGER) AS grid_id FROM events))""")
add_cte("ref_centroids", ["ref"], """
SELECT grid_id, (x0 + x1) / 2 AS centroid_longitude, (y0 + y1) / 2 AS centroid_latitude,
       (3 * x0 + 2 * x1) / 5 AS vertex_longitude, (3 * y0 + 2 * y1) / 5 AS vertex_latitude
FROM ref""")
add_cte("enriched", ["fact", "ref_centroids"], """
SELECT f.*, r.centroid_longitude, r.centroid_latitude,
       CASE WHEN r.grid_id IS NOT NULL THEN 'milano-grid.geojson#cellId=' || CAST(f.grid_id AS VARCHAR) END
         AS geometry_reference
FROM fact f LEFT JOIN ref_centroids r USING (grid_id)""")


# ---------------------------------------------------------------- warehouse CTEs
add_cte("dim_time", ["fact"], """
SELECT CAST(row_number() OVER (ORDER BY timestamp) AS INTEGER) AS time_key, timestamp,
       CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(isodow(timestamp) AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT timestamp FROM fact)""")
add_cte("dim_grid", ["fact", "ref_centroids"], """
SELECT CAST(row_number() OVER (ORDER BY g.grid_id) AS INTEGER) AS grid_key, g.grid_id,
       r.vertex_latitude AS centroid_latitude, r.vertex_longitude AS centroid_longitude,
       CASE WHEN r.grid_id IS NOT NULL THEN 'milano-grid.geojson#cellId=' || CAST(g.grid_id AS VARCHAR) END
         AS geometry_reference
FROM (SELECT DISTINCT grid_id FROM fact) g LEFT JOIN ref_centroids r ON r.grid_id = g.grid_id""")
add_cte("fact_activity", ["fact", "dim_time", "dim_grid"], """
SELECT t.time_key, g.grid_key, f.sms_in, f.sms_out, f.call_in, f.call_out, f.internet_activity,
       f.total_sms, f.total_calls, f.total_activity, f.internet_share
FROM fact f LEFT JOIN dim_time t USING (timestamp) LEFT JOIN dim_grid g USING (grid_id)""")
add_cte("as_of_t", ["fact"], "SELECT max(timestamp) AS t FROM fact")


# ---------------------------------------------------------------- ML CTEs
_W24 = "(PARTITION BY grid_id ORDER BY feature_timestamp RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)"
_W48 = "(PARTITION BY grid_id ORDER BY feature_timestamp RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW)"
add_cte("feat_src", ["dense"], """
SELECT grid_id, timestamp AS feature_timestamp, total_activity AS a, internet_activity AS i,
       lag(total_activity, 24) OVER (PARTITION BY grid_id ORDER BY timestamp) AS shift
FROM dense""")
add_cte("features", ["feat_src"], f"""
SELECT grid_id, feature_timestamp, avg_a AS avg_activity,
       CASE WHEN base = 0 THEN 0.0 ELSE (avg_a - base) / base END AS activity_growth,
       CAST(active AS BIGINT) AS active_hours,
       CASE WHEN avg_a <> 0 THEN peak / avg_a ELSE 0.0 END AS peak_ratio,
       coalesce(sd, 0.0) AS variability,
       CASE WHEN asum <> 0 THEN isum / asum ELSE 0.0 END AS internet_share
FROM (SELECT grid_id, feature_timestamp,
             avg(a) OVER {_W24} AS avg_a, max(a) OVER {_W24} AS peak, stddev_samp(a) OVER {_W24} AS sd,
             sum(CASE WHEN a > 0 THEN 1 ELSE 0 END) OVER {_W24} AS active,
             sum(i) OVER {_W24} AS isum, sum(a) OVER {_W24} AS asum,
             avg(shift) OVER {_W24} AS base, count(a) OVER {_W48} AS hist
      FROM feat_src)
WHERE hist >= 48""")
add_cte("labelled0", ["features", "dense"], """
SELECT f.*, d.total_activity AS future_activity
FROM features f JOIN dense d ON d.grid_id = f.grid_id AND d.timestamp - INTERVAL 1 HOUR = f.feature_timestamp""")
add_cte("split_ts", ["labelled0"], """
SELECT t FROM (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n
               FROM (SELECT DISTINCT feature_timestamp AS t FROM labelled0))
WHERE i = least(greatest(1, CAST(floor(n * 0.8) AS BIGINT)), n - 1) AND n >= 2""")
add_cte("split", ["labelled0", "split_ts"], """
SELECT l.*, CASE WHEN feature_timestamp < (SELECT t FROM split_ts) THEN 'train' ELSE 'test' END AS split
FROM labelled0 l""")
add_cte("labelled", ["split"], """
SELECT s.*, coalesce(g.thr, (SELECT quantile_cont(future_activity, 0.9) FROM split WHERE split = 'train'))
         AS _threshold
FROM split s LEFT JOIN (SELECT grid_id, quantile_cont(future_activity, 0.9) AS thr FROM split
                        WHERE split = 'train' GROUP BY grid_id) g USING (grid_id)""")
add_cte("hod_src", ["dense"], """
SELECT grid_id, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour, total_activity FROM dense""")
# Median written out as the mean of the two middle order statistics (Spark's exact form).
add_cte("hod_median", ["hod_src"], """
SELECT grid_id, hour, (list_sort(v)[(len(v) + 1) // 2] + list_sort(v)[len(v) // 2 + 1]) / 2 AS hour_of_day_baseline
FROM (SELECT grid_id, hour, list(total_activity) AS v FROM hod_src GROUP BY grid_id, hour)""")
add_cte("scores", ["hod_src", "hod_median"], """
SELECT grid_id, timestamp, hour, total_activity, hour_of_day_baseline,
       total_activity - hour_of_day_baseline AS deviation,
       CASE WHEN abs(hour_of_day_baseline) > 0
            THEN (total_activity - hour_of_day_baseline) / abs(hour_of_day_baseline) * 100.0 END AS anomaly_score
FROM hod_src JOIN hod_median USING (grid_id, hour)""")
add_cte("scored", ["scores"], """
SELECT *, CASE WHEN anomaly_score >= 50 THEN 'HIGH' WHEN anomaly_score <= -50 THEN 'LOW' ELSE 'NORMAL' END
            AS direction
FROM scores""")
