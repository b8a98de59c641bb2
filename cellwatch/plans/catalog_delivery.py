"""Queries of what is delivered: runs and published tables, read-back, recomputation, ordered and mixed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.operators import clean as C
from cellwatch.operators import facts as Fa
from cellwatch.operators import gates as Ga
from cellwatch.operators import publish as Pu
from cellwatch.operators import quality as Q
from cellwatch.operators.readback import write_checked
from cellwatch.plans import pipeline as P
from cellwatch.plans.catalog import register
from cellwatch.plans.oracle import add_cte, sql
from cellwatch.sources import files as Fi
from cellwatch.sources import fixtures as X
from cellwatch.sources import sinks as Sk
from cellwatch.streaming.daily_files import shared_path

# ---------------------------------------------------------------- runs

add_cte("run_log", ["activity_raw", "dirty_tagged", "fact"], """
SELECT 'RUN-1' AS run_id, 1 AS n, 'SUCCESS' AS status, 'activity.csv' AS input_file, (SELECT count(*) FROM activity_raw) AS input_rows,
       0::BIGINT AS rejected_rows, (SELECT count(*) FROM fact) AS output_rows, 'PASS' AS validation_status, FALSE AS has_error
UNION ALL
SELECT 'RUN-2', 2, 'FAILED', 'dirty.csv', (SELECT count(*) FROM dirty_tagged),
       (SELECT count(*) FROM dirty_tagged WHERE reject_reason IS NOT NULL), 0, 'FAIL', TRUE
UNION ALL
SELECT 'RUN-3', 3, 'SUCCESS', 'activity.csv', (SELECT count(*) FROM activity_raw), 0, (SELECT count(*) FROM fact), 'PASS', FALSE""")


@register("run_records", sql("""
SELECT run_id, status, input_file, input_rows, rejected_rows, output_rows, validation_status, has_error, TRUE AS timed FROM run_log""",
    "run_log"))
def q_run_records(spark, sf_dir):
    """The records that the runs wrote, the failed one too; times are the run's own."""
    timed = (F.col("end_time") >= F.col("start_time")) & (F.col("duration_seconds") > 0)
    return Pu.runs(spark, P.delivery(spark, sf_dir)).select(
        "run_id", "status", "input_file", "input_rows", "rejected_rows", "output_rows", "validation_status",
        F.col("error_message").isNotNull().alias("has_error"), timed.alias("timed"))


@register("published_fact", sql("SELECT * FROM fact", "fact"))
def q_published_fact(spark, sf_dir):
    """Published by the good run, left alone by the failing one, unchanged by the repeated one."""
    return Pu.published(spark, P.delivery(spark, sf_dir), P.fact_table(spark, sf_dir).schema).select(*S.FACT_COLUMNS)


@register("landed_results", sql("""
SELECT 'RUN-1' AS run_id, 'PASS' AS validation_result, count(*) AS rows FROM activity_raw
UNION ALL SELECT 'RUN-3', 'PASS', count(*) FROM activity_raw
UNION ALL SELECT 'RUN-2', CASE WHEN reject_reason IS NULL THEN 'PASS' ELSE 'FAIL' END, count(*) FROM dirty_tagged GROUP BY 2""",
    "activity_raw", "dirty_tagged"))
def q_landed_results(spark, sf_dir):
    """Every landed row has its run and its validation result."""
    landed = spark.read.option("mergeSchema", "true").parquet(f"{P.delivery(spark, sf_dir)}/landing")
    return landed.groupBy("run_id", "validation_result").agg(F.count(F.lit(1)).alias("rows"))


@register("serve_gate_runs", sql("""
SELECT 'serve' AS gate, "check", passed, observed, expected FROM (
  SELECT unnest([{'check': 'latest_run_succeeded', 'passed': status = 'SUCCESS', 'observed': status, 'expected': 'SUCCESS'},
                 {'check': 'latest_run_validated', 'passed': validation_status = 'PASS', 'observed': validation_status, 'expected': 'PASS'},
                 {'check': 'latest_run_published', 'passed': output_rows > 0, 'observed': CAST(output_rows AS VARCHAR), 'expected': '> 0'}],
                recursive := true)
  FROM run_log ORDER BY n DESC LIMIT 3)""", "run_log"))
def q_serve_gate_runs(spark, sf_dir):
    """Gate 5 on the runs' own records."""
    return Ga.serve_gate(Pu.runs(spark, P.delivery(spark, sf_dir)))


@register("upserted_fact", sql("""
SELECT timestamp, grid_id, date, round(CASE WHEN date = (SELECT max(date) FROM fact) THEN 2 * total_activity ELSE total_activity END, 6)
         AS total_activity FROM fact""", "fact"))
def q_upserted_fact(spark, sf_dir):
    """The whole fact loaded, its last day loaded again and then twice with corrected (doubled) values."""
    fact = P.fact_table(spark, sf_dir).select("timestamp", "grid_id", "date", "total_activity")
    last = fact.where(F.col("date") == fact.agg(F.max("date")).scalar())
    path = shared_path(spark, "upserted")
    Pu.upsert(fact, path)
    Pu.upsert(last, path)
    for _ in range(2):
        Pu.upsert(last.withColumn("total_activity", 2 * F.col("total_activity")), path)
    return (spark.read.schema(fact.select("timestamp", "grid_id", "total_activity", "date").schema).parquet(path)
            .withColumn("total_activity", F.round("total_activity", 6)))


@register("merged_hours", sql("""
SELECT CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, grid_id, count(*) AS rows,
       round(CAST(SUM(CAST(coalesce(sms_in, 0) AS DECIMAL(38,10))) AS DOUBLE), 6) AS sms_in,
       round(CAST(SUM(CAST(coalesce(internet_activity, 0) AS DECIMAL(38,10))) AS DOUBLE), 6) AS internet_activity
FROM dirty_tagged WHERE reject_reason IS NULL GROUP BY 1, 2""", "dirty_tagged"))
def q_merged_hours(spark, sf_dir):
    """A1 as a stream over the events: every batch is merged, the newest hours are there at the end."""
    from cellwatch.streaming import daily_files as D
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select(*X.EVENT_COLUMNS))
    out, checkpoint = shared_path(spark, "merged"), shared_path(spark, "merged-checkpoint")
    D.run_to_completion(D.merge_hours(D.clean_stream(X.activity_dirty(stream)), out, checkpoint))
    return spark.read.parquet(out).select("timestamp", "grid_id", "rows", *(F.round(c, 6).alias(c) for c in ("sms_in", "internet_activity")))


@register("file_report", sql("""
SELECT source_file, count(*) AS rows, count(DISTINCT grid_id) AS distinct_grids, count(DISTINCT timestamp) AS distinct_timestamps,
       count(DISTINCT country_code) AS distinct_countries FROM dirty_typed GROUP BY source_file""", "dirty_typed"))
def q_file_report(spark, sf_dir):
    """A9 by file."""
    return Fa.source_report(C.typed_columns(C.rename_canonical(P.dirty_activity(spark, sf_dir))), "source_file")


# ---------------------------------------------------------------- read-back and recomputation

@register("read_back_check", sql("""
SELECT * FROM (SELECT 'read_back_rows' AS "check", TRUE AS passed, CAST(count(*) AS VARCHAR) AS expected FROM fact
UNION ALL SELECT 'read_back_partitions', TRUE, CAST(count(DISTINCT date) AS VARCHAR) FROM fact
UNION ALL SELECT 'read_back_schema', TRUE, '-'
UNION ALL SELECT 'read_back_digest', TRUE, '(a sum of hashes)')""", "fact"))
def q_read_back_check(spark, sf_dir):
    """The fact written by date and read again: rows, digest, types and folders."""
    found = write_checked(P.fact_table(spark, sf_dir), shared_path(spark, "checked"), "date")
    hidden = F.when(F.col("check") == "read_back_digest", "(a sum of hashes)").otherwise(F.col("expected"))
    return found.select("check", "passed", hidden.alias("expected"))


@register("recomputed_totals", sql("""
SELECT timestamp, grid_id, round(total_activity, 6) AS total_activity, round(total_activity, 6) AS recomputed, TRUE AS agrees FROM fact""",
    "fact"))
def q_recomputed_totals(spark, sf_dir):
    """Every group summed again by another route."""
    made = Q.recomputed_totals(P.fact_table(spark, sf_dir), P.clean_activity(spark, sf_dir))
    return made.withColumns({c: F.round(c, 6) for c in ("total_activity", "recomputed")})


add_cte("text_rows", ["dirty_tagged"], """
SELECT CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, grid_id, country_code FROM dirty_tagged WHERE reject_reason IS NULL""")
add_cte("all_rows", [], """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp, CAST(user_id // 15 + 1 AS INTEGER) AS grid_id,
       CAST(CASE WHEN value < 1 THEN -1 ELSE event_id % 7 END AS INTEGER) AS country_code FROM events""")


@register("multiset_difference", sql("""
SELECT timestamp, grid_id, country_code, greatest(sum(s), 0)::BIGINT AS only_left, greatest(-sum(s), 0)::BIGINT AS only_right
FROM (SELECT timestamp, grid_id, country_code, 1 AS s FROM (SELECT * FROM text_rows EXCEPT ALL SELECT * FROM all_rows)
      UNION ALL SELECT timestamp, grid_id, country_code, -1 FROM (SELECT * FROM all_rows EXCEPT ALL SELECT * FROM text_rows))
GROUP BY ALL""", "text_rows", "all_rows"))
def q_multiset_difference(spark, sf_dir):
    """Rows kept from the text path against all events (small values marked by country -1)."""
    from cellwatch.functions.columns import hour_floor
    kept = P.clean_split(spark, sf_dir)[0].selectExpr(f"{hour_floor('`timestamp`')} AS `timestamp`", "grid_id", "country_code")
    every = P.events(spark, sf_dir).selectExpr(f"{hour_floor('ts')} AS `timestamp`", "CAST(user_id DIV 15 + 1 AS INT) AS grid_id",
                                               "CAST(IF(value < 1, -1, event_id % 7) AS INT) AS country_code")
    return Q.multiset_difference(kept, every)


# ---------------------------------------------------------------- densifying within bounds

add_cte("stray", ["fact"], """
SELECT grid_id, timestamp + CASE WHEN grid_id = 1 AND timestamp = (SELECT max(timestamp) FROM fact WHERE grid_id = 1)
                                 THEN INTERVAL 40000 DAY ELSE INTERVAL 0 DAY END AS timestamp, total_activity FROM fact""")


def _with_stray(spark, sf_dir):
    """The fact, with the newest row of grid 1 misdated by 40,000 days."""
    fact = P.fact_table(spark, sf_dir)
    newest = fact.where("grid_id = 1").agg(F.max("timestamp")).scalar()
    moved = F.when((F.col("grid_id") == 1) & (F.col("timestamp") == newest), F.expr("INTERVAL 40000 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    return Fa.finish_fact(fact.withColumn("timestamp", F.col("timestamp") + moved))


@register("dense_with_stray_date", sql("""
SELECT grid_id, timestamp, coalesce(total_activity, 0.0) AS total_activity FROM (
  SELECT g.grid_id, CAST(h AS TIMESTAMP) AS timestamp, s.total_activity
  FROM (SELECT DISTINCT grid_id FROM stray WHERE timestamp < TIMESTAMP '2100-01-01') g,
       (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM (
          SELECT date_trunc('day', min(timestamp)) AS lo, CAST(date_trunc('day', max(timestamp)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi
          FROM stray WHERE timestamp < TIMESTAMP '2100-01-01'))
  LEFT JOIN stray s ON s.grid_id = g.grid_id AND s.timestamp = CAST(h AS TIMESTAMP)
  UNION ALL SELECT * FROM stray WHERE timestamp >= TIMESTAMP '2100-01-01')""", "stray"))
def q_dense_with_stray_date(spark, sf_dir):
    """D4 with a misdated row: it stays, and the table is not filled up to it."""
    rows = _with_stray(spark, sf_dir)
    return Fa.densify_hours(rows, Fa.plausible_span(rows)).select("grid_id", "timestamp", "total_activity")


@register("plausible_dates_gate", """SELECT 'plausible_dates' AS "check", FALSE AS passed, '1' AS observed, '0' AS expected""")
def q_plausible_dates_gate(spark, sf_dir):
    """The gate that reports it."""
    rows = _with_stray(spark, sf_dir)
    return Fa.span_findings(rows, Fa.plausible_span(rows))


@register("dense_hours_by_grid", sql("""
SELECT b.grid_id, b.timestamp, coalesce(f.total_activity, 0.0) AS total_activity
FROM (SELECT grid_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS TIMESTAMP) AS timestamp FROM (
        SELECT grid_id, date_trunc('day', min(timestamp)) AS lo,
               CAST(date_trunc('day', max(timestamp)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi FROM fact GROUP BY grid_id)) b
LEFT JOIN fact f ON f.grid_id = b.grid_id AND f.timestamp = b.timestamp""", "fact"))
def q_dense_hours_by_grid(spark, sf_dir):
    """D4 with every grid's own span."""
    return Fa.densify_hours(P.fact_table(spark, sf_dir), by_grid=True).select("grid_id", "timestamp", "total_activity")


# ---------------------------------------------------------------- ordered and mixed files

@register("ordered_output", sql("""
SELECT row_number() OVER (ORDER BY total_activity DESC, grid_id, timestamp) AS position, grid_id, timestamp, total_activity FROM fact""",
    "fact"))
def q_ordered_output(spark, sf_dir):
    """K9: the fact written in total order and numbered as its files hold it."""
    path = shared_path(spark, "ordered")
    fact = P.fact_table(spark, sf_dir).select("grid_id", "timestamp", "total_activity")
    Sk.write_ordered(fact, path, [F.desc("total_activity"), F.col("grid_id"), F.col("timestamp")])
    return Sk.read_ordered(spark, path).select("position", "grid_id", "timestamp", "total_activity")


@register("mixed_format_folder", sql("""
SELECT ['csv', 'csv.gz', 'parquet'][CAST(day(strptime(regexp_extract(source_file, '(\\d{4}-\\d{2}-\\d{2})', 1), '%Y-%m-%d')) % 3 AS INTEGER) + 1]
         AS source_format, timestamp, grid_id, country_code, sms_in, sms_out, call_in, call_out, internet_activity
FROM dirty_typed""", "dirty_typed"))
def q_mixed_format_folder(spark, sf_dir):
    """The days' files in three formats and column orders, read as one frame."""
    raw = P.dirty_activity(spark, sf_dir).drop("event_id")
    day = F.day(F.to_date(F.regexp_extract("source_file", r"(\d{4}-\d{2}-\d{2})", 1)))
    path = shared_path(spark, "mixed")
    names = [f.name for f in S.RAW_ACTIVITY_TEXT_SCHEMA]
    part = lambda k, columns: raw.where(day % 3 == k).select(*columns)
    Sk.write_csv(part(0, names), f"{path}/a")
    Sk.write_csv(part(1, names[::-1]), f"{path}/b", compression="gzip")
    part(2, [*names[3:], *names[:3]]).write.parquet(f"{path}/c")
    mixed = Fi.read_mixed(spark, path, S.RAW_ACTIVITY_TEXT_SCHEMA)
    return C.typed_columns(C.rename_canonical(mixed)).drop("source_file")
