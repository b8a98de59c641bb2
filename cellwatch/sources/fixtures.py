"""Adapters that give the driver's tables the shapes of the activity data model.

``events`` has five event types; each becomes one activity measure. Grid ids come from
``user_id div 15 + 1`` and country codes from ``event_id % 7``. The adapters are plain
projections and a grouped sum, so they scale with ``events`` and stay in one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.columns import exact_sum_sql, hour_floor
from cellwatch.sources.tables import read_table

# Event type that feeds each raw measure column.
EVENT_MEASURES = [
    ("click", "smsin"),
    ("view", "smsout"),
    ("signup", "callin"),
    ("error", "callout"),
    ("purchase", "internet"),
]
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
USERS_PER_GRID = 15
COUNTRY_MODULUS = 7


def _grid_of(user_id):
    return (F.floor(user_id / F.lit(USERS_PER_GRID)).cast("long") + 1).cast("int")


def read_events(spark, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", EVENT_COLUMNS)


def activity_raw(events: DataFrame) -> DataFrame:
    """Typed raw activity: one row per (hour, grid, country); unseen measures stay NULL."""
    keyed = events.selectExpr(
        f"{hour_floor('ts')} AS datetime",
        f"CAST(CAST(floor(user_id / {USERS_PER_GRID}D) AS BIGINT) + 1 AS INT) AS CellID",
        f"CAST(event_id % {COUNTRY_MODULUS} AS INT) AS countrycode",
        "event_type", "value")
    aggs = [F.expr(exact_sum_sql(f"CASE WHEN event_type = '{et}' THEN value END") + f" AS {name}")
            for et, name in EVENT_MEASURES]
    return keyed.groupBy("datetime", "CellID", "countrycode").agg(*aggs)


def activity_dirty(events: DataFrame) -> DataFrame:
    """Text raw activity, one row per event, with injected junk for the quarantine path.

    event_id % 103 = 0: unparseable datetime; % 101 = 0: missing CellID; click rows with
    % 97 = 0: a negative value, else % 89 = 0: a blank value. ``source_file`` names the daily
    file the row belongs to (the event's date), as ``_metadata.file_path`` would for real files.
    """
    eid = F.col("event_id")
    is_click = F.col("event_type") == "click"
    value_text = F.col("value").cast("string")
    click_text = (F.when(eid % 97 == 0, F.lit("-1.5"))
                  .when(eid % 89 == 0, F.lit(" "))
                  .otherwise(value_text))
    cols = [
        F.col("event_id"),
        F.concat(F.lit("sms-call-internet-mi-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("source_file"),
        F.when(eid % 103 == 0, F.lit("not-a-time"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("datetime"),
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
         .otherwise(_grid_of(F.col("user_id")).cast("string")).alias("CellID"),
        (eid % COUNTRY_MODULUS).cast("string").alias("countrycode"),
    ]
    for et, name in EVENT_MEASURES:
        text = click_text if et == "click" else value_text
        cols.append(F.when(F.col("event_type") == et, text).alias(name))
    return events.select(*cols)


def activity_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Larger typed raw activity for benchmarks: supplier = grid, ship date = timestamp."""
    return lineitem.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("datetime"),
        F.col("l_suppkey").cast("int").alias("CellID"),
        (F.col("l_orderkey") % COUNTRY_MODULUS).cast("int").alias("countrycode"),
        F.col("l_quantity").cast("double").alias("smsin"),
        F.col("l_extendedprice").cast("double").alias("smsout"),
        F.col("l_discount").cast("double").alias("callin"),
        F.col("l_tax").cast("double").alias("callout"),
        F.col("l_linenumber").cast("double").alias("internet"),
    )


def grid_id_range(events: DataFrame, drop_largest: bool = True) -> DataFrame:
    """Grid ids 1..g_max of the events (one aggregate over one column, then a generator).

    With ``drop_largest`` the last id is left out, so the unmatched-grid path is exercised.
    Bounded by the id domain (at most 10,000 cells for the city grid).
    """
    top = (F.floor(F.max("user_id") / F.lit(USERS_PER_GRID)).cast("int") + F.lit(0 if drop_largest else 1))
    return events.agg(top.alias("n")).select(F.explode(F.sequence(F.lit(1), F.col("n"))).alias("grid_id"))


def data_features(events: DataFrame) -> DataFrame:
    """GeoJSON feature lines whose shapes come from the events: per grid the ranges of value and of
    event_id % 1000 span a box. By grid_id % 4: a triangle, a rectangle, a MultiPolygon of both, a ring
    without area; every fifth grid comes twice (the second time moved by 1)."""
    box = events.selectExpr(f"CAST(user_id DIV {USERS_PER_GRID} + 1 AS INT) AS g", "value",
                            "CAST(event_id % 1000 AS DOUBLE) AS e").groupBy("g").agg(
        F.min("value").alias("x0"), F.max("value").alias("x1"), F.min("e").alias("y0"), F.max("e").alias("y1"))
    box = box.select("*", F.explode(F.when(F.col("g") % 5 == 0, F.array(F.lit(0.0), F.lit(1.0))).otherwise(
        F.array(F.lit(0.0)))).alias("d"))
    x0, x1, y0, y1 = (F.round(F.col(c) + F.col("d"), 6) for c in ("x0", "x1", "y0", "y1"))
    ring = lambda *points: F.array(*(F.array(*p) for p in points))
    triangle = ring((x0, y0), (x1, y0), (x0, y1), (x0, y0))
    rectangle = ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    line = ring((x0, y0), (x1, y0), (x0, y0))
    kind = F.col("g") % 4
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(
        F.when(kind == 0, triangle).when(kind == 1, rectangle).otherwise(line)).alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(
        F.array(rectangle), F.array(triangle)).alias("coordinates")))
    return box.select(F.concat(F.lit('{"type":"Feature","properties":{"cellId":'), F.col("g").cast("string"),
                               F.lit('},"geometry":'), F.when(kind == 2, multi).otherwise(polygon), F.lit("}")).alias("value"))


def grid_reference_features(grid_ids: DataFrame) -> DataFrame:
    """GeoJSON feature lines (one JSON object per grid) for the given grid ids.

    Square cells on a 100 x 100 lattice: corner (9.01 + 0.003*col, 45.35 + 0.002*row) with
    sides 0.003 x 0.002, closed ring of five points. Output column ``value`` holds the JSON
    text, exactly what ``spark.read.text`` gives for a newline-delimited feature file.
    """
    ids = grid_ids.select(F.col("grid_id").cast("int").alias("g")).where(F.col("g").isNotNull())
    row = F.floor((F.col("g") - 1) / 100)
    col = (F.col("g") - 1) % 100
    x0 = F.round(F.lit(9.01) + F.lit(0.003) * col, 6)
    y0 = F.round(F.lit(45.35) + F.lit(0.002) * row, 6)
    x1 = F.round(x0 + F.lit(0.003), 6)
    y1 = F.round(y0 + F.lit(0.002), 6)
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("g").alias("cellId")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    return ids.select(F.to_json(feature).alias("value"))
