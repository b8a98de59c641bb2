"""Schemas, column lists and fixed values of the activity data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw daily activity file: explicit schema, never inferred.
RAW_ACTIVITY_SCHEMA = T.StructType([
    T.StructField("datetime", T.StringType()),
    T.StructField("CellID", T.IntegerType()),
    T.StructField("countrycode", T.IntegerType()),
    T.StructField("smsin", T.DoubleType()),
    T.StructField("smsout", T.DoubleType()),
    T.StructField("callin", T.DoubleType()),
    T.StructField("callout", T.DoubleType()),
    T.StructField("internet", T.DoubleType()),
])

# Same columns, all text: the quarantine path reads files this way so that junk survives
# the scan and is judged by the cleaning rules instead of the CSV reader.
RAW_ACTIVITY_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_ACTIVITY_SCHEMA])

# Canonical rename of the raw activity columns.
RENAME_MAP = {
    "datetime": "timestamp",
    "CellID": "grid_id",
    "countrycode": "country_code",
    "smsin": "sms_in",
    "smsout": "sms_out",
    "callin": "call_in",
    "callout": "call_out",
    "internet": "internet_activity",
}

MEASURES = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity"]
TOTALS = ["total_sms", "total_calls", "total_activity"]

CLEAN_COLUMNS = ["timestamp", "grid_id", "country_code", *MEASURES, *TOTALS,
                 "date", "hour", "day_of_week"]

FACT_COLUMNS = ["timestamp", "grid_id", "sms_in", "sms_out", "call_in", "call_out",
                "total_sms", "total_calls", "internet_activity", "total_activity",
                "internet_share", "hour", "day_of_week", "date"]

FACT_KEY = ["timestamp", "grid_id"]

# The grid id domain of the city grid and the raw file name pattern.
GRID_ID_MIN = 1
GRID_ID_MAX = 10000
RAW_FILE_GLOB = "sms-call-internet-mi-*.csv"
GEOMETRY_REFERENCE_PREFIX = "milano-grid.geojson#cellId="

# Severity bands (lower bounds) and texts of the serving queries.
SEVERITY_BANDS = (1000.0, 5000.0, 10000.0)  # medium, high, critical
HOTSPOT_REASONS = {
    "critical": "Extremely high network activity detected.",
    "high": "High network activity detected.",
    "medium": "Elevated network activity detected.",
    "low": "Normal network activity.",
}
ALERT_REASONS = {
    "critical": "Critical network activity threshold exceeded.",
    "high": "High network activity threshold exceeded.",
    "medium": "Elevated network activity threshold exceeded.",
    "low": "No significant network activity anomaly.",
}

# Rule-alert multipliers and the activity floor percentile.
HIGH_ACTIVITY_MULTIPLIER = 1.5
DROP_MULTIPLIER = 0.5
SPIKE_MULTIPLIER = 1.5
FLOOR_PERCENTILE = 0.25
MAX_ALERT_SHARE = 0.25

# ML layer parameters.
FEATURE_COLUMNS = ["avg_activity", "activity_growth", "active_hours",
                   "peak_ratio", "variability", "internet_share"]
MODEL_VERSION = "risk-classifier-logistic-regression-v1"
RECENT_HOURS = 24
BASELINE_HOURS = 24
MIN_HISTORY_HOURS = 48
LABEL_HORIZON_HOURS = 1
POSITIVE_PERCENTILE = 0.90
TRAIN_RATIO = 0.8
ANOMALY_THRESHOLD = 50.0
RISK_THRESHOLD = 0.5

# Three-way comparison categories in the order they are tested, keyed by
# (anomaly flag, rule alert flag, model flag); anything else is ALL_AGREE.
DISAGREEMENT_CATEGORIES = [
    ((1, 0, 0), "ANOMALY_ONLY"),
    ((0, 1, 0), "NP3_ONLY"),
    ((0, 0, 1), "ML3_ONLY"),
    ((1, 1, 0), "ANOMALY_NP3_ONLY"),
    ((1, 0, 1), "ANOMALY_ML3_ONLY"),
    ((0, 1, 1), "NP3_ML3_ONLY"),
]
DISAGREEMENT_DEFAULT = "ALL_AGREE"

# Pipeline health contract.
HEALTH_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("input_file", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("rejected_rows", T.LongType()),
    T.StructField("output_rows", T.LongType()),
    T.StructField("validation_status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
