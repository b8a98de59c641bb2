"""Run health records (D17) and run metrics.

A health record is one row per run in an append-only table; ``latest_runs`` answers the
serve-readiness questions (latest successful / failed run) with one grouped ``max_by``.
Metrics of a stage are one aggregate row unpivoted to (run_id, stage, name, value).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import hour_floor

PIPELINE_NAME = "telecom_network_pipeline"


def record_run(spark: SparkSession, run_id: str, start_time: datetime, end_time: datetime, status: str,
               input_file: str | None, input_rows: int, rejected_rows: int, output_rows: int,
               validation_status: str, error_message: str | None = None,
               pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """One health row for a run that just finished (to be appended by the caller)."""
    duration = (end_time - start_time).total_seconds()
    return spark.createDataFrame([(run_id, pipeline_name, start_time, end_time, status, input_file, input_rows,
                                   rejected_rows, output_rows, validation_status, error_message, duration)],
                                 S.HEALTH_SCHEMA)


def file_runs(tagged: DataFrame, pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """Health rows of daily-file runs derived from a tagged (quarantine) frame with ``source_file``:
    input / rejected / published rows per file. A file passes when its raw gates do (every timestamp
    and grid id valid); the message names the gates that failed. Published rows are the file's hourly
    grid rows. The span of the file's data stands in for start/end."""
    valid = F.col("reject_reason").isNull()
    hour_key = F.when(valid, F.struct(F.expr(hour_floor("timestamp")).alias("h"), F.col("grid_id").alias("g")))
    per_file = tagged.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.sum(F.when(~valid, 1).otherwise(0)).cast("long").alias("rejected_rows"),
        F.count_distinct(hour_key).alias("output_rows"),
        F.count_if(F.col("reject_reason") == "invalid_timestamp").alias("bad_times"),
        F.count_if(F.col("reject_reason") == "invalid_grid_id").alias("bad_grids"),
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"))
    failed = F.concat_ws(", ", F.when(F.col("bad_times") > 0, "valid_timestamp"), F.when(F.col("bad_grids") > 0, "valid_grid_id"))
    ok = failed == ""
    day = F.regexp_extract(F.col("source_file"), r"(\d{4}-\d{2}-\d{2})", 1)
    return per_file.select(
        F.concat(F.lit("RUN-"), day, F.lit("-001")).alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        F.col("end_time").cast("timestamp_ntz").alias("end_time"),
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("source_file").alias("input_file"),
        "input_rows", "rejected_rows", F.col("output_rows").cast("long").alias("output_rows"),
        F.when(ok, "PASS").otherwise("FAIL").alias("validation_status"),
        F.when(ok, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("failed gates: "), failed)).alias("error_message"),
        F.lit(None).cast("double").alias("duration_seconds"))


def latest_runs(health: DataFrame) -> DataFrame:
    """Latest run per (pipeline, status) by end time (run_id breaks ties)."""
    rec = F.struct("run_id", "end_time", "input_file", "input_rows", "rejected_rows", "output_rows",
                   "validation_status")
    return (health.groupBy("pipeline_name", "status")
            .agg(F.max_by(rec, F.struct("end_time", "run_id")).alias("r"))
            .select("pipeline_name", "status", "r.*"))


def stage_metrics(run_id: str, stage: str, one_row: DataFrame) -> DataFrame:
    """A one-row metrics frame unpivoted to (run_id, stage, name, value double)."""
    cols = one_row.columns
    return (one_row.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "name", "value")
            .select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "name", "value"))
