"""Daily activity files arriving one at a time, as a file stream.

The reference processes one daily file per run. As a stream: every new file is cleaned
in its micro-batch (stateless: the same tag / curate expressions as the batch path) and
appended exactly once to date partitions (file sink + checkpoint). The hourly roll-up is
a windowed aggregate with a watermark, so its state only holds hours that can still
change; ``trigger(availableNow=True)`` processes what is there and stops.

Checkpoints and outputs live under the shared checkpoint folder of the session
(``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import exact_sum, hour_floor
from cellwatch.operators import clean as C
from cellwatch.session import ensure_checkpoint_dir, written


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_daily_files(spark: SparkSession, path: str, pattern: str = S.RAW_FILE_GLOB,
                     max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming scan of raw daily CSVs (all text, explicit schema) with the source file."""
    return (spark.readStream.schema(S.RAW_ACTIVITY_TEXT_SCHEMA)
            .option("header", "true").option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def clean_stream(raw: DataFrame) -> DataFrame:
    """Valid rows of each micro-batch, curated exactly like the batch path."""
    return C.clean(raw, with_counts=False)[0]


def write_clean(clean: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Exactly-once append of clean rows to date partitions; returns the started query."""
    w = (clean.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .partitionBy("date").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


HOUR_COLUMNS = [*S.FACT_KEY, *S.MEASURES, "rows", "late_rows", "last_batch", "date"]


def merge_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Add a micro-batch of clean rows to the hourly table at ``out``, late ones too.

    The batch is rolled up, added to the rows that its hours have so far, and put in their place by one job
    that swaps the touched dates. A row remembers the last batch that it holds, so a batch that comes again
    after a failure is not added twice. ``late_rows`` counts rows that came after their hour had been written.
    """
    from cellwatch.operators.publish import read_if_there, upsert
    spark = batch.sparkSession
    hour = F.expr(hour_floor("`timestamp`"))
    new = (batch.withColumn("timestamp", hour).groupBy(*S.FACT_KEY)
           .agg(*[exact_sum(m).alias(m) for m in S.MEASURES], F.count(F.lit(1)).alias("rows"))
           .select(*S.FACT_KEY, *S.MEASURES, "rows", F.lit(0).cast("bigint").alias("late_rows"),
                   F.lit(batch_id).cast("bigint").alias("last_batch"), F.to_date("timestamp").alias("date")))
    new = written(new, "batch")
    old = read_if_there(spark, out, new.schema).select(*S.FACT_KEY, F.struct(*HOUR_COLUMNS[2:]).alias("old"))
    seen = F.col("old").isNotNull()
    # What a first try of this batch merged already stays as it is.
    done = seen & (F.col("old.last_batch") >= batch_id)
    sums = [F.when(seen, F.col(f"old.{c}") + F.col(c)).otherwise(F.col(c)).alias(c) for c in (*S.MEASURES, "rows")]
    merged = (new.join(old, S.FACT_KEY, "left").where(~F.coalesce(done, F.lit(False)))
              .select(*S.FACT_KEY, *sums, F.when(seen, F.col("old.late_rows") + F.col("rows")).otherwise(F.col("late_rows")).alias("late_rows"),
                      "last_batch", "date"))
    upsert(written(merged, "merged"), out)


def merge_hours(clean: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """A1 as a stream that loses nothing: every micro-batch is merged into the hourly table at ``out``, so
    late rows and the newest hours are in it when the batch ends. Returns the started query."""
    w = (clean.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, out))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def hourly_rollup(clean: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Watermarked hourly grid roll-up (A1 as a stream): emits an hour once it is final, and leaves out what
    comes later still. ``merge_hours`` is the form that keeps every row."""
    # Watermarks need an LTZ timestamp; the NTZ value is reinterpreted in the session zone.
    return (clean.withColumn("event_time", F.col("timestamp").cast("timestamp"))
            .withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 hour").alias("w"), "grid_id")
            .agg(*[exact_sum(m).alias(m) for m in S.MEASURES])
            .select(F.col("w.start").cast("timestamp_ntz").alias("timestamp"), "grid_id", *S.MEASURES))


def run_to_completion(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
