"""Write, audit, publish: runs that land a file, check it, and only then change the published table.

Folders under a root: ``landing/run_id=...`` (every row of every run with its validation result),
``published`` (the hourly fact by date), ``health`` (one row for each run, failed ones too). Rows reach
``published`` through a staged table that has passed its gates, by one job that swaps the touched date
partitions. A run that is repeated gives the same published table.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.operators import clean as C
from cellwatch.operators import facts as Fa
from cellwatch.operators import gates as Ga
from cellwatch.operators import health as He
from cellwatch.operators import quality as Q
from cellwatch.operators.readback import write_checked
from cellwatch.session import ensure_checkpoint_dir
from cellwatch.sources.sinks import write_parquet

HEALTH_ORDER = [f.name for f in S.HEALTH_SCHEMA]


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, or no rows where nothing was written yet."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def upsert(rows: DataFrame, path: str, key=S.FACT_KEY, partition_by: str = "date") -> DataFrame:
    """Put ``rows`` into the table at ``path``; a row with a known key takes the old one's place.

    The touched partitions are merged into a staging table, which is read back and checked, and then
    swapped in by one job; other partitions are not read or written. A key must stand in one partition and
    once in ``rows`` (checked). Returns the findings; raises before anything is published if one failed.
    """
    spark = rows.sparkSession
    rows = rows.select(*(c for c in rows.columns if c != partition_by), partition_by)
    Q.enforce(Q.unique_grain(rows, key))
    touched = [r[0] for r in rows.select(partition_by).distinct().collect()]   # one value for each day of the load
    if not touched:
        return Q.static_findings(spark, [("nothing_to_load", True, "0", "-")])
    old = read_if_there(spark, path, rows.schema)
    here = F.col(partition_by).isin([t for t in touched if t is not None])
    old = old.where(here | F.col(partition_by).isNull() if None in touched else here)
    new = rows.select(*(F.col(k).alias(f"__{k}") for k in key))
    match = F.lit(True)
    for k in key:
        match = match & old[k].eqNullSafe(F.col(f"__{k}"))
    merged = old.join(new, match, "left_anti").unionByName(rows)
    staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    found = Q.enforce(write_checked(merged, staged, partition_by))
    write_parquet(spark.read.schema(rows.schema).parquet(staged), path, partition_by=partition_by)
    return found


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def run_load(raw_text: DataFrame, root: str, run_id: str, input_file: str) -> dict:
    """One run over a raw file's rows: land, audit, publish; its health record is written whatever happens.

    Input and rejected rows are counted by the job that lands them, output rows by the job that stages
    them. A failed gate (a time or grid id that does not parse, a column missing, a fact of the wrong
    grain) leaves ``published`` as it was and is named in the record; any other error is recorded and
    raised again. Returns the record.
    """
    spark = raw_text.sparkSession
    start, counts = _now(), {"input_rows": 0, "rejected_rows": 0, "output_rows": 0}
    status, validation, message, error = "FAILED", "FAIL", None, None
    try:
        landing = f"{root}/landing/run_id={run_id}"
        seen = Observation("landed")
        tagged = C.tag_rows(raw_text).withColumn("validation_result", F.when(F.col("reject_reason").isNull(), "PASS").otherwise("FAIL"))
        reason = F.col("reject_reason")
        write_parquet(tagged, landing, watch=lambda d: d.observe(
            seen, F.count(F.lit(1)).alias("input_rows"), F.count_if(reason.isNotNull()).alias("rejected_rows"),
            F.count_if(reason == "invalid_timestamp").alias("times"), F.count_if(reason == "invalid_grid_id").alias("grids")))
        counts.update({k: seen.get[k] for k in ("input_rows", "rejected_rows")})
        landed = spark.read.schema(tagged.schema).parquet(landing)
        Q.enforce(Q.combine(Q.required_columns(raw_text, Ga.RAW_REQUIRED), Q.static_findings(spark, [
            ("valid_timestamp", seen.get["times"] == 0, str(seen.get["times"]), "0"),
            ("valid_grid_id", seen.get["grids"] == 0, str(seen.get["grids"]), "0")])))
        fact = Fa.hourly_grid_summary(C.curate(landed.where(reason.isNull())))
        staged = f"{root}/staged/run_id={run_id}"
        Q.enforce(write_checked(fact, staged, "date"))
        fact = spark.read.schema(fact.schema).parquet(staged)
        Q.enforce(Q.combine(Q.unique_grain(fact), Q.forbidden_columns(fact), Q.required_columns(fact, S.FACT_COLUMNS)))
        counts["output_rows"] = fact.count()
        upsert(fact, f"{root}/published")
        status, validation = "SUCCESS", "PASS"
    except Q.QualityGateError as gate:
        message = f"failed gates: {gate}"
    except Exception as other:
        message, error = f"{type(other).__name__}: {str(other)[:500]}", other
    end = _now()
    record = He.record_run(spark, run_id, start, end, status, input_file, counts["input_rows"], counts["rejected_rows"],
                           counts["output_rows"], validation, message)
    record.coalesce(1).write.mode("append").parquet(f"{root}/health")
    if error is not None:
        raise error
    return record.first().asDict()


def published(spark: SparkSession, root: str, schema) -> DataFrame:
    """The published fact (no rows before the first good run)."""
    return read_if_there(spark, f"{root}/published", schema)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The health records of all runs; a run that was repeated has one for each time."""
    return read_if_there(spark, f"{root}/health", S.HEALTH_SCHEMA)
