"""Sinks (S9-S15, S18). Writers return nothing; read-back checks live in operators.quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite",
                  compression: str = "snappy", rebalance: bool = True, watch=lambda df: df) -> None:
    """Parquet, optionally date-partitioned with dynamic partition overwrite.

    With ``partition_by`` the rows are rebalanced on the partition columns first (AQE splits
    a hot date into several files instead of one huge task), then sorted within partitions.
    ``watch`` is applied to the frame as it is written (to observe it in the writing tasks).
    """
    out = df
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        if rebalance:
            out = out.hint("rebalance", *cols)
        out = out.sortWithinPartitions(*cols)
        (watch(out).write.mode(mode).option("compression", compression)
         .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))
    else:
        watch(out).write.mode(mode).option("compression", compression).parquet(path)


def write_ordered(df: DataFrame, path: str, order, mode: str = "overwrite") -> None:
    """K9: Parquet in total order: range partitions, sorted inside, and the files' numbers rise with the key."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def read_ordered(spark: SparkSession, path: str, out: str = "position") -> DataFrame:
    """A table of ``write_ordered`` with each row's place (from 1) in the order of its files."""
    from cellwatch.operators.windows import number_rows
    name = F.col("_metadata.file_name")
    # part-<task>-<id>-c<file>: by task, then by the file a task wrote.
    part = (F.regexp_extract(name, r"^part-(\d+)", 1).cast("long") * 1_000_000
            + F.coalesce(F.expr("try_cast(nullif(regexp_extract(_metadata.file_name, '-c([0-9]+)', 1), '') AS BIGINT)"), F.lit(0)))
    rows = spark.read.parquet(path).select("*", part.alias("__part"), F.col("_metadata.row_index").alias("__row"))
    return number_rows(rows, "__part", "__row", out)


SINGLE_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False, compression: str = "none") -> None:
    """CSV with header. ``single_file`` is for small, already aggregated results: beyond
    ``SINGLE_FILE_ROWS`` rows (a check that reads no further) it raises instead of filling one task."""
    if single_file and df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows do not go into a single file")
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", "true").option("compression", compression)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_table(df: DataFrame, name: str, mode: str = "append", partition_by=None,
                bucket_by: tuple[int, str] | None = None) -> None:
    """Managed table load; bucketing on the join key keeps later joins shuffle-free."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batchsize: int = 5000,
               mode: str = "append") -> None:
    """S15 option: a JDBC warehouse load in 5,000-row batches (needs the driver jar)."""
    df.write.mode(mode).option("batchsize", batchsize).jdbc(url, table, properties=properties)


def directory_bytes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Bytes and file count of an output, from file metadata only (content pruned)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count("*").alias("files")))


def size_comparison(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """CSV bytes, Parquet bytes and their ratio in one row."""
    parquet_bytes = directory_bytes(spark, parquet_path, "*.parquet").select("bytes").scalar()
    return (directory_bytes(spark, csv_path, "*.csv")
            .select(F.col("bytes").alias("csv_bytes"), parquet_bytes.alias("parquet_bytes"))
            .withColumn("ratio", F.try_divide(F.col("csv_bytes"), F.col("parquet_bytes"))))
