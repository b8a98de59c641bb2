"""Read-back checks of written tables.

A table's digest is its row count and the sum of a 64-bit hash of every row: it does not depend on the
order of rows or files, repeated rows count as often as they stand, and it is taken by Spark while the
table is written (``DataFrame.observe``), so checking costs one scan of what was written and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellwatch.operators import quality as Q


def digest(columns) -> list[Column]:
    """``rows`` and ``row_hashes`` of the named columns as aggregates (wide enough for any table)."""
    row = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(columns)))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("row_hashes")]


def observed(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, Observation]:
    """``df`` that reports its digest (and further aggregates) when a job on it ends."""
    seen = Observation(name)
    return df.observe(seen, *digest(df.columns), *more), seen


def findings(written: DataFrame, expected: dict, path: str, partition_by: str | None = None,
             partitions: int | None = None) -> DataFrame:
    """What the files under ``path`` hold against what was written: rows, row digest, names and types,
    and the folders of the partition column."""
    spark = written.sparkSession
    back = spark.read.parquet(path)
    want = {k: v for k, v in written.dtypes}
    have = dict(back.dtypes)
    # The type of a folder's value is read off its name, so it is compared as text.
    names = sorted(f"{k}:{have.get(k, 'missing')}" for k in want if k != partition_by and have.get(k) != want[k])
    names += sorted(f"{k}:unknown" for k in have if k not in want)
    same = spark.read.schema(written.schema).parquet(path)
    count = [F.count_distinct(partition_by).alias("values")] if partition_by and partitions is None else []
    got = same.agg(*digest(written.columns), *count).first()
    rows = [("read_back_rows", got["rows"] == expected["rows"], str(got["rows"]), str(expected["rows"])),
            ("read_back_digest", got["row_hashes"] == expected["row_hashes"], got["row_hashes"], expected["row_hashes"]),
            ("read_back_schema", not names, ";".join(names) or "-", "-")]
    if partition_by:
        # Folders as the paths of the files (each looked at once) name them; a NULL has a folder but is no distinct value.
        folder = F.regexp_extract(F.col("path"), f"/{partition_by}=([^/]*)/", 1)
        paths = same.select(F.col("_metadata.file_path").alias("path")).distinct()
        folders = paths.select(folder.alias("f")).agg(
            F.count_distinct("f").alias("n"), F.count_if(F.col("f") == "").alias("outside")).first()
        wanted = partitions if partitions is not None else got["values"]
        rows.append(("read_back_partitions", folders["n"] == wanted and not folders["outside"], str(folders["n"]), str(wanted)))
    return Q.static_findings(spark, rows)


def write_checked(df: DataFrame, path: str, partition_by: str | None = None, **options) -> DataFrame:
    """Write Parquet, read it back and return the findings (nothing raises: pass them to ``enforce``).

    ``options`` go to ``sinks.write_parquet``. The digest is taken in the tasks that write.
    """
    from cellwatch.sources.sinks import write_parquet
    if partition_by:
        df = df.select(*(c for c in df.columns if c != partition_by), partition_by)
    # The partition's values (one for each folder) are seen by the writing tasks too, so df is computed once.
    values = [F.collect_set(partition_by).alias("values"), F.max(F.col(partition_by).isNull()).alias("nulls")] if partition_by else []
    seen = Observation("written")
    write_parquet(df, path, partition_by=partition_by, watch=lambda d: d.observe(seen, *digest(df.columns), *values), **options)
    got = seen.get
    return findings(df, got, path, partition_by, len(got["values"]) + bool(got["nulls"]) if partition_by else None)
