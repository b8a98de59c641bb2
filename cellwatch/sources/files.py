"""File sources of the activity data.

Raw activity comes as many daily CSV files. They are scanned by Spark in one job with an
explicit schema (no inference pass), splittable, with provenance taken from the hidden
``_metadata`` column instead of ``input_file_name``.
"""

from __future__ import annotations

import zlib
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S


def _reader(spark: SparkSession, schema, **options):
    r = spark.read.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r


def read_activity_csv(spark: SparkSession, path: str, schema=S.RAW_ACTIVITY_SCHEMA,
                      pattern: str = S.RAW_FILE_GLOB, with_source: bool = True,
                      corrupt_column: str | None = None) -> DataFrame:
    """S1+S2+S4: every file under ``path`` matching ``pattern`` as one DataFrame.

    PERMISSIVE mode keeps malformed rows (fields become NULL or land in ``corrupt_column``).
    Raises when no file matches, like the reference's discovery step.
    """
    full = schema
    opts = {"header": "true", "mode": "PERMISSIVE", "pathGlobFilter": pattern,
            "recursiveFileLookup": "true"}
    if corrupt_column:
        from pyspark.sql import types as T
        full = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_column
    require_files(spark, path, pattern)
    df = _reader(spark, full, **opts).csv(path)
    if with_source:
        df = df.withColumns({
            "source_file": F.col("_metadata.file_path"),
            "ingested_at": F.current_timestamp().cast("timestamp_ntz"),
        })
    return df


def require_files(spark: SparkSession, path: str, pattern: str = S.RAW_FILE_GLOB) -> DataFrame:
    """S1 discovery as a DataFrame: (path, length) of matching files; raises when empty.

    Only file metadata is listed (binaryFile with the content column pruned away).
    """
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .option("recursiveFileLookup", "true").load(path)
                 .select("path", "length"))
    except AnalysisException as exc:  # the folder itself does not exist
        raise FileNotFoundError(f"no files matching {pattern} under {path}") from exc
    if files.isEmpty():
        raise FileNotFoundError(f"no files matching {pattern} under {path}")
    return files


SNIFF_BYTES = 256 << 20   # larger files are not opened to find their format: their name has to say it
_HEAD = 1 << 16
# The first bytes of file formats.
_SIGNATURES = [(b"PAR1", "parquet"), (b"ORC", "orc"), (b"\x1f\x8b", "gzip")]


def _format_of(head: bytes) -> tuple[str, str]:
    """(format, header line) of a file's first bytes; text that is not JSON is taken as CSV with a header."""
    kind = next((k for sign, k in _SIGNATURES if head.startswith(sign)), "")
    if kind in ("parquet", "orc"):
        return kind, ""
    if kind == "gzip":
        head = zlib.decompressobj(31).decompress(head, _HEAD)
    text = head.decode("utf-8", "replace").lstrip("\ufeff")
    what = "json" if text.lstrip()[:1] in ("{", "[") else "csv"
    return f"{what}.gz" if kind else what, text.splitlines()[0] if what == "csv" and text.strip() else ""


def file_formats(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, format, header) of every file, by its first bytes (hidden and empty files left out).

    Only files up to ``SNIFF_BYTES`` are opened, so a task's memory is bounded; a larger one needs a name
    that ends in its format.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    listed = listed.where(F.col("length") > 0)

    @F.pandas_udf("format string, header string")
    def sniff(heads: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_format_of(h) for h in heads], columns=["format", "header"])

    small = (listed.where(F.col("length") <= SNIFF_BYTES).select("path", "length", F.substring("content", 1, _HEAD).alias("head"))
             .select("path", "length", sniff("head").alias("s")).select("path", "length", "s.format", "s.header"))
    large = listed.where(F.col("length") > SNIFF_BYTES).select(
        "path", "length", F.regexp_extract("path", r"\.(parquet|orc|json|json\.gz)$", 1).alias("format"), F.lit("").alias("header"))
    return small.unionByName(large)


def read_mixed(spark: SparkSession, path: str, schema, pattern: str = "*") -> DataFrame:
    """A folder of CSV, gzipped CSV, JSON lines, Parquet and ORC files as one frame.

    One scan for each format (and, of CSV, for each header, so that columns are found by name, not by
    place). Columns are matched by name in any case; a missing one is NULL, others are left out; values
    that do not fit the type are NULL. Adds ``source_file`` and ``source_format``. Raises for no file, a format that
    cannot be told, and gzip content whose name does not end in .gz (Spark would read it as it is).
    """
    require_files(spark, path, pattern)
    groups: dict[tuple[str, str], list[str]] = {}
    for r in file_formats(spark, path, pattern).collect():   # names only: a list that the driver has anyway
        if not r["format"]:
            raise ValueError(f"unknown format of {r['path']}")
        if r["format"].endswith(".gz") and not r["path"].endswith(".gz"):
            raise ValueError(f"gzip content without .gz in its name: {r['path']}")
        groups.setdefault((r["format"], r["header"]), []).append(r["path"])
    frames = []
    for (kind, header), paths in sorted(groups.items()):
        base = kind.removesuffix(".gz")
        if base == "csv":
            df = spark.read.option("header", "true").option("enforceSchema", "false").csv(paths)
        elif base == "json":
            df = spark.read.schema(", ".join(f"`{f.name}` string" for f in schema.fields)).json(paths)
        else:
            df = spark.read.option("mergeSchema", "true").format(base).load(paths)
        have = {c.strip().lower(): c for c in df.columns}
        columns = [F.expr(f"try_cast(`{have[f.name.lower()]}` AS {f.dataType.simpleString()})").alias(f.name)
                   if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        frames.append(df.select(*columns, F.col("_metadata.file_path").alias("source_file"), F.lit(kind).alias("source_format")))
    return reduce(DataFrame.unionByName, frames)
