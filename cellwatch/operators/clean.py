"""Cleaning and quarantine.

Every raw boundary uses try_* functions, so junk becomes NULL under ANSI mode instead of
failing the job. The reject predicate is NULL-safe: each row is either kept or rejected,
never silently lost, so ``kept + rejected = input`` holds by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S


# The raw time format, yyyy-MM-dd HH:mm:ss.
_TIME_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Strip + lower every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def rename_canonical(df: DataFrame, strict: bool = False) -> DataFrame:
    """Raw names -> canonical names; the tolerant form renames only the columns present."""
    present = {k: v for k, v in S.RENAME_MAP.items() if k in df.columns}
    if strict and len(present) != len(S.RENAME_MAP):
        missing = sorted(set(S.RENAME_MAP) - set(present))
        raise ValueError(f"missing raw columns: {missing}")
    return df.withColumnsRenamed(present)


def _parsed_time(text: str) -> str:
    """SQL text: TIMESTAMP_NTZ of ``yyyy-MM-dd HH:mm:ss``, without a way through the session zone."""
    return f"CASE WHEN ({text}) RLIKE '{_TIME_SHAPE}' THEN try_cast(({text}) AS TIMESTAMP_NTZ) END"


def parse_timestamp(col):
    """Text or timestamp -> TIMESTAMP_NTZ; unparseable text -> NULL."""
    return F.expr(_parsed_time(f"CAST(`{col}` AS STRING)"))


def typed_columns(df: DataFrame) -> DataFrame:
    """Canonical columns with their types; blank text is NULL, junk is NULL.

    Only text columns go through trim / blank / try_cast; columns that already carry a
    numeric or timestamp type keep a plain (no-op or widening) cast. One projection.
    """
    types = dict(df.dtypes)

    def parsed(c: str, target: str) -> str:
        if types.get(c) == "string":
            return f"try_cast(nullif(trim(`{c}`), '') AS {target}) AS `{c}`"
        return f"try_cast(`{c}` AS {target}) AS `{c}`"

    if types.get("timestamp") == "string":
        ts = _parsed_time("trim(`timestamp`)") + " AS `timestamp`"
    else:
        ts = "CAST(`timestamp` AS TIMESTAMP_NTZ) AS `timestamp`"
    typed = {"timestamp": ts, "grid_id": parsed("grid_id", "INT"), "country_code": parsed("country_code", "INT")}
    typed.update({m: parsed(m, "DOUBLE") for m in S.MEASURES})
    return df.selectExpr(*[typed.get(c, f"`{c}`") for c in df.columns])


def blank_counts(df: DataFrame, columns) -> list:
    """P5 helper: one conditional count per text column (blank but not NULL)."""
    return [F.sum(F.when(F.trim(F.col(c).cast("string")) == "", 1).otherwise(0)).alias(f"blank_{c}")
            for c in columns]


def reject_reason_sql(grid_lo: int | None = None, grid_hi: int | None = None) -> str:
    """First failing rule, or NULL for a valid row. Never NULL because of a NULL measure.

    The id domain (P11) is a gate (``quality.valid_values``), not a quarantine rule: only a caller
    who passes a range has ids outside it rejected.
    """
    outside = "" if grid_lo is None else f" OR grid_id < {grid_lo}"
    outside += "" if grid_hi is None else f" OR grid_id > {grid_hi}"
    negative = " OR ".join(f"coalesce(`{m}` < 0, false)" for m in S.MEASURES)
    return (f"CASE WHEN `timestamp` IS NULL THEN 'invalid_timestamp' "
            f"WHEN grid_id IS NULL{outside} THEN 'invalid_grid_id' "
            f"WHEN {negative} THEN 'negative_activity' END")


def reject_reason(grid_lo: int | None = None, grid_hi: int | None = None):
    return F.expr(reject_reason_sql(grid_lo, grid_hi))


def tag_rows(raw: DataFrame, grid_lo: int | None = None, grid_hi: int | None = None) -> DataFrame:
    """Rename, type and tag each raw row with its reject reason (NULL = valid)."""
    typed = typed_columns(rename_canonical(raw))
    return typed.selectExpr("*", f"{reject_reason_sql(grid_lo, grid_hi)} AS reject_reason")


_CURATED = (["`timestamp`", "grid_id", "country_code"]
            + [f"coalesce(`{m}`, 0D) AS `{m}`" for m in S.MEASURES]
            + ["coalesce(sms_in, 0D) + coalesce(sms_out, 0D) AS total_sms",
               "coalesce(call_in, 0D) + coalesce(call_out, 0D) AS total_calls",
               "(coalesce(sms_in, 0D) + coalesce(sms_out, 0D)) + (coalesce(call_in, 0D) + coalesce(call_out, 0D))"
               " + coalesce(internet_activity, 0D) AS total_activity",
               "to_date(`timestamp`) AS date", "hour(`timestamp`) AS hour", "dayofweek(`timestamp`) AS day_of_week"])


def curate(valid: DataFrame) -> DataFrame:
    """P6-P8 on valid rows: NULL measures -> 0, totals, time parts, canonical column order."""
    return valid.selectExpr(*_CURATED)


def clean(raw: DataFrame, grid_lo: int | None = None, grid_hi: int | None = None, with_counts: bool = True):
    """(clean, rejected, counts). All three are lazy and share one tagged plan; ``counts``
    is None when ``with_counts`` is False (saves building a plan nobody runs)."""
    tagged = tag_rows(raw, grid_lo, grid_hi)
    kept = curate(tagged.where("reject_reason IS NULL"))
    rejected = tagged.where("reject_reason IS NOT NULL")
    return kept, rejected, (cleaning_counts(tagged) if with_counts else None)


def cleaning_counts(tagged: DataFrame) -> DataFrame:
    """One-pass counts of the split: input, kept, rejected by reason, NULL measure rows."""
    reason = F.col("reject_reason")
    null_measure = F.lit(False)
    for m in S.MEASURES:
        null_measure = null_measure | F.col(m).isNull()
    return tagged.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.sum(F.when(reason.isNull(), 1).otherwise(0)).alias("clean_rows"),
        F.sum(F.when(reason.isNotNull(), 1).otherwise(0)).alias("rejected_rows"),
        F.sum(F.when(reason == "invalid_timestamp", 1).otherwise(0)).alias("invalid_timestamp_rows"),
        F.sum(F.when(reason == "invalid_grid_id", 1).otherwise(0)).alias("invalid_grid_rows"),
        F.sum(F.when(reason == "negative_activity", 1).otherwise(0)).alias("negative_activity_rows"),
        F.sum(F.when(reason.isNull() & null_measure, 1).otherwise(0)).alias("clean_rows_null_filled"),
    )
