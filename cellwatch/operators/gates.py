"""Named quality gates (G20) and the ingest composite.

A gate is a union of findings from the checks in ``quality``; ``enforce`` raises on any
failed finding, so a failed gate is never silently treated as success.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.operators import facts as Fa
from cellwatch.operators import quality as Q
from cellwatch.sources import files as Fi

RAW_REQUIRED = list(S.RENAME_MAP)


def _tag(gate: str, findings: DataFrame) -> DataFrame:
    return findings.select(F.lit(gate).alias("gate"), "*")


def landing_gate(raw_text: DataFrame, columns=RAW_REQUIRED) -> DataFrame:
    """Gate 1 (landing), on text rows: expected columns, timestamps and grid ids that parse, measures
    of a valid type, no repeated record."""
    from cellwatch.operators.clean import rename_canonical, typed_columns
    text = raw_text.select(*columns)
    typed = typed_columns(rename_canonical(text))
    names = [S.RENAME_MAP[c] for c in columns if S.RENAME_MAP[c] in S.MEASURES]
    raw_of = {v: k for k, v in S.RENAME_MAP.items()}
    both = typed_columns(rename_canonical(text.select("*", *(F.col(raw_of[m]).alias(f"_text_{m}") for m in names))))
    bad = F.lit(False)
    for m in names:
        bad = bad | (F.col(m).isNull() & (F.trim(F.coalesce(F.col(f"_text_{m}"), F.lit(""))) != ""))
    types = both.agg(F.count_if(bad).alias("n")).select(*Q._finding("valid_measure_types", F.col("n") == 0, F.col("n"), "0"))
    repeated = (text.groupBy(*text.columns).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
                .select(*Q._finding("duplicate_records", F.col("n") == 0, F.col("n"), "0")))
    return _tag("landing", Q.combine(Q.required_columns(raw_text, columns), Q.valid_values(typed), types, repeated))


def analytics_gate(fact: DataFrame, fact_activity: DataFrame, dim_t: DataFrame, dim_g: DataFrame) -> DataFrame:
    """Gate 4 (analytics): the loaded warehouse holds every fact row and each key has its dimension row."""
    rows = fact.agg(F.count(F.lit(1))).scalar()
    loaded = fact_activity.agg(F.count(F.lit(1)).alias("n")).select(
        *Q._finding("warehouse_rows", F.col("n") == rows, F.col("n"), rows))
    orphans = fact_activity.agg(F.count_if(F.col("time_key").isNull() | F.col("grid_key").isNull()).alias("n")).select(
        *Q._finding("warehouse_keys", F.col("n") == 0, F.col("n"), "0"))
    unique = [dim.groupBy(k).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n")).select(
        *Q._finding(f"unique_{k}", F.col("n") == 0, F.col("n"), "0")) for dim, k in ((dim_t, "time_key"), (dim_g, "grid_key"))]
    return _tag("analytics", Q.combine(Q.unique_grain(fact), loaded, orphans, *unique))


def serve_gate(health: DataFrame) -> DataFrame:
    """Gate 5 (serve): the newest run is a successful one whose validation passed and that published rows."""
    newest = health.agg(F.max_by(F.struct("status", "validation_status", "output_rows"),
                                 F.struct("end_time", "run_id")).alias("r")).select("r.*")
    return _tag("serve", newest.select(F.inline(F.array(
        F.struct(*Q._finding("latest_run_succeeded", F.coalesce(F.col("status") == "SUCCESS", F.lit(False)), F.col("status"), "SUCCESS")),
        F.struct(*Q._finding("latest_run_validated", F.coalesce(F.col("validation_status") == "PASS", F.lit(False)),
                             F.col("validation_status"), "PASS")),
        F.struct(*Q._finding("latest_run_published", F.coalesce(F.col("output_rows") > 0, F.lit(False)), F.col("output_rows"), "> 0"))))))


def raw_gate(raw_canonical: DataFrame) -> DataFrame:
    """Gate 2 (raw): required columns, valid timestamps / grid ids, unique raw grain."""
    return _tag("raw", Q.combine(
        Q.required_columns(raw_canonical, ["timestamp", "grid_id", "country_code", *S.MEASURES]),
        Q.valid_values(raw_canonical),
        Q.grain_preserved(raw_canonical)))


def processed_gate(fact: DataFrame) -> DataFrame:
    """Gate 4 (processed / analytics): grain, expected dates x 24 hours, no forbidden columns,
    required analytics columns."""
    return _tag("processed", Q.combine(
        Q.unique_grain(fact),
        Q.expected_timestamps(fact),
        Q.forbidden_columns(fact),
        Q.required_columns(fact, S.FACT_COLUMNS)))


def ingest(spark: SparkSession, path: str, pattern: str = S.RAW_FILE_GLOB):
    """Discover -> read with explicit schema and provenance -> checks and reports.

    Returns (raw, findings, file_report, profile); nothing is executed until used.
    """
    from cellwatch.operators.clean import rename_canonical, typed_columns
    Fi.require_files(spark, path, pattern)
    raw = Fi.read_activity_csv(spark, path, pattern=pattern)
    canonical = typed_columns(rename_canonical(raw))
    findings = Q.combine(raw_gate(canonical).drop("gate"), Q.file_traceability(raw))
    report = Fa.source_report(canonical, "source_file")
    profile = Fa.dataset_profile(canonical.drop("source_file", "ingested_at"))
    return raw, findings, report, profile
