"""Data-quality gates.

A check returns a findings DataFrame ``(check, passed, observed, expected)``; counting
checks are one aggregate each. ``enforce`` is the only place that acts on findings: it
raises when any check failed. Schema checks (G1, G9) read metadata only and run no job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import epoch_seconds, exact_sum
from cellwatch.operators.facts import day_bounds

FINDINGS_DDL = "check string, passed boolean, observed string, expected string"


class QualityGateError(AssertionError):
    pass


def _finding(check: str, passed: Column, observed: Column, expected: Column | str) -> list[Column]:
    exp = expected if isinstance(expected, Column) else F.lit(str(expected))
    return [F.lit(check).alias("check"), passed.alias("passed"),
            observed.cast("string").alias("observed"), exp.cast("string").alias("expected")]


def static_findings(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FINDINGS_DDL)


def required_columns(df: DataFrame, required) -> DataFrame:
    """G1: schema compare, no job."""
    missing = sorted(set(required) - set(df.columns))
    return static_findings(df.sparkSession, [("required_columns", not missing, ",".join(missing) or "-", "-")])


def forbidden_columns(df: DataFrame, forbidden=("country_code", "geometry")) -> DataFrame:
    """Columns that must not survive a stage."""
    present = sorted(set(forbidden) & set(df.columns))
    return static_findings(df.sparkSession, [("forbidden_columns", not present, ",".join(present) or "-", "-")])


def schemas_match(expected: DataFrame, actual: DataFrame, label: str = "schema") -> DataFrame:
    """G12 helper: names and types both ways (metadata only)."""
    e, a = dict(expected.dtypes), dict(actual.dtypes)
    diff = sorted(f"{k}:{e.get(k)}!={a.get(k)}" for k in set(e) | set(a) if e.get(k) != a.get(k))
    return static_findings(expected.sparkSession, [(label, not diff, ";".join(diff) or "-", "-")])


def valid_values(df: DataFrame, lo: int = S.GRID_ID_MIN, hi: int = S.GRID_ID_MAX) -> DataFrame:
    """G2 + P11: NULL timestamps and out-of-range / NULL grid ids in one aggregate."""
    g = F.col("grid_id")
    row = df.agg(F.sum(F.when(F.col("timestamp").isNull(), 1).otherwise(0)).alias("bad_ts"),
                 F.sum(F.when(g.isNull() | ~g.between(lo, hi), 1).otherwise(0)).alias("bad_grid"))
    return (row.select(F.array(F.struct(*_finding("valid_timestamp", F.col("bad_ts") == 0, F.col("bad_ts"), "0")),
                               F.struct(*_finding("valid_grid_id", F.col("bad_grid") == 0, F.col("bad_grid"), "0")))
                       .alias("f"))
            .select(F.inline("f")))


def unique_grain(df: DataFrame, key=S.FACT_KEY) -> DataFrame:
    """Number of keys occurring more than once must be 0."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    n = dup.agg(F.count(F.lit(1)).alias("d"))
    return n.select(*_finding("unique_grain", F.col("d") == 0, F.col("d"), "0"))


def row_count_bounds(before: DataFrame, after: DataFrame, grids: int = S.GRID_ID_MAX) -> DataFrame:
    """A roll-up may only shrink, and stays within days x 24 x grids."""
    b = before.agg(F.count(F.lit(1))).scalar()
    days = after.agg(F.count_distinct("date")).scalar()
    return after.agg(F.count(F.lit(1)).alias("a")).select(
        *_finding("row_count_bounds", (F.col("a") <= b) & (F.col("a") <= days * 24 * grids),
                  F.col("a"), F.concat(F.lit("<= "), F.least(b, days * 24 * grids).cast("string"))))


def expected_timestamps(df: DataFrame) -> DataFrame:
    """Distinct timestamps = distinct days x 24."""
    return df.agg(F.count_distinct("timestamp").alias("t"), F.count_distinct(F.to_date("timestamp")).alias("d")) \
             .select(*_finding("expected_timestamps", F.col("t") == F.col("d") * 24, F.col("t"), F.col("d") * 24))


def missing_hours(activity: DataFrame) -> DataFrame:
    """G6 detail: hours between the first day 00:00 and the last day 23:00 with no row at all."""
    lo, hi = day_bounds(activity.where(F.col("timestamp").isNotNull()))
    slots = (activity.sparkSession.range(1)
             .select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("missing_timestamp")))
    present = activity.select(F.col("timestamp").alias("missing_timestamp")).where(F.col("missing_timestamp").isNotNull())
    return slots.join(present, "missing_timestamp", "left_anti")


def missing_grid_hours(fact: DataFrame) -> DataFrame:
    """D4 complement: (grid, hour) slots of the dense frame that have no fact row."""
    lo, hi = day_bounds(fact)
    skeleton = (fact.select("grid_id").distinct()
                .select("grid_id", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("timestamp")))
    return skeleton.join(fact.select(*S.FACT_KEY), S.FACT_KEY, "left_anti")


def cadence_check(activity: DataFrame) -> DataFrame:
    """Per date, distinct timestamps, largest gap between consecutive ones, 24 x 1 h expected."""
    ts = (activity.select("timestamp").where(F.col("timestamp").isNotNull()).distinct()
          .withColumn("date", F.to_date("timestamp")))
    w = Window.partitionBy("date").orderBy("timestamp")
    gaps = ts.withColumn("gap", epoch_seconds("timestamp") - F.lag(epoch_seconds("timestamp")).over(w))
    return (gaps.groupBy("date")
            .agg(F.count(F.lit(1)).alias("timestamps"), F.max("gap").alias("max_gap_seconds"))
            .withColumn("passed", (F.col("timestamps") == 24)
                        & (F.coalesce(F.col("max_gap_seconds"), F.lit(3600)) == 3600)))


def grain_preserved(raw: DataFrame, key=("timestamp", "grid_id", "country_code")) -> DataFrame:
    """The raw grain (timestamp, grid, country) is unique before the roll-up."""
    return unique_grain(raw, list(key)).withColumn("check", F.lit("raw_grain_unique"))


def sum_preserved(before: DataFrame, after: DataFrame, col: str = "total_activity",
                  rel: float = 1e-9, abs_tol: float = 1e-6) -> DataFrame:
    """G11 / invariant: the total is the same before and after a roll-up (Q22 tolerance)."""
    b = before.agg(exact_sum(col)).scalar()
    return after.agg(exact_sum(col).alias("a")).select(
        *_finding("sum_preserved", F.abs(F.col("a") - b) <= F.greatest(F.abs(b) * rel, F.lit(abs_tol)),
                  F.col("a"), b))


def recomputed_totals(fact: DataFrame, clean: DataFrame, rel: float = 1e-9, abs_tol: float = 1e-6) -> DataFrame:
    """G11 generalized: every (timestamp, grid) total beside one summed by a second route, and whether they agree.

    The second route shares nothing with ``exact_sum``: the measures are added as wide decimals (12 places).
    A group that only one side has does not agree.
    """
    parts = [F.sum(F.col(m).cast("decimal(38,12)")) for m in S.MEASURES]
    second = clean.groupBy(*S.FACT_KEY).agg(reduce(lambda a, b: a + b, [p.cast("double") for p in parts]).alias("recomputed"))
    j = fact.select(*S.FACT_KEY, "total_activity").join(second, S.FACT_KEY, "full_outer")
    tol = F.greatest(F.abs(F.col("recomputed")) * rel, F.lit(abs_tol))
    return j.withColumn("agrees", F.coalesce(F.abs(F.col("total_activity") - F.col("recomputed")) <= tol, F.lit(False)))


def recompute_diff(fact: DataFrame, clean: DataFrame) -> DataFrame:
    """The groups whose totals disagree. Empty = passed."""
    return recomputed_totals(fact, clean).where(~F.col("agrees")).drop("agrees")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often, with how often more (``only_left``, ``only_right``).

    Whole rows are compared (NULL equals NULL), repeats count. Both directions come from signed counts in
    one aggregate with a map-side combine, so a row that is repeated without end leaves a task once.
    """
    columns = left.columns
    signed = left.withColumn("__sign", F.lit(1)).unionByName(right.select(*columns).withColumn("__sign", F.lit(-1)))
    return (signed.groupBy(*columns).agg(F.sum("__sign").alias("__n")).where(F.col("__n") != 0)
            .select(*columns, F.greatest(F.col("__n"), F.lit(0)).alias("only_left"), F.greatest(-F.col("__n"), F.lit(0)).alias("only_right")))


def file_traceability(df: DataFrame, col: str = "source_file") -> DataFrame:
    """Every row carries a source path."""
    return df.agg(F.sum(F.when(F.col(col).isNull() | (F.col(col) == ""), 1).otherwise(0)).alias("n"),
                  F.count_distinct(col).alias("files")) \
             .select(*_finding("file_traceability", F.col("n") == 0, F.col("n"), "0"))


def non_null_columns(df: DataFrame, cols) -> DataFrame:
    """No NULL in the named columns."""
    nulls = reduce(lambda a, b: a + b, [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) for c in cols])
    return df.agg(nulls.alias("n")).select(*_finding("non_null_features", F.col("n") == 0, F.col("n"), "0"))


def combine(*findings: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), findings)


def enforce(findings: DataFrame) -> DataFrame:
    """Raise when any finding failed (one small job over the findings); returns them otherwise."""
    failed = findings.where(~F.col("passed"))
    if not failed.isEmpty():
        # One row per name of a check, however many findings it has.
        rows = failed.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.min("observed").alias("observed"),
                                           F.min("expected").alias("expected")).orderBy("check").collect()
        raise QualityGateError("; ".join(
            f"{r['check']}: observed {r['observed']}, expected {r['expected']}"
            + (f" (and {r['n'] - 1} more)" if r["n"] > 1 else "") for r in rows))
    return findings
