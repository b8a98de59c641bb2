"""Cleaning invariants, three-valued reject logic and quality gates on broken inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import clean as C
from cellwatch.operators import facts as Fa
from cellwatch.operators import quality as Q
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL

RAW_DDL = ("datetime string, CellID string, countrycode string, smsin string, smsout string, callin string, "
           "callout string, internet string")


def test_three_valued_reject_keeps_every_row(spark):
    rows = [("2024-01-01 00:00:00", "5", "1", None, "1.0", "1", "1", "1"),       # NULL measure only: kept
            ("2024-01-01 00:00:00", "5", "1", "-2", "1.0", "1", "1", "1"),        # negative: rejected
            ("2024-01-01 00:00:00", "5", "1", "-2", None, "1", "1", "1")]         # negative + NULL: rejected
    raw = spark.createDataFrame(rows, RAW_DDL)
    kept, rejected, counts = C.clean(raw)
    assert kept.count() == 1 and rejected.count() == 2
    c = counts.first()
    assert c["input_rows"] == c["clean_rows"] + c["rejected_rows"] == 3
    assert kept.first()["sms_in"] == 0.0  # curated NULL -> 0 after the split


def test_junk_becomes_null_under_ansi(spark):
    rows = [("not-a-time", "x", "1", " ", "1", "1", "1", "1"),
            ("2024-01-01 01:00:00", "10001", "1", "1", "1", "1", "1", "1"),
            ("2024-01-01 02:00:00", "0", "1", "1", "1", "1", "1", "1")]
    raw = spark.createDataFrame(rows, RAW_DDL)
    _, rejected, _ = C.clean(raw, grid_lo=1, grid_hi=10000)     # a caller's own id range
    reasons = sorted(r["reject_reason"] for r in rejected.collect())
    assert reasons == ["invalid_grid_id", "invalid_grid_id", "invalid_timestamp"]
    # Without one, ids of any size are kept; the domain is a gate that fails.
    kept, rejected, _ = C.clean(raw)
    assert sorted(r["grid_id"] for r in kept.collect()) == [0, 10001]
    assert [r["reject_reason"] for r in rejected.collect()] == ["invalid_timestamp"]
    assert not Q.valid_values(kept).where("check = 'valid_grid_id'").first()["passed"]


def test_sums_keep_every_digit(spark):
    """Small values and many decimals are neither rounded nor lost; large totals don't overflow."""
    t = dt.datetime(2024, 1, 1)
    rows = [(t, 1, 1, 0.08136262351125882, 3e-5, 0.0, 0.0, 9e11)] * 1000 + [(t, 1, 2, 3e-5, 4e-5, 0.0, 0.0, 9e11)] * 1000
    ddl = "timestamp timestamp_ntz, grid_id int, country_code int, sms_in double, sms_out double, call_in double, " \
          "call_out double, internet_activity double"
    fact = Fa.hourly_grid_summary(spark.createDataFrame(rows, ddl).repartition(5)).first()
    assert fact["sms_in"] == pytest.approx(81.39262351125882, rel=1e-13)
    assert fact["sms_out"] == pytest.approx(0.07, rel=1e-13)
    assert fact["internet_activity"] == pytest.approx(1.8e15, rel=1e-13)


@pytest.mark.parametrize("zone", ["Europe/Rome", "America/New_York"])
def test_zone_does_not_matter(spark, zone):
    """Hours that a clock change skips or repeats come out as under UTC."""
    from cellwatch.operators.warehouse import dim_time
    hours = [f"2014-{d} {h:02d}:30:00" for d in ("03-30", "10-26", "03-09", "11-02") for h in range(5)]
    raw = spark.createDataFrame([(h, "7", "1", "1", "1", "1", "1", "1") for h in hours], RAW_DDL)

    def result():
        clean = C.clean(raw)[0]
        fact = Fa.hourly_grid_summary(clean)
        return [sorted(map(str, df.collect())) for df in (
            clean, fact, Fa.densify_hours(fact.where("date < '2014-03-11'")), dim_time(fact))]

    before = spark.conf.get("spark.sql.session.timeZone")
    want = result()
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert result() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_invariant_on_fixture(spark):
    kept, rejected, counts = P.clean_split(spark, SF_SMALL)
    c = counts.first()
    assert c["input_rows"] == P.dirty_activity(spark, SF_SMALL).count()
    assert kept.count() + rejected.count() == c["input_rows"]
    assert c["rejected_rows"] == 21  # FIXTURES 2.3 at sf0.001


def test_rollup_preserves_totals_and_grain(spark):
    clean = P.clean_activity(spark, SF_SMALL)
    fact = Fa.hourly_grid_summary(clean)
    assert Q.sum_preserved(clean, fact).first()["passed"]
    assert Q.unique_grain(fact).first()["passed"]
    assert Q.recompute_diff(fact, clean).count() == 0
    assert Q.row_count_bounds(clean, fact).first()["passed"]
    assert fact.count() == 531  # FIXTURES 2.1 at sf0.001


def test_gates_fire_on_broken_inputs(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t, 1, 1.0), (t, 1, 2.0),                       # duplicated key
            (t + dt.timedelta(hours=2), 0, 1.0),              # id 0, and hour 1 missing
            (t + dt.timedelta(hours=3), 10001, 1.0)]          # id 10001
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, grid_id int, total_activity double")
    findings = Q.combine(Q.unique_grain(df), Q.valid_values(df), Q.expected_timestamps(df))
    failed = {r["check"] for r in findings.where(~F.col("passed")).collect()}
    assert failed == {"unique_grain", "valid_grid_id", "expected_timestamps"}
    with pytest.raises(Q.QualityGateError):
        Q.enforce(findings)
    missing = [r["missing_timestamp"] for r in Q.missing_hours(df).collect()]
    assert t + dt.timedelta(hours=1) in missing and len(missing) == 24 - 3
    assert not Q.required_columns(df, ["timestamp", "grid_id", "sms_in"]).first()["passed"]
    assert not Q.forbidden_columns(df.withColumn("country_code", F.lit(1))).first()["passed"]


def test_gates_pass_on_good_fact(spark):
    fact = P.fact(spark, SF_SMALL)
    Q.enforce(Q.combine(Q.unique_grain(fact), Q.valid_values(fact), Q.forbidden_columns(fact),
                        Q.required_columns(fact, ["timestamp", "grid_id", "total_activity"])))
