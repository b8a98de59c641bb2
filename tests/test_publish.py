"""Runs that land, audit and publish; read-back checks; keyed loads."""

import pytest
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.operators import publish as Pu
from cellwatch.operators import quality as Q
from cellwatch.operators import readback as Rb
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL

DAY = "2024-02-{:02d} {:02d}:00:00"


def raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_ACTIVITY_TEXT_SCHEMA)


def rows_of(day, value="1.5", grid="4", hours=range(3)):
    return [(DAY.format(day, h), grid, "39", value, "2", None, " ", "0.25") for h in hours]


def table(df):
    return sorted(map(tuple, df.select(*S.FACT_COLUMNS).collect()))


def published(spark, root):
    return Pu.published(spark, root, P.fact(spark, SF_SMALL).schema)


def test_failing_file_leaves_published_table(spark, scratch):
    root = f"{scratch}/wap"
    assert published(spark, root).count() == 0 and Pu.runs(spark, root).count() == 0
    ok = Pu.run_load(raw(spark, rows_of(1) + rows_of(2)), root, "r1", "day1.csv")
    assert (ok["status"], ok["validation_status"], ok["input_rows"], ok["rejected_rows"], ok["output_rows"]) == ("SUCCESS", "PASS", 6, 0, 6)
    assert ok["end_time"] >= ok["start_time"] and ok["duration_seconds"] == (ok["end_time"] - ok["start_time"]).total_seconds() > 0
    before = table(published(spark, root))
    bad = Pu.run_load(raw(spark, rows_of(2, "9") + rows_of(3) + [("not a time", "1", "39", "1", "1", "1", "1", "1")]), root, "r2", "day2.csv")
    assert (bad["status"], bad["validation_status"], bad["input_rows"], bad["rejected_rows"], bad["output_rows"]) == ("FAILED", "FAIL", 7, 1, 0)
    assert "valid_timestamp" in bad["error_message"]
    assert table(published(spark, root)) == before
    # All rows of the failed run are landed with their result.
    landed = spark.read.parquet(f"{root}/landing/run_id=r2").groupBy("validation_result").count().collect()
    assert {r["validation_result"]: r["count"] for r in landed} == {"PASS": 6, "FAIL": 1}
    # The mended file is published, and again without a change.
    for _ in range(2):
        Pu.run_load(raw(spark, rows_of(2, "9") + rows_of(3)), root, "r3", "day2.csv")
        got = published(spark, root)
        assert got.count() == 9 and got.where("date = DATE'2024-02-02'").agg(F.sum("sms_in")).first()[0] == 27.0
        assert got.where("date = DATE'2024-02-01'").agg(F.sum("sms_in")).first()[0] == 4.5
    kinds = {r.run_id: r.status for r in Pu.runs(spark, root).collect()}
    assert kinds == {"r1": "SUCCESS", "r2": "FAILED", "r3": "SUCCESS"}


def test_other_errors_are_recorded_and_raised(spark, scratch):
    broken = raw(spark, rows_of(1)).withColumn("smsin", F.raise_error(F.lit("disk gone")).cast("string"))
    with pytest.raises(Exception, match="disk gone"):
        Pu.run_load(broken, f"{scratch}/wap", "r1", "day1.csv")
    r = Pu.runs(spark, f"{scratch}/wap").first()
    assert r.status == "FAILED" and "disk gone" in r.error_message and published(spark, f"{scratch}/wap").count() == 0


def test_upsert(spark, scratch):
    path = f"{scratch}/t"
    make = lambda rows: spark.createDataFrame(rows, "k int, v string, date date")
    from datetime import date
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    Pu.upsert(make([(1, "a", d1), (2, "b", d1), (None, "n", d2), (3, "c", d2), (9, "x", None)]), path, ["k"])
    Pu.upsert(make([(2, "B", d1), (4, "d", d1)]), path, ["k"])
    Pu.upsert(make([(None, "N", d2), (9, "X", None)]), path, ["k"])
    Pu.upsert(make([]), path, ["k"])
    got = sorted(map(str, spark.read.schema("k int, v string, date date").parquet(path).collect()))
    assert got == sorted(map(str, make([(1, "a", d1), (2, "B", d1), (4, "d", d1), (None, "N", d2), (3, "c", d2), (9, "X", None)]).collect()))
    with pytest.raises(Q.QualityGateError):
        Pu.upsert(make([(5, "p", d1), (5, "q", d1)]), path, ["k"])


def test_read_back_finds_changed_and_lost_rows(spark, scratch):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"), F.rand(1).alias("x"), F.lit(None).cast("string").alias("s"))
    df = df.unionByName(df.where("id < 5"))
    path = f"{scratch}/good"
    found = Rb.write_checked(df, path, "part")
    assert [r.passed for r in found.collect()] == [True] * 4
    expected = df.agg(*Rb.digest(df.columns)).first().asDict()
    shape = df.select("id", "x", "s", "part")

    def failed(changed, name, partitions=3):
        changed.write.partitionBy("part").parquet(f"{scratch}/{name}")
        return {r.check for r in Rb.findings(shape, expected, f"{scratch}/{name}", "part", partitions).collect() if not r.passed}

    assert failed(df, "same") == set()
    assert failed(df.withColumn("x", F.when(F.col("id") == 77, 0.5).otherwise(F.col("x"))), "changed") == {"read_back_digest"}
    assert failed(df.where("id <> 77"), "lost") == {"read_back_rows", "read_back_digest"}
    assert failed(df.where("part < 2"), "folder") == {"read_back_rows", "read_back_digest", "read_back_partitions"}
    # One row in the place of another's repeat: same number of rows.
    assert failed(df.dropDuplicates().unionByName(df.where("id BETWEEN 10 AND 14").dropDuplicates()), "swapped") == {"read_back_digest"}
    assert "read_back_schema" in failed(df.withColumn("id", F.col("id").cast("int")), "typed")
    assert Rb.write_checked(spark.createDataFrame([], "a int"), f"{scratch}/none").where("NOT passed").count() == 0


def test_write_checked_computes_its_rows_once(spark, scratch):
    """The partition's values (a null among them) are counted by the tasks that write."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = spark.range(100).selectExpr("id", "nullif(id % 4, 3) AS day").mapInArrow(count, "id long, day long")
    found = {r["check"]: r for r in Rb.write_checked(rows, f"{scratch}/once", "day").collect()}
    assert all(r["passed"] for r in found.values()) and found["read_back_partitions"]["expected"] == "4"
    assert seen.value == 100
