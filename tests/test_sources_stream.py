"""Sources, sinks, the stream path and the driver contract."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cellwatch.operators import clean as C
from cellwatch.operators import quality as Q
from cellwatch.plans import pipeline as P
from cellwatch.sources import files as Fi
from cellwatch.sources import sinks as Sk
from cellwatch.streaming import daily_files as D

from .conftest import SF_SMALL

HEADER = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet\n"


def _write_daily(dirpath, day, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, f"sms-call-internet-mi-{day}.csv"), "w") as f:
        f.write(HEADER + "".join(lines))


def test_csv_source_explicit_schema_and_provenance(spark, scratch):
    _write_daily(scratch, "2013-11-01", ["2013-11-01 00:00:00,1,39,1.5,,2,3,4\n", "junk,x,y,z,,,,\n"])
    _write_daily(scratch, "2013-11-02", ["2013-11-02 01:00:00,2,39,1,1,1,1,1\n"])
    with open(os.path.join(scratch, "other.csv"), "w") as f:
        f.write(HEADER)
    assert Fi.require_files(spark, scratch).count() == 2
    raw = Fi.read_activity_csv(spark, scratch, corrupt_column="_corrupt")
    assert raw.count() == 3
    assert Q.file_traceability(raw).first()["passed"]
    text = Fi.read_activity_csv(spark, scratch, schema=C.S.RAW_ACTIVITY_TEXT_SCHEMA)
    kept, rejected, _ = C.clean(text)
    assert kept.count() == 2 and rejected.count() == 1


def test_partitioned_parquet_round_trip(spark, scratch):
    fact = P.fact(spark, SF_SMALL)
    out = os.path.join(scratch, "fact")
    Sk.write_parquet(fact, out, partition_by="date")
    back = spark.read.parquet(out)
    assert back.count() == fact.count()
    assert sorted(back.columns) == sorted(fact.columns)
    assert Q.unique_grain(back).first()["passed"]
    assert len([d for d in os.listdir(out) if d.startswith("date=")]) == fact.select("date").distinct().count()
    # dynamic partition overwrite replaces only the written dates
    one_day = fact.where(F.col("date") == F.lit(dt.date(2024, 1, 1)))
    Sk.write_parquet(one_day, out, partition_by="date")
    assert spark.read.parquet(out).count() == fact.count()
    csv_out = os.path.join(scratch, "fact_csv")
    Sk.write_csv(fact.drop("timestamp"), csv_out)
    sizes = Sk.size_comparison(spark, csv_out, out).first()
    assert sizes["csv_bytes"] > 0 and sizes["parquet_bytes"] > 0


def test_stream_clean_equals_batch_and_rollup_finalizes_hours(spark, scratch):
    src = os.path.join(scratch, "landing")
    _write_daily(src, "2013-11-01", [f"2013-11-01 {h:02d}:00:00,1,39,1,1,1,1,1\n" for h in range(24)])
    _write_daily(src, "2013-11-02", [f"2013-11-02 {h:02d}:00:00,1,39,2,2,2,2,2\n" for h in range(6)])
    raw = D.read_daily_files(spark, src)
    out, ck = D.shared_path(spark, "t-out"), D.shared_path(spark, "t-ck")
    D.run_to_completion(D.write_clean(D.clean_stream(raw), out, ck))
    batch = C.clean(Fi.read_activity_csv(spark, src, schema=C.S.RAW_ACTIVITY_TEXT_SCHEMA), with_counts=False)[0]
    assert spark.read.parquet(out).count() == batch.count() == 30
    # the file sink remembers what it has seen: a second run appends nothing
    D.run_to_completion(D.write_clean(D.clean_stream(D.read_daily_files(spark, src)), out, ck))
    assert spark.read.parquet(out).count() == 30
    roll = D.hourly_rollup(D.clean_stream(D.read_daily_files(spark, src, max_files_per_trigger=1)))
    q = (roll.writeStream.format("memory").queryName("hourly_probe").outputMode("append")
         .trigger(availableNow=True).start())
    D.run_to_completion(q)
    hours = spark.table("hourly_probe")
    assert hours.count() >= 24  # the first day is final once the second file moved the watermark
    assert hours.where(F.col("timestamp") < F.lit(dt.datetime(2013, 11, 2))).agg(F.sum("sms_in")).first()[0] == 24.0


def test_driver_contract(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    df = E.entry(spark)
    assert df.count() > 0 and "total_activity" in df.columns


def test_late_rows_are_merged_and_counted(spark, scratch):
    src = os.path.join(scratch, "late")
    day = "2013-11-0{} {:02d}:00:00,{},39,{},,2,3,4\n"
    _write_daily(src, "2013-11-01", [day.format(1, h, g, 1.5) for h in range(4) for g in (1, 2)])
    _write_daily(src, "2013-11-02", [day.format(2, 5, 1, 1), day.format(1, 0, 1, 0.25), day.format(1, 0, 1, 0.5)])
    _write_daily(src, "2013-11-03", [day.format(1, 3, 2, 7), day.format(3, 0, 9, 1)])
    out, ck = os.path.join(scratch, "hours"), os.path.join(scratch, "hours-ck")
    stream = D.clean_stream(D.read_daily_files(spark, src))
    D.run_to_completion(D.merge_hours(stream, out, ck))
    batch = C.clean(Fi.read_activity_csv(spark, src, schema=C.S.RAW_ACTIVITY_TEXT_SCHEMA))[0]
    from cellwatch.operators.facts import hourly_grid_summary
    want = sorted((r.timestamp, r.grid_id, r.sms_in, r.internet_activity) for r in hourly_grid_summary(batch).collect())
    read = lambda: spark.read.parquet(out).collect()
    assert sorted((r.timestamp, r.grid_id, r.sms_in, r.internet_activity) for r in read()) == want
    assert sum(r.late_rows for r in read()) == 3 and sum(r.rows for r in read()) == 13
    # The last batch again, as after a failure before its commit: nothing is added twice.
    last = max(r.last_batch for r in read())
    again = C.clean(Fi.read_activity_csv(spark, src, schema=C.S.RAW_ACTIVITY_TEXT_SCHEMA, pattern="*-03.csv"))[0]
    D.merge_batch(again, last, out)
    assert sorted((r.timestamp, r.grid_id, r.sms_in, r.internet_activity) for r in read()) == want
