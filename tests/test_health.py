"""Run health records (D17) and stage metrics."""

import datetime as dt

from cellwatch.operators import health as He
from cellwatch.operators.clean import tag_rows
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL


def test_record_and_latest_runs(spark):
    t = dt.datetime(2026, 8, 30, 1)
    a = He.record_run(spark, "RUN-1", t, t + dt.timedelta(seconds=142), "SUCCESS", "f1.csv", 10, 0, 5, "PASS")
    b = He.record_run(spark, "RUN-2", t + dt.timedelta(hours=1), t + dt.timedelta(hours=2), "FAILED", "f2.csv",
                      0, 0, 0, "FAIL", "Required column timestamp is missing")
    c = He.record_run(spark, "RUN-3", t + dt.timedelta(hours=3), t + dt.timedelta(hours=4), "SUCCESS", "f3.csv",
                      7, 1, 3, "PASS")
    latest = {r["status"]: r["run_id"] for r in He.latest_runs(a.unionByName(b).unionByName(c)).collect()}
    assert latest == {"SUCCESS": "RUN-3", "FAILED": "RUN-2"}
    assert a.first()["duration_seconds"] == 142.0


def test_file_runs_from_fixture(spark):
    runs = He.file_runs(tag_rows(P.dirty_activity(spark, SF_SMALL)))
    rows = runs.collect()
    assert len(rows) == 30
    assert sum(r["input_rows"] for r in rows) == 1000 and sum(r["rejected_rows"] for r in rows) == 21
    assert all(r["status"] in ("SUCCESS", "FAILED") for r in rows)


def test_stage_metrics_unpivot(spark):
    counts = P.clean_split(spark, SF_SMALL)[2].select("input_rows", "clean_rows", "rejected_rows")
    m = {r["name"]: r["value"] for r in He.stage_metrics("r1", "clean", counts).collect()}
    assert m == {"input_rows": 1000.0, "clean_rows": 979.0, "rejected_rows": 21.0}
