"""Geometry operators, as-of semantics, severity bands and the chronological split."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import geo as G
from cellwatch.operators import risk as R
from cellwatch.operators import serving as Sv
from cellwatch.sources.geojson import read_grid_reference


def _write_collection(path, features):
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f)


def test_geojson_polygon_multipolygon_zero_area_missing_id(spark, scratch):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    flat = [[[1.0, 1.0], [3.0, 1.0], [5.0, 1.0], [1.0, 1.0]]]
    feats = [{"type": "Feature", "properties": {"cellId": 1}, "geometry": {"type": "Polygon", "coordinates": square}},
             {"type": "Feature", "properties": {"cellId": 2},
              "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[10.0, 10.0], [12.0, 10.0], [12.0, 12.0],
                                                                            [10.0, 10.0]]]]}},
             {"type": "Feature", "properties": {"cellId": 3}, "geometry": {"type": "Polygon", "coordinates": flat}},
             {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": square}}]
    path = f"{scratch}/grid.geojson"
    _write_collection(path, feats)
    ref = read_grid_reference(spark, path)
    assert ref.count() == 4 and ref.where(F.col("grid_id").isNull()).count() == 1
    c = G.with_centroids(ref.where(F.col("grid_id").isNotNull())).orderBy("grid_id").collect()
    assert (c[0]["centroid_longitude"], c[0]["centroid_latitude"]) == pytest.approx((1.0, 1.0))
    assert (c[0]["vertex_longitude"], c[0]["vertex_latitude"]) == pytest.approx((0.8, 0.8))  # closing point counted
    assert c[1]["centroid_longitude"] is None          # area centroid is Polygon-only
    assert c[1]["vertex_longitude"] == pytest.approx((0 + 2 + 2 + 0 + 0 + 10 + 12 + 12 + 10) / 9)
    assert c[2]["centroid_longitude"] == pytest.approx((1 + 3 + 5 + 1) / 4)  # zero area -> vertex mean


def test_enrich_keeps_rows_and_broadcasts(spark):
    fact = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "grid_id int, total_activity double")
    geom = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]})
    lookup = spark.createDataFrame([(1, geom), (2, geom), (2, geom)], "grid_id int, geometry string")
    out = G.geo_enrich(fact, lookup)
    assert out.count() == 3  # duplicate reference ids never multiply fact rows
    out.collect()       # broadcast by the measured size
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    large = G.geo_enrich(fact, lookup.union(spark.createDataFrame([(20001, geom)], "grid_id int, geometry string")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = large.select("*")
        large.collect()     # nothing forces a broadcast
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r["grid_id"] for r in G.unmatched_grids(fact, lookup).collect()] == [3]


def _rows(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t + dt.timedelta(hours=h), float(v)) for h, v in enumerate([999.99, 1000.0, 5000.0, 10000.0, 1.0])]
    df = spark.createDataFrame(data, "grid_id int, timestamp timestamp_ntz, total_activity double")
    return df.withColumns({c: F.lit(0.0) for c in ["sms_in", "sms_out", "call_in", "call_out",
                                                     "internet_activity"]}).withColumn("hour", F.hour("timestamp"))


def test_severity_bands_exactly_on_threshold(spark):
    got = {r["total_activity"]: r["severity"] for r in Sv.hotspots(_rows(spark), limit=10).collect()}
    assert got == {999.99: "low", 1000.0: "medium", 5000.0: "high", 10000.0: "critical", 1.0: "low"}
    # severity filter after the limit (reference) vs before it
    assert Sv.hotspots(_rows(spark), limit=2, severity="low").count() == 0
    assert Sv.hotspots(_rows(spark), limit=2, severity="low", filter_first=True).count() == 2


def test_as_of_excludes_later_rows(spark):
    rows = _rows(spark)
    s = Sv.network_summary(rows, as_of=dt.datetime(2024, 1, 1, 1)).first()
    assert s["total_activity"] == pytest.approx(999.99 + 1000.0)
    assert Sv.network_summary(rows, as_of=dt.datetime(2023, 12, 31)).first()["total_activity"] is None
    assert Sv.grid_activity(rows, as_of=dt.datetime(2023, 12, 31)).count() == 0


def test_chrono_split_small(spark):
    for n, train_ts in ((2, 1), (5, 4), (10, 8)):
        t = dt.datetime(2024, 1, 1)
        df = spark.createDataFrame([(1, t + dt.timedelta(hours=i)) for i in range(n)],
                                   "grid_id int, feature_timestamp timestamp_ntz")
        s = R.chrono_split(df)
        assert s.where("split = 'train'").count() == train_ts
        assert s.where("split = 'test'").count() == n - train_ts
