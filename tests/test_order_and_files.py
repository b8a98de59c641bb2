"""Order statistics, numbering without one task, ordered and mixed files, bounded densifying, recomputation."""

import gzip
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions import quantiles as Qu
from cellwatch.operators import facts as Fa
from cellwatch.operators import quality as Q
from cellwatch.operators import windows as Wi
from cellwatch.operators.warehouse import dim_time
from cellwatch.plans import pipeline as P
from cellwatch.sources import files as Fi
from cellwatch.sources import sinks as Sk

from .conftest import SF_SMALL


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(5)


@pytest.mark.parametrize("shape", ["normal", "ties", "two", "heavy", "signed"])
def test_order_statistic_equals_sorting(spark, shape):
    rng = np.random.default_rng(1)
    values = {"normal": rng.normal(size=3000), "ties": rng.integers(0, 5, 3000).astype(float),
              "two": np.append(np.zeros(2500), np.ones(500)), "heavy": np.exp(rng.normal(size=3000) * 100),
              "signed": np.concatenate([rng.normal(size=500) * 1e-300, -np.exp(rng.normal(size=500) * 50), np.full(2000, -0.0)])}[shape]
    df = column(spark, map(float, values)).unionByName(spark.createDataFrame([(None,)], "x double")).cache()
    order = np.sort(values)
    for rank in (0, 1, 1499, 2750, 2999):
        # Few rows may meet and the sketch is coarse, so several rounds are needed.
        assert Qu.order_statistic(df, "x", rank, few=7, accuracy=50) == order[rank]
    for p in (0.0, 0.123, 0.5, 0.9, 1.0):
        assert Qu.exact_quantile(df, "x", p, few=7, accuracy=50) == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    with pytest.raises(IndexError):
        Qu.order_statistic(df, "x", 3000)


def test_order_statistic_with_nan_and_nothing(spark):
    assert Qu.order_statistic(column(spark, [1.0, float("nan"), 2.0]), "x", 1) == 2.0
    assert math.isnan(Qu.order_statistic(column(spark, [float("nan")] * 9 + [2.0]), "x", 5, few=1))
    assert Qu.exact_quantile(column(spark, []).where("x > 0"), "x", 0.5) is None
    assert Qu.order_statistic(spark.range(100_000).select(F.col("id").alias("x")), "x", 77_777, few=10) == 77_777


def test_no_more_than_a_few_rows_are_sorted(spark):
    """The rows that reach the last step are at most ``few``, whatever the number of rows."""
    seen = []
    original = type(spark.range(1)).orderBy

    def watch(self, *columns, **more):
        seen.append(self.count())
        return original(self, *columns, **more)

    from unittest import mock
    with mock.patch.object(type(spark.range(1)), "orderBy", watch):
        Qu.exact_quantile(spark.range(50_000).select((F.rand(3) * 1e6).alias("x")), "x", 0.37, few=50)
    assert seen and max(seen) <= 50


def test_surrogate_keys_without_one_task(spark):
    rnd = random.Random(1)
    keys = rnd.sample(range(10**6), 700)
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k long")
    got = {r.k: r.n for r in Wi.surrogate_key(df, "k", "n").collect()}
    assert got == {k: i for i, k in enumerate([None, *sorted(keys)], 1)}
    assert Wi.surrogate_key(df.where("k < 0"), "k", "n").count() == 0
    plan = dim_time(P.fact(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_ordered_files_rise(spark, scratch):
    df = spark.range(3000).select((F.col("id") * 7919 % 1000).alias("a"), F.rand(2).alias("b"))
    path = os.path.join(scratch, "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Sk.write_ordered(df, path, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) > 3
    read = [tuple(r) for f in files for r in spark.read.parquet(os.path.join(path, f)).coalesce(1).collect()]
    assert read == sorted(read)
    numbered = {r.position: (r.a, r.b) for r in Sk.read_ordered(spark, path).collect()}
    assert [numbered[i] for i in range(1, 3001)] == read


HEADER = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet\n"


def test_mixed_folder(spark, scratch):
    folder = os.path.join(scratch, "in")
    os.makedirs(folder)
    with open(f"{folder}/one.txt", "w") as f:
        f.write(HEADER + "2024-01-01 00:00:00,1,39,1,2,3,4,5\n")
    with open(f"{folder}/two.csv", "w") as f:   # other order, one column missing, one unknown
        f.write("internet,extra,CELLID,datetime\n0.5,zz,2,2024-01-01 01:00:00\n")
    with gzip.open(f"{folder}/three.csv.gz", "wt") as f:
        f.write(HEADER + "2024-01-01 02:00:00,3,39,x,,3,4,5\n")
    with open(f"{folder}/four", "w") as f:
        f.write('{"datetime": "2024-01-01 03:00:00", "CellID": "4"}\n')
    open(f"{folder}/empty.csv", "w").close()
    spark.createDataFrame([(5, "2024-01-01 04:00:00", 1.25)], "CellID long, datetime string, internet double").coalesce(1).write.parquet(f"{folder}/five")
    got = {r.CellID: r for r in Fi.read_mixed(spark, folder, S.RAW_ACTIVITY_SCHEMA).collect()}
    assert {k: r.source_format for k, r in got.items()} == {1: "csv", 2: "csv", 3: "csv.gz", 4: "json", 5: "parquet"}
    assert got[2].internet == 0.5 and got[2].smsin is None and got[3].smsin is None and got[5].internet == 1.25
    assert got[1].source_file.endswith("one.txt") and got[4].datetime == "2024-01-01 03:00:00"
    with gzip.open(f"{folder}/hidden.csv", "wt") as f:
        f.write(HEADER)
    with pytest.raises(ValueError, match="gzip content"):
        Fi.read_mixed(spark, folder, S.RAW_ACTIVITY_SCHEMA)
    with pytest.raises(FileNotFoundError):
        Fi.read_mixed(spark, os.path.join(scratch, "nowhere"), S.RAW_ACTIVITY_SCHEMA)


def test_stray_date_does_not_multiply_the_table(spark):
    fact = P.fact(spark, SF_SMALL).cache()
    plain = Fa.densify_hours(fact).count()
    stray = fact.limit(1).withColumn("timestamp", F.expr("TIMESTAMP_NTZ'2999-01-01 05:00:00'")).withColumn("grid_id", F.lit(1))
    rows = fact.unionByName(Fa.finish_fact(stray))
    span = Fa.plausible_span(rows)
    dense = Fa.densify_hours(rows, span)
    assert dense.count() == plain + 1 and dense.where("date = DATE'2999-01-01'").count() == 1
    assert not Fa.span_findings(rows, span).first()["passed"] and Fa.span_findings(fact, Fa.plausible_span(fact)).first()["passed"]
    assert Fa.plausible_span(fact.where("grid_id < 0")) is None
    assert Fa.densify_hours(fact, Fa.plausible_span(fact)).count() == plain


def test_wrong_sum_is_found(spark):
    clean = P.clean_activity(spark, SF_SMALL)
    fact = Fa.hourly_grid_summary(clean)
    assert Q.recompute_diff(fact, clean).count() == 0
    key = fact.orderBy("timestamp", "grid_id").first()
    here = (F.col("timestamp") == F.lit(key.timestamp).cast("timestamp_ntz")) & (F.col("grid_id") == key.grid_id)
    off = fact.withColumn("total_activity", F.when(here, F.col("total_activity") + 1e-4).otherwise(F.col("total_activity")))
    assert [r.grid_id for r in Q.recompute_diff(off, clean).collect()] == [key.grid_id]
    assert Q.recompute_diff(fact.where(~here), clean).count() == 1


def test_wrong_exact_sum_is_found(spark, monkeypatch):
    from cellwatch.functions.columns import exact_sum
    monkeypatch.setattr(Fa, "exact_sum", lambda c: exact_sum(c) * (1 + 1e-6))
    clean = P.clean_activity(spark, SF_SMALL)
    assert Q.recompute_diff(Fa.hourly_grid_summary(clean), clean).count() > 0


def test_multiset_difference(spark):
    make = lambda rows: spark.createDataFrame(rows, "a int, b string")
    got = Q.multiset_difference(make([(1, "x")] * 3 + [(2, None)] * 2 + [(3, "z")]), make([(1, "x"), (2, None), (2, None), (None, None)]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "x", 2, 0), (3, "z", 1, 0), (None, None, 0, 1)]))


def test_changed_sources_are_not_answered_from_old_tables(spark, scratch):
    import shutil
    import time
    folder = os.path.join(scratch, "sf")
    os.makedirs(folder)
    path = f"{folder}/events.parquet"
    shutil.copy(f"{SF_SMALL}/events.parquet", path)
    first = P.fact_table(spark, folder)
    n = first.count()
    assert P.fact_table(spark, folder).inputFiles() == first.inputFiles()
    spark.read.parquet(path).limit(50).toPandas().to_parquet(f"{folder}/new", index=False, coerce_timestamps="us")
    time.sleep(1.1)
    shutil.copy(f"{folder}/new", path)
    assert P.fact_table(spark, folder).count() < n


def test_single_file_csv_is_checked(spark, scratch, monkeypatch):
    monkeypatch.setattr(Sk, "SINGLE_FILE_ROWS", 10)
    Sk.write_csv(spark.range(10), f"{scratch}/a", single_file=True)
    assert len([f for f in os.listdir(f"{scratch}/a") if f.endswith(".csv")]) == 1
    with pytest.raises(ValueError):
        Sk.write_csv(spark.range(11), f"{scratch}/b", single_file=True)
