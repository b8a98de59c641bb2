"""Named gates, the ingest composite and the tuning experiments."""

import os

import pytest

from cellwatch.operators import gates as Ga
from cellwatch.operators import quality as Q
from cellwatch.plans import experiments as X
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL


def test_ingest_composite(spark, scratch):
    with open(os.path.join(scratch, "sms-call-internet-mi-2013-11-01.csv"), "w") as f:
        f.write("datetime,CellID,countrycode,smsin,smsout,callin,callout,internet\n")
        f.write("2013-11-01 00:00:00,1,39,1,1,1,1,1\n2013-11-01 00:00:00,1,39,2,2,2,2,2\n")
    raw, findings, report, profile = Ga.ingest(spark, scratch)
    assert raw.count() == 2 and report.count() == 1 and profile.first()["rows"] == 2
    with pytest.raises(Q.QualityGateError):  # the duplicated raw grain must fire
        Q.enforce(findings)
    with pytest.raises(FileNotFoundError):
        Ga.ingest(spark, os.path.join(scratch, "empty"))


def test_processed_gate_passes_on_dense_fact(spark):
    Q.enforce(Ga.processed_gate(P.dense_fact(spark, SF_SMALL)).drop("gate"))


def test_experiments(spark):
    fact = P.fact(spark, SF_SMALL)
    assert "HashAggregate" in X.formatted_plan(X.hotspot_aggregation(fact))
    assert X.timed_hotspots(fact) > 0
    assert set(X.cache_experiment(fact)) == {"uncached", "first_cached", "second_cached"}
    assert not X.repartition_experiment(fact)["extra_exchange"]
    pr = X.pruning_experiment(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
                              .withColumnRenamed("l_suppkey", "grid_id")
                              .withColumnRenamed("l_extendedprice", "total_activity"))
    assert "ReadSchema: struct<grid_id" not in pr["pruned_plan"]  # scan reads only the two source columns
    assert "l_comment" not in pr["pruned_plan"]
    j = X.join_experiment(fact, P.grid_lookup(spark, SF_SMALL))
    assert j["counts_equal"] and j["broadcast_planned"]
    assert X.over_partitioning(fact)["partitions"] >= 100


def test_load_and_read_back_of_a_warehouse_table(spark):
    """Append, bucketed by key, read back with the same rows and types."""
    import uuid
    from cellwatch.sources.sinks import write_table
    name = f"load_{uuid.uuid4().hex}"
    fact = P.fact(spark, SF_SMALL)
    try:
        write_table(fact, name, mode="append", bucket_by=(4, "grid_id"))
        back = spark.table(name)
        assert Q.schemas_match(fact, back).first()["passed"]
        assert fact.exceptAll(back).isEmpty() and back.exceptAll(fact).isEmpty()      # U3 both ways
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_lookup_guard_and_names(spark):
    from cellwatch.operators.clean import normalize_column_names
    from cellwatch.operators.warehouse import lookup_findings
    fact = spark.createDataFrame([(1,), (2,), (3,)], "grid_id int")
    dim = spark.createDataFrame([(1, 10), (2, 11), (2, 12)], "grid_id int, grid_key int")
    got = {r["check"]: r["passed"] for r in lookup_findings(fact, dim, "grid_id", "grid_key").collect()}
    assert got == {"grid_key_many_to_one": False, "grid_key_found": False}
    assert normalize_column_names(fact.toDF(" Grid_ID ")).columns == ["grid_id"]
    nulls = spark.createDataFrame([(1, None)], "a int, b double")
    assert not Q.non_null_columns(nulls, ["a", "b"]).first()["passed"]


def test_model_saved_once_and_loaded(spark, scratch):
    """The stored model scores like the trained one; one class or no row raises."""
    import pytest
    from cellwatch import schema as S
    from cellwatch.operators import risk as R
    lab = P.labelled(spark, SF_SMALL)
    train = lab.where("split = 'train'")
    fresh = R.train(train)
    R.save_model(fresh, f"{scratch}/model")
    loaded = R.load_model(f"{scratch}/model")
    one = [sorted(map(tuple, R.score(P.features(spark, SF_SMALL), m).collect())) for m in (fresh, loaded)]
    assert one[0] == one[1] and len(one[0]) == P.features(spark, SF_SMALL).count()
    from cellwatch.operators import logistic as L
    again = L.train(train)
    assert again == P.model(spark, SF_SMALL)
    newton, lbfgs = (p.agg({"model_probability": "avg"}).first()[0] for p in (L.predict(again, train), R.predict(fresh, train)))
    assert abs(newton - lbfgs) < 1e-3
    with pytest.raises(ValueError, match="one class"):
        R.train(train.where("risk_label = 0"))
    never = lab.selectExpr("'test' AS split", "1 AS risk_label", "0 AS model_prediction")
    row = R.evaluate(never).first()
    assert (row["precision"], row["recall"]) == (0.0, 0.0)
    assert set(S.FEATURE_COLUMNS) <= set(lab.columns)
