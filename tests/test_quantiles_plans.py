"""Exact distributed quantile and plan-shape checks (pruned scans, no Python, broadcast)."""

import numpy as np
import pytest

from cellwatch.functions.quantiles import exact_quantile
from cellwatch.operators import facts as Fa
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL


@pytest.mark.parametrize("n", [1, 2, 7, 537])
@pytest.mark.parametrize("p", [0.1, 0.5, 0.9])
def test_exact_quantile_small_inputs_high_accuracy(spark, n, p):
    vals = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert exact_quantile(df, "x", p) == pytest.approx(float(np.quantile(vals, p)), abs=1e-12)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_matches_numpy(spark, p):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=5000), np.full(3000, 0.5)])  # heavy ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = exact_quantile(df, "x", p, accuracy=1000)
    assert got == pytest.approx(float(np.quantile(vals, p)), abs=1e-12)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_is_pruned_and_python_free(spark):
    plan = _plan(P.fact(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in P.fact(spark, SF_SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "props" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top_grids_is_take_ordered(spark):
    plan = _plan(Fa.top_grids(P.fact(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in plan
