"""The risk model's regularization mapping: Spark's fit equals a direct Newton solve of
the L2 (C = 1) logistic objective on the same standardized features."""

import numpy as np
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.operators import risk as R
from cellwatch.plans import pipeline as P

from .conftest import SF_SMALL


def _newton(X, y, iters=50):
    n, d = X.shape
    A = np.hstack([X, np.ones((n, 1))])
    w = np.zeros(d + 1)
    reg = np.eye(d + 1)
    reg[-1, -1] = 0.0  # intercept is not penalized
    for _ in range(iters):
        p = 1.0 / (1.0 + np.exp(-A @ w))
        g = A.T @ (p - y) + reg @ w
        H = A.T @ (A * (p * (1 - p))[:, None]) + reg
        w -= np.linalg.solve(H, g)
    return w


def test_logistic_regression_matches_l2_newton(spark):
    lab = P.labelled(spark, SF_SMALL)
    train = lab.where(F.col("split") == "train")
    model = R.train(train)
    pdf = train.select(*S.FEATURE_COLUMNS, "risk_label").toPandas()
    X = pdf[S.FEATURE_COLUMNS].to_numpy(float)
    assert not np.isnan(X).any()  # no imputation in play, so the comparison is exact
    sd = X.std(axis=0, ddof=1)
    Z = np.where(sd > 0, (X - X.mean(axis=0)) / np.where(sd > 0, sd, 1.0), 0.0)
    w = _newton(Z, pdf["risk_label"].to_numpy(float))
    lr = model.stages[-1]
    got = np.append(lr.coefficients.toArray(), lr.intercept)
    assert np.allclose(got, w, rtol=1e-3, atol=1e-4)
    ev = {r["split"]: r for r in R.evaluate(R.predict(model, lab)).collect()}
    assert ev["train"]["accuracy"] >= max(ev["train"]["base_rate"], 1 - ev["train"]["base_rate"]) - 1e-9


def test_newton_by_aggregates_equals_numpy(spark, scratch):
    from cellwatch.operators import logistic as L
    lab = P.labelled(spark, SF_SMALL)
    holes = lab.where(F.col("split") == "train").withColumn("variability", F.when(F.rand(4) < 0.1, None).when(F.rand(5) < 0.02, float("inf"))
                                                            .otherwise(F.col("variability"))).cache()
    model = L.train(holes)
    pdf = holes.select(*S.FEATURE_COLUMNS, "risk_label").toPandas()
    X = pdf[S.FEATURE_COLUMNS].to_numpy(float)
    X[~np.isfinite(X)] = np.nan
    X = np.where(np.isnan(X), np.nanmedian(X, axis=0), X)
    sd = X.std(axis=0)
    w = _newton((X - X.mean(axis=0)) / np.where(sd > 0, sd, 1.0), pdf["risk_label"].to_numpy(float))
    assert np.allclose([*model.coefficients, model.intercept], w, rtol=1e-8, atol=1e-10)
    L.save(spark, model, f"{scratch}/model")
    assert L.load(spark, f"{scratch}/model") == model
    import pytest
    with pytest.raises(ValueError, match="one class"):
        L.train(holes.where("risk_label = 1"))
    with pytest.raises(ValueError, match="empty"):
        L.train(holes.where("risk_label > 1"))
