"""Logistic regression by Newton steps of Spark aggregates.

Features are imputed by the training median, standardised by training mean and population standard
deviation, and fitted by L2 (C = 1, intercept free). Every step is one aggregate over the training rows:
the gradient and the upper half of the Hessian as sums, a fixed number of numbers whatever the rows; the
driver solves the 7 x 7 system. The number of steps is fixed, so a rerun gives the same model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.quantiles import exact_quantile
from cellwatch.operators.risk import _clean_features, predict_linear
from cellwatch.session import written

STEPS = 15
MODEL_DDL = "feature string, fill double, mean double, deviation double, coefficient double"


@dataclass(frozen=True)
class LogisticModel:
    """Coefficients on standardised features, with what prepares them."""

    features: tuple[str, ...]
    fill: tuple[float, ...]
    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def raw_weights(self) -> tuple[dict[str, tuple[float, float]], float]:
        """(imputation value, weight) of each feature on its own scale, and the intercept there."""
        weights = [c / d for c, d in zip(self.coefficients, self.deviation)]
        return (dict(zip(self.features, zip(self.fill, weights))),
                self.intercept - sum(w * m for w, m in zip(weights, self.mean)))


def train(train_rows: DataFrame, features=S.FEATURE_COLUMNS, steps: int = STEPS, label: str = "risk_label") -> LogisticModel:
    """Fit on the given rows; raises for no rows, one class, or a feature without any value."""
    rows = written(_clean_features(train_rows, features).select(*features, F.col(label).cast("double").alias("__y")), "training")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("__y").alias("classes"),
                     *(F.count(c).alias(c) for c in features)).first()
    if stats["n"] == 0:
        raise ValueError("empty training split")
    if stats["classes"] < 2:
        raise ValueError("the training split has one class only")
    if empty := [c for c in features if not stats[c]]:
        raise ValueError(f"features without a value: {empty}")
    fill = [exact_quantile(rows, c, 0.5) for c in features]
    filled = rows.select("__y", *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in zip(features, fill)))
    moments = filled.agg(*(F.avg(c).alias(f"m_{c}") for c in features), *(F.stddev_pop(c).alias(f"s_{c}") for c in features)).first()
    mean = [moments[f"m_{c}"] for c in features]
    deviation = [moments[f"s_{c}"] or 1.0 for c in features]
    k = len(features) + 1
    z = [F.lit(1.0), *((F.col(c) - F.lit(m)) / F.lit(d) for c, m, d in zip(features, mean, deviation))]
    ready = written(filled.select("__y", *(x.alias(f"z{i}") for i, x in enumerate(z))), "standardised")
    beta, penalty = np.zeros(k), np.diag([0.0, *[1.0] * (k - 1)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    for _ in range(steps):
        logit = sum((F.lit(float(b)) * F.col(f"z{i}") for i, b in enumerate(beta)), F.lit(0.0))
        scored = ready.withColumn("p", 1 / (1 + F.exp(-logit)))
        weight = F.col("p") * (1 - F.col("p"))
        sums = scored.agg(*(F.sum((F.col("p") - F.col("__y")) * F.col(f"z{i}")).alias(f"g{i}") for i in range(k)),
                          *(F.sum(weight * F.col(f"z{i}") * F.col(f"z{j}")).alias(f"h{i}_{j}") for i, j in pairs)).first()
        hessian = penalty.copy()
        for i, j in pairs:
            hessian[i, j] += sums[f"h{i}_{j}"]
            hessian[j, i] = hessian[i, j]
        beta = beta - np.linalg.solve(hessian, np.array([sums[f"g{i}"] for i in range(k)]) + penalty @ beta)
    return LogisticModel(tuple(features), tuple(fill), tuple(mean), tuple(deviation), tuple(map(float, beta[1:])), float(beta[0]))


def predict(model: LogisticModel, df: DataFrame) -> DataFrame:
    """The given rows with model_probability, model_prediction and confidence."""
    return predict_linear(df, *model.raw_weights())


def coefficients(spark: SparkSession, model: LogisticModel) -> DataFrame:
    """M6: (feature, coefficient, abs) with the intercept, seven numbers."""
    rows = [*zip(model.features, model.coefficients), ("intercept", model.intercept)]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"), "feature")


def save(spark: SparkSession, model: LogisticModel, path: str) -> None:
    """The model as a table of one row per feature (overwrite)."""
    rows = [*zip(model.features, model.fill, model.mean, model.deviation, model.coefficients),
            ("intercept", None, None, None, model.intercept)]
    spark.createDataFrame(rows, MODEL_DDL).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, features=S.FEATURE_COLUMNS) -> LogisticModel:
    rows = {r["feature"]: r for r in spark.read.schema(MODEL_DDL).parquet(path).collect()}
    column = lambda c: tuple(rows[f][c] for f in features)
    return LogisticModel(tuple(features), column("fill"), column("mean"), column("deviation"), column("coefficient"),
                         rows["intercept"]["coefficient"])
