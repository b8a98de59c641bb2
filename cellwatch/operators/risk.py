"""Risk classifier chain (M1-M10): labels, chronological split, training thresholds,
a Spark ML pipeline, evaluation, batch scoring and the latest risk per grid."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import ntz_literal
from cellwatch.functions.quantiles import exact_quantile, order_statistic
from cellwatch.session import cut_lineage, written

EPOCH = datetime(1970, 1, 1)


def future_labels(features: DataFrame, fact: DataFrame, hours: int = S.LABEL_HORIZON_HOURS,
                  value: str = "total_activity") -> DataFrame:
    """Activity ``hours`` later joined to the features at t (gap-safe equi-join, not lead)."""
    src = (fact.where(F.col("grid_id").isNotNull() & F.col("timestamp").isNotNull() & F.col(value).isNotNull())
           .groupBy("grid_id", "timestamp").agg(F.max(value).alias("v")))  # one value per key
    labels = src.select("grid_id", (F.col("timestamp") - F.expr(f"INTERVAL {hours} HOURS")).alias("feature_timestamp"),
                        F.col("v").alias("future_activity"))
    return features.join(labels, ["grid_id", "feature_timestamp"], "inner")


def split_timestamp(df: DataFrame, ratio: float = S.TRAIN_RATIO, time: str = "feature_timestamp"):
    """The distinct timestamp at index max(1, int(n*ratio)) (capped at n-1).

    The distinct timestamps are stored and the one of that rank is selected without sorting them in one
    place; returns the timestamp itself. Pass a stored frame.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH), F.col("t"))
    ts = written(df.select(F.col(time).alias("t")).where(F.col("t").isNotNull()).distinct().select(micros.alias("u")), "times")
    n = ts.agg(F.count(F.lit(1))).first()[0]
    if n < 2:
        raise ValueError("not enough timestamps for a chronological split")
    return EPOCH + timedelta(microseconds=order_statistic(ts, "u", min(max(1, int(n * ratio)), n - 1)))


def chrono_split(df: DataFrame, ratio: float = S.TRAIN_RATIO, time: str = "feature_timestamp") -> DataFrame:
    """M2: rows before the split timestamp are 'train', the rest 'test' (G19: neither empty)."""
    t = split_timestamp(df, ratio, time)
    return df.withColumn("split", F.when(F.col(time) < ntz_literal(t), "train").otherwise("test"))


def risk_labels(split: DataFrame, p: float = S.POSITIVE_PERCENTILE) -> DataFrame:
    """Per-grid p-quantile of train future activity, else the overall train quantile
    (exact and distributed, see functions.quantiles); risk_label = future >= threshold.

    The overall quantile is only looked for if some grid has no training row.
    """
    train = split.where(F.col("split") == "train")
    per_grid = train.groupBy("grid_id").agg(F.percentile("future_activity", F.lit(p)).alias("grid_threshold"))
    seen = per_grid.where(F.col("grid_threshold").isNotNull()).select("grid_id")
    unseen = split.select("grid_id").distinct().join(seen, "grid_id", "left_anti")
    overall = None if unseen.isEmpty() else exact_quantile(train, "future_activity", p)
    out = split.join(per_grid, "grid_id", "left").withColumn(
        "_threshold", F.coalesce(F.col("grid_threshold"), F.lit(overall).cast("double"))).drop("grid_threshold")
    return out.withColumn("risk_label", (F.col("future_activity") >= F.col("_threshold")).cast("int"))


def class_balance(labelled: DataFrame) -> DataFrame:
    """Rows per (split, label); a split with one class only cannot train."""
    return labelled.groupBy("split", "risk_label").agg(F.count(F.lit(1)).alias("rows"))


def _clean_features(df: DataFrame, cols) -> DataFrame:
    """P20: +-inf -> NULL before imputation."""
    return df.withColumns({c: F.when(F.col(c).isin(float("inf"), float("-inf")), None)
                              .otherwise(F.col(c).cast("double")) for c in cols})


def train(train_rows: DataFrame, features=S.FEATURE_COLUMNS, max_iter: int = 1000,
          label: str = "risk_label") -> PipelineModel:
    """M4: median imputation -> standardization -> L2 logistic regression.

    scikit-learn's default (L2, C = 1) on n rows equals Spark's regParam = 1/n with
    elasticNetParam = 0; features are already standardized, so Spark's own standardization
    is off. The row count for regParam is one aggregate job.
    """
    # Many passes follow (imputer, scaler, optimizer iterations): cut the lineage once into
    # the shared checkpoint folder so a lost executor does not replay the whole chain.
    rows = cut_lineage(_clean_features(train_rows, features))
    n, classes = rows.agg(F.count(F.lit(1)), F.count_distinct(label)).first()
    if n == 0:
        raise ValueError("empty training split")
    if classes < 2:
        raise ValueError("the training split has one class only")
    imputed = [f"{c}__imp" for c in features]
    stages = [Imputer(inputCols=list(features), outputCols=imputed, strategy="median"),
              VectorAssembler(inputCols=imputed, outputCol="__raw", handleInvalid="keep"),
              StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True),
              LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                                 regParam=1.0 / n, elasticNetParam=0.0, standardization=False)]
    return Pipeline(stages=stages).fit(rows.withColumn(label, F.col(label).cast("double")))


def predict(model: PipelineModel, df: DataFrame, features=S.FEATURE_COLUMNS) -> DataFrame:
    """Model output columns: model_prediction (0/1) and model_probability = P(class 1)."""
    out = model.transform(_clean_features(df, features))
    p = vector_to_array(F.col("probability"))
    keep = [c for c in df.columns]
    return out.select(*keep, F.col("prediction").cast("int").alias("model_prediction"),
                      p[1].alias("model_probability"), F.array_max(p).alias("confidence"))


def evaluate(predictions: DataFrame, label: str = "risk_label") -> DataFrame:
    """M5: per split: rows, base rate, accuracy, precision, recall (one conditional aggregate)."""
    y, yh = F.col(label), F.col("model_prediction")
    tp = F.sum(F.when((y == 1) & (yh == 1), 1).otherwise(0))
    fp = F.sum(F.when((y == 0) & (yh == 1), 1).otherwise(0))
    fn = F.sum(F.when((y == 1) & (yh == 0), 1).otherwise(0))
    return predictions.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y.cast("double")).alias("base_rate"),
        F.avg((y == yh).cast("double")).alias("accuracy"),
        # An empty denominator counts as 0.
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"))


def class_report(predictions: DataFrame, label: str = "risk_label") -> DataFrame:
    """M5 report: per split and class, support, precision, recall and F1 (0 on an empty denominator)."""
    seen = predictions.select("split", F.col(label).cast("int").alias("y"), F.col("model_prediction").alias("yh"))
    each = seen.select("split", F.explode(F.array(F.lit(0), F.lit(1))).alias("class"), "y", "yh")
    hit = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("double")
    k = F.col("class")
    t = each.groupBy("split", "class").agg(
        hit(F.col("y") == k).cast("long").alias("support"), hit((F.col("y") == k) & (F.col("yh") == k)).alias("tp"),
        hit(F.col("yh") == k).alias("said"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    p, r = zero(F.try_divide("tp", "said")), zero(F.try_divide(F.col("tp"), F.col("support")))
    return t.select("split", "class", "support", p.alias("precision"), r.alias("recall"),
                    zero(F.try_divide(2 * p * r, p + r)).alias("f1"))


def coefficients(spark, model: PipelineModel, features=S.FEATURE_COLUMNS) -> DataFrame:
    """M6: (feature, coefficient, abs) sorted by magnitude; seven numbers from the fitted model."""
    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"), "feature")


def agreement_matrix(predictions: DataFrame, alerts: DataFrame, prediction_col: str = "model_prediction") -> DataFrame:
    """Model flag vs rule alert on (grid, feature_timestamp): counts of the four
    cells and the agreement rate."""
    np3 = alerts.select("grid_id", F.col("timestamp").alias("feature_timestamp")).distinct() \
                .withColumn("np3_alert", F.lit(1))
    j = predictions.join(np3, ["grid_id", "feature_timestamp"], "left") \
                   .withColumn("np3_alert", F.coalesce(F.col("np3_alert"), F.lit(0)))
    m, a = F.col(prediction_col).cast("int"), F.col("np3_alert")
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 cnt(m == a).alias("agreement"),
                 F.round(F.avg((m == a).cast("double")), 6).alias("agreement_rate"),
                 cnt((m == 1) & (a == 1)).alias("both_alert"),
                 cnt((m == 0) & (a == 0)).alias("both_no_alert"),
                 cnt((m == 1) & (a == 0)).alias("model_only"),
                 cnt((m == 0) & (a == 1)).alias("rules_only"))


def predict_linear(df: DataFrame, model: dict, intercept: float) -> DataFrame:
    """The columns of ``predict`` from given numbers: per feature (imputation value, coefficient)."""
    cleaned = _clean_features(df, list(model))
    logit = F.lit(intercept)
    for c, (fill, weight) in model.items():
        logit = logit + F.lit(weight) * F.coalesce(F.col(c), F.lit(fill))
    p = 1 / (1 + F.exp(-logit))
    out = cleaned.withColumn("model_probability", p)
    return out.withColumns({"model_prediction": (F.col("model_probability") >= 0.5).cast("int"),
                            "confidence": F.greatest("model_probability", 1 - F.col("model_probability"))})


def score(features: DataFrame, model: PipelineModel, threshold: float = S.RISK_THRESHOLD,
          version: str = S.MODEL_VERSION) -> DataFrame:
    """M8: every given row scored by the trained model."""
    return score_rows(predict(model, features), threshold, version)


def score_rows(p: DataFrame, threshold: float = S.RISK_THRESHOLD, version: str = S.MODEL_VERSION) -> DataFrame:
    """risk_score = P(class 1) rounded to 6 places, level by threshold, model version."""
    return p.select("grid_id", "feature_timestamp",
                    F.round(F.col("model_probability"), 6).alias("risk_score"),
                    F.when(F.col("model_probability") >= threshold, "high").otherwise("low").alias("risk_level"),
                    F.lit(version).alias("model_version"))


def top_risk(scores: DataFrame, n: int = 20) -> DataFrame:
    """K6: highest risk scores, ties by grid and time."""
    return scores.orderBy(F.desc("risk_score"), "grid_id", "feature_timestamp").limit(n)


def latest_features(features: DataFrame, as_of=None) -> DataFrame:
    """Per grid, the newest feature row at or before as-of (max_by over a struct)."""
    f = features if as_of is None else features.where(F.col("feature_timestamp") <= ntz_literal(as_of))
    cols = [c for c in f.columns if c != "grid_id"]
    latest = f.groupBy("grid_id").agg(F.max_by(F.struct(*cols), F.col("feature_timestamp")).alias("r"))
    return latest.select("grid_id", "r.*")


def latest_risk(features: DataFrame, model: PipelineModel, as_of=None, version: str = S.MODEL_VERSION) -> DataFrame:
    """M9: risk of every grid's latest features: confidence = max class probability (API form),
    level from the predicted class, rounded to 4 places."""
    return latest_from(predict(model, latest_features(features, as_of)), version)


def latest_from(p: DataFrame, version: str = S.MODEL_VERSION) -> DataFrame:
    """M9 on predicted rows, one for each grid."""
    return p.select("grid_id", F.col("feature_timestamp").alias("as_of"),
                    F.round(F.col("confidence"), 4).alias("risk_score"),
                    F.when(F.col("model_prediction") == 1, "high").otherwise("low").alias("risk_level"),
                    F.lit(version).alias("model_version"))


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
