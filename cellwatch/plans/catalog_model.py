"""Queries of the trained risk model (M3-M10), with the same Newton steps in SQL as their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import round6
from cellwatch.operators import logistic as L
from cellwatch.operators import quality as Q
from cellwatch.operators import risk as R
from cellwatch.plans import pipeline as P
from cellwatch.plans.catalog import _round_cols, register
from cellwatch.plans.oracle import add_cte, sql

_K = len(S.FEATURE_COLUMNS) + 1
_PAIRS = [(i, j) for i in range(_K) for j in range(i, _K)]

add_cte("training", ["labelled"], "SELECT "
        + ", ".join(f"CASE WHEN isinf(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in S.FEATURE_COLUMNS)
        + ", CASE WHEN future_activity >= _threshold THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM labelled WHERE split = 'train'")
add_cte("fills", ["training"], "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in S.FEATURE_COLUMNS) + " FROM training")
add_cte("filled", ["training", "fills"], "SELECT "
        + ", ".join(f"coalesce(t.{c}, f.{c}) AS {c}" for c in S.FEATURE_COLUMNS) + ", y FROM training t, fills f")
add_cte("moments", ["filled"], "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in S.FEATURE_COLUMNS) + " FROM filled")
add_cte("standardised", ["filled", "moments"], "SELECT y, 1.0::DOUBLE AS z0, " + ", ".join(
    f"({c} - m_{c}) / s_{c} AS z{i}" for i, c in enumerate(S.FEATURE_COLUMNS, 1)) + " FROM filled, moments")


def _newton_sql() -> str:
    """One Newton step: sums over the rows, then Gauss-Jordan elimination of [Hessian | gradient] as lists."""
    logit = " + ".join(f"b[{i + 1}] * z{i}" for i in range(_K))
    sums = ", ".join([*(f"sum((p - y) * z{i}) AS g{i}" for i in range(_K)),
                      *(f"sum(p * (1 - p) * z{i} * z{j}) AS h{i}_{j}" for i, j in _PAIRS)])
    cell = lambda i, j: f"h{min(i, j)}_{max(i, j)}" + (" + 1" if i == j and i else "")
    rows = ", ".join("[" + ", ".join([*(cell(i, j) for j in range(_K)), f"g{i}" + (f" + b[{i + 1}]" if i else "")]) + "]"
                     for i in range(_K))
    body = (f"SELECT step, b, [{rows}] AS m FROM (SELECT step, b, {sums} FROM "
            f"(SELECT step, b, s.*, 1 / (1 + exp(-({logit}))) AS p FROM newton, standardised s WHERE step < {L.STEPS}) GROUP BY step, b)")
    for k in range(1, _K + 1):
        body = (f"SELECT step, b, list_transform(range(1, {_K + 1}), lambda i: CASE WHEN i = {k} "
                f"THEN list_transform(m[{k}], lambda x: x / m[{k}][{k}]) "
                f"ELSE list_transform(range(1, {_K + 2}), lambda j: m[i][j] - m[i][{k}] * m[{k}][j] / m[{k}][{k}]) END) AS m FROM ({body})")
    zeros = ", ".join(["0.0::DOUBLE"] * _K)
    return (f"SELECT 0 AS step, [{zeros}] AS b UNION ALL "
            f"SELECT step + 1, list_transform(range(1, {_K + 1}), lambda i: b[i] - m[i][{_K + 1}]) FROM ({body})")


add_cte("newton", ["standardised"], _newton_sql())
add_cte("beta", ["newton"], f"SELECT b FROM newton WHERE step = {L.STEPS}")


def _trained(source: str) -> str:
    """Rows of ``source`` with p = P(class 1)."""
    z = " + ".join(["b[1]", *(
        f"b[{i + 1}] * (coalesce(CASE WHEN isinf(CAST(r.{c} AS DOUBLE)) THEN NULL ELSE CAST(r.{c} AS DOUBLE) END, f.{c}) - m_{c}) / s_{c}"
        for i, c in enumerate(S.FEATURE_COLUMNS, 1))])
    return f"SELECT r.*, 1 / (1 + exp(-({z}))) AS p FROM {source} r, fills f, moments, beta"


add_cte("trained_scores", ["features", "fills", "moments", "beta"], _trained("features"))
add_cte("trained_labelled", ["labelled", "fills", "moments", "beta"],
        "SELECT *, CAST(future_activity >= _threshold AS INTEGER) AS y, CAST(p >= 0.5 AS INTEGER) AS yh FROM (" + _trained("labelled") + ")")

_SCORE = f"""SELECT grid_id, feature_timestamp, round(p, 6) AS risk_score,
       CASE WHEN p >= 0.5 THEN 'high' ELSE 'low' END AS risk_level, '{S.MODEL_VERSION}' AS model_version
FROM trained_scores"""


def recursive_sql(body: str, *needed: str) -> str:
    return sql(body, *needed).replace("WITH ", "WITH RECURSIVE ", 1)


@register("risk_scores", recursive_sql(_SCORE, "trained_scores"))
def q_risk_scores(spark, sf_dir):
    """M8: every feature row is scored."""
    return R.score_rows(L.predict(P.model(spark, sf_dir), P.features(spark, sf_dir)))


@register("top_risk_report", recursive_sql(_SCORE + " ORDER BY round(p, 6) DESC, grid_id, feature_timestamp LIMIT 20", "trained_scores"))
def q_top_risk_report(spark, sf_dir):
    return R.top_risk(R.score_rows(L.predict(P.model(spark, sf_dir), P.features(spark, sf_dir))))


@register("model_coefficients", recursive_sql(
    "SELECT feature, round(coefficient, 6) AS coefficient, round(abs(coefficient), 6) AS abs_coefficient FROM (SELECT unnest(["
    + ", ".join(f"'{f}'" for f in ("intercept", *S.FEATURE_COLUMNS)) + "]) AS feature, unnest(b) AS coefficient FROM beta)", "beta"))
def q_model_coefficients(spark, sf_dir):
    """M6: the coefficients on standardised features."""
    return _round_cols(L.coefficients(spark, P.model(spark, sf_dir)), ["coefficient", "abs_coefficient"])


@register("model_evaluation", recursive_sql("""
SELECT split, count(*) AS rows, round(avg(CAST(y AS DOUBLE)), 6) AS base_rate,
       round(avg(CASE WHEN y = yh THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(coalesce(sum(y * yh) / nullif(sum(yh), 0), 0.0), 6) AS precision,
       round(coalesce(sum(y * yh) / nullif(sum(y), 0), 0.0), 6) AS recall
FROM trained_labelled GROUP BY split""", "trained_labelled"))
def q_model_evaluation(spark, sf_dir):
    """M5 on both splits."""
    return _round_cols(R.evaluate(L.predict(P.model(spark, sf_dir), P.labelled(spark, sf_dir))),
                       ["base_rate", "accuracy", "precision", "recall"])


@register("model_agreement", recursive_sql("""
SELECT count(*) AS rows, CAST(sum(CASE WHEN m = a THEN 1 ELSE 0 END) AS BIGINT) AS agreement,
       round(avg(CASE WHEN m = a THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       CAST(sum(CASE WHEN m = 1 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both_alert,
       CAST(sum(CASE WHEN m = 0 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS both_no_alert,
       CAST(sum(CASE WHEN m = 1 AND a = 0 THEN 1 ELSE 0 END) AS BIGINT) AS model_only,
       CAST(sum(CASE WHEN m = 0 AND a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rules_only
FROM (SELECT l.yh AS m, CASE WHEN EXISTS (SELECT 1 FROM alerts x WHERE x.grid_id = l.grid_id
                               AND x.timestamp = l.feature_timestamp) THEN 1 ELSE 0 END AS a
      FROM trained_labelled l WHERE split = 'test')""", "trained_labelled", "alerts"))
def q_model_agreement(spark, sf_dir):
    """M7: the model against the rules, on the test split alone."""
    test = P.labelled(spark, sf_dir).where(F.col("split") == "test")
    return R.agreement_matrix(L.predict(P.model(spark, sf_dir), test), P.alerts(spark, sf_dir))


@register("latest_risk", recursive_sql(f"""
SELECT grid_id, feature_timestamp AS as_of, round(greatest(p, 1 - p), 4) AS risk_score,
       CASE WHEN p >= 0.5 THEN 'high' ELSE 'low' END AS risk_level, '{S.MODEL_VERSION}' AS model_version
FROM trained_scores WHERE (grid_id, feature_timestamp) IN (SELECT grid_id, max(feature_timestamp) FROM features GROUP BY grid_id)""",
    "trained_scores", "features"))
def q_latest_risk(spark, sf_dir):
    """M9."""
    rows = L.predict(P.model(spark, sf_dir), R.latest_features(P.features(spark, sf_dir)))
    return R.latest_from(rows)


@register("non_null_features_gate", sql("SELECT 'non_null_features' AS \"check\", n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected FROM (SELECT "
              + " + ".join(f"count(*) - count({c})" for c in S.FEATURE_COLUMNS) + " AS n FROM features)", "features"))
def q_non_null_features_gate(spark, sf_dir):
    """Asked before scoring."""
    return Q.non_null_columns(P.features(spark, sf_dir), S.FEATURE_COLUMNS)


# ---------------------------------------------------------------- M3 / J11 where grids have no training row

add_cte("cold_split", ["fact"], """
SELECT grid_id, timestamp AS feature_timestamp, total_activity AS future_activity,
       CASE WHEN timestamp < (SELECT min(timestamp) FROM fact WHERE timestamp > (SELECT min(timestamp) FROM fact)) THEN 'train' ELSE 'test' END AS split
FROM fact""")


@register("risk_labels_cold_start", sql("""
SELECT s.grid_id, feature_timestamp, split, round(t, 6) AS _threshold, CAST(future_activity >= t AS INTEGER) AS risk_label
FROM (SELECT s.*, coalesce(g.thr, (SELECT quantile_cont(future_activity, 0.9) FROM cold_split WHERE split = 'train')) AS t
      FROM cold_split s LEFT JOIN (SELECT grid_id, quantile_cont(future_activity, 0.9) AS thr FROM cold_split
                                   WHERE split = 'train' GROUP BY grid_id) g USING (grid_id)) s""", "cold_split"))
def q_risk_labels_cold_start(spark, sf_dir):
    """The first hour alone trains: a grid that it does not have gets the overall threshold."""
    rows = P.fact_table(spark, sf_dir).select("grid_id", F.col("timestamp").alias("feature_timestamp"),
                                              F.col("total_activity").alias("future_activity"))
    made = R.risk_labels(R.chrono_split(rows, ratio=0.0))
    return made.select("grid_id", "feature_timestamp", "split", round6(F.col("_threshold")).alias("_threshold"), "risk_label")
