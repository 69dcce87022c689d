"""Metric, ranking and report queries over out-of-fold predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import q, query, rounded
from gramlark.catalog.models import _CV, _pred, _single_cv, out_of_fold
from gramlark.operators import evaluate
from gramlark.plans import ranking, reports, search
from gramlark.sources.listing import with_listing

# decimals each metric is compared to
DIGITS = {
    "mse": 0, "mae": 4, "r2": 8, "rmse": 4, "mape": 6, "explained_variance": 8, "max_error": 4,
    "median_ae": 4, "mean_ae": 4, "residual_std": 4, "residual_skewness": 6, "residual_kurtosis": 6,
    "within_5pct": 6, "within_10pct": 6, "within_20pct": 6,
}

_M2, _M3, _M4 = ("avg({0})".format(f"(e - me) ** {k}") for k in (2, 3, 4))
_EXPR = {
    "mse": "avg(e * e)",
    "mae": "avg(abs(e))",
    "r2": "1 - sum(e * e) / (var_pop(y) * count(*))",
    "rmse": "sqrt(avg(e * e))",
    "mape": "avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100",
    "explained_variance": "1 - var_pop(e) / var_pop(y)",
    "max_error": "max(abs(e))",
    "median_ae": "median(abs(e))",
    "mean_ae": "avg(abs(e))",
    "residual_std": "stddev_pop(e)",
    "residual_skewness": f"{_M3} / pow({_M2}, 1.5)",
    "residual_kurtosis": f"{_M4} / pow({_M2}, 2) - 3",
    "within_5pct": "avg(CASE WHEN abs(e / nullif(y, 0)) <= 0.05 THEN 100.0::DOUBLE ELSE 0 END)",
    "within_10pct": "avg(CASE WHEN abs(e / nullif(y, 0)) <= 0.1 THEN 100.0::DOUBLE ELSE 0 END)",
    "within_20pct": "avg(CASE WHEN abs(e / nullif(y, 0)) <= 0.2 THEN 100.0::DOUBLE ELSE 0 END)",
}
_ERR = _pred() + (
    ", er AS (SELECT fold, y, yhat, y - yhat AS e, avg(y - yhat) OVER (PARTITION BY fold) AS me FROM p)"
)
_ERR_ALL = _pred() + ", er AS (SELECT fold, y, yhat, y - yhat AS e, avg(y - yhat) OVER () AS me FROM p)"


def _select(names):
    return ", ".join(f"{q(_EXPR[n], DIGITS[n])} AS {n}" for n in names)


@query(with_listing(f"SELECT fold, {_select(evaluate.BASIC)} FROM er GROUP BY 1", _ERR))
def metrics_basic(spark, sf):
    df = out_of_fold(spark, sf)
    return rounded(evaluate.basic_metrics(df, F.col("y"), F.col("yhat"), ["fold"]), DIGITS)


@query(with_listing(f"SELECT fold, {_select(evaluate.BASIC + evaluate.ADVANCED)} FROM er GROUP BY 1", _ERR))
def metrics_all(spark, sf):
    df = out_of_fold(spark, sf)
    return rounded(evaluate.all_metrics(df, F.col("y"), F.col("yhat"), ["fold"]), DIGITS)


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{n}' AS metric, {q(_EXPR[n], DIGITS[n])} AS value FROM er" for n in _EXPR), _ERR_ALL))
def metrics_overall(spark, sf):
    df = out_of_fold(spark, sf)
    wide = rounded(evaluate.all_metrics(df, F.col("y"), F.col("yhat")), DIGITS)
    return evaluate.to_long(wide)


@query(with_listing("""
SELECT fold, 0.0::DOUBLE AS r2, (round(avg(abs(e)), 4) + 0.0)::DOUBLE AS mae FROM er GROUP BY 1""",
    _pred() + ", er AS (SELECT fold, 3.0::DOUBLE - yhat AS e FROM p)"))
def metrics_constant_target(spark, sf):
    """A target without spread has r2 = 0."""
    df = out_of_fold(spark, sf)
    out = evaluate.guarded_metrics(df, F.lit(3.0), F.col("yhat"), ["fold"])
    return rounded(out.select("fold", "r2", "mae"), {"mae": 4})


def _text(name, prefix, digits, suffix):
    if prefix:
        return f"format('{prefix}{{:,.{digits}f}}{suffix}', {_EXPR[name]})"
    return f"printf('%.{digits}f', {_EXPR[name]}) || '{suffix}'"


def _summary_sql(head, key):
    """One row per summary line; ``head(i)`` gives the leading columns."""
    return " UNION ALL ".join(
        f"SELECT {head(i)}, '{label}' AS {key}, {_text(n, p, d, x)} AS value FROM er"
        for i, (n, label, p, d, x) in enumerate(evaluate.SUMMARY)
    )


@query(with_listing(_summary_sql(lambda i: f"{i}::INTEGER AS position", "metric"), _ERR_ALL))
def metrics_summary_text(spark, sf):
    df = out_of_fold(spark, sf)
    return evaluate.metrics_summary(evaluate.all_metrics(df, F.col("y"), F.col("yhat")))


@query(with_listing(f"""
SELECT fold, CASE WHEN r2 > 0.8 THEN 'excellent' WHEN r2 > 0.6 THEN 'good' ELSE 'moderate' END AS explanatory_power,
       CASE WHEN mape < 10 THEN 'high' WHEN mape < 20 THEN 'good' ELSE 'needs improvement' END AS accuracy,
       r2 < 0.7 AS needs_features, mape > 15 AS needs_accuracy, residual_std > mae AS high_variability,
       r2 > 0.8 AND mape < 15 AS ready
FROM (SELECT fold, {', '.join(f'{_EXPR[n]} AS {n}' for n in ('r2', 'mape', 'mae', 'residual_std'))} FROM er GROUP BY 1)""", _ERR))
def metrics_assessment(spark, sf):
    df = out_of_fold(spark, sf)
    bands = evaluate.assessment(evaluate.all_metrics(df, F.col("y"), F.col("yhat"), ["fold"]))
    return bands.select("fold", "explanatory_power", "accuracy", "needs_features", "needs_accuracy",
                        "high_variability", "ready")


_BANDS = {
    "explanatory_power": "CASE WHEN r2 > 0.8 THEN 'excellent' WHEN r2 > 0.6 THEN 'good' ELSE 'moderate' END",
    "accuracy": "CASE WHEN mape < 10 THEN 'high' WHEN mape < 20 THEN 'good' ELSE 'needs improvement' END",
    "needs_features": "(r2 < 0.7)::VARCHAR",
    "needs_accuracy": "(mape > 15)::VARCHAR",
    "high_variability": "(residual_std > mae)::VARCHAR",
    "ready": "(r2 > 0.8 AND mape < 15)::VARCHAR",
}


@query(with_listing(
    _summary_sql(lambda i: "'metrics' AS section", "key") + " UNION ALL "
    + " UNION ALL ".join(f"SELECT 'assessment', '{k}', {e} FROM bands" for k, e in _BANDS.items()),
    _ERR_ALL + ", bands AS (SELECT "
    + ", ".join(f"{_EXPR[n]} AS {n}" for n in ("r2", "mape", "mae", "residual_std")) + " FROM er)"))
def model_report_rows(spark, sf):
    return reports.model_report(out_of_fold(spark, sf), F.col("y"), F.col("yhat"))


# -- rankings ---------------------------------------------------------------

_VAL = _CV + ", val AS (SELECT * FROM summary WHERE side = 'validation')"


def _summary(spark, sf):
    return search.summarise(_single_cv(spark, sf))


_RANK = f"""SELECT row_number() OVER (ORDER BY r2 DESC)::INTEGER AS rank, model, {q('r2', 8)} AS val_r2,
  {q('rmse', 4)} AS val_rmse, {q('mae', 4)} AS val_mae FROM val"""
_RANK_DIGITS = {"val_r2": 8, "val_rmse": 4, "val_mae": 4}


@query(with_listing(_RANK, _VAL))
def rank_by_r2(spark, sf):
    return rounded(ranking.rank_models(_summary(spark, sf)), _RANK_DIGITS)


@query(with_listing(f"SELECT * FROM ({_RANK}) WHERE rank <= 2", _VAL))
def rank_best_two(spark, sf):
    return rounded(ranking.best_models(_summary(spark, sf), 2), _RANK_DIGITS)


@query(with_listing(f"""SELECT arg_max(model, r2) AS best_model, count(*) AS total_models, {q('max(r2)', 8)} AS best_r2,
  {q('arg_max(rmse, r2)', 4)} AS best_rmse, {q('avg(r2)', 8)} AS avg_r2, {q('avg(rmse)', 4)} AS avg_rmse FROM val""", _VAL))
def rank_summary(spark, sf):
    out = ranking.ranking_summary(ranking.rank_models(_summary(spark, sf)))
    return rounded(out, {"best_r2": 8, "best_rmse": 4, "avg_r2": 8, "avg_rmse": 4})


@query(with_listing(f"""SELECT row_number() OVER (ORDER BY score DESC)::INTEGER AS rank, model, {q('score', 8)} AS score
  FROM (SELECT model, 2 * r2 + 0.5::DOUBLE / (1 + mae) + 0.5::DOUBLE / (1 + rmse) AS score FROM val)""", _VAL))
def rank_by_weighted_criteria(spark, sf):
    out = ranking.rank_by_criteria(_summary(spark, sf), ["r2", "mae", "rmse"], [2.0, 0.5, 0.5])
    return rounded(out, 8)


@query(with_listing("""SELECT row_number() OVER (ORDER BY r2 DESC)::INTEGER AS rank,
  array_to_string(list_transform(string_split(model, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS model,
  printf('%.4f ± %.4f', r2, r2_std) AS r2, printf('%.2f ± %.2f', mse, mse_std) AS mse, printf('%.2f ± %.2f', mae, mae_std) AS mae,
  printf('%.2f ± %.2f', rmse, rmse_std) AS rmse, printf('%.2f%%', mape) AS mape FROM val""", _VAL))
def comparison_table(spark, sf):
    return ranking.comparison_table(_summary(spark, sf))


@query(with_listing(" UNION ALL ".join(
    f"""SELECT array_to_string(list_transform(string_split(model, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS model,
  side, '{m}' AS metric, {q(m, d)} AS mean, {q(m + '_std', d)} AS std FROM summary"""
    for m, d in (("mse", 0), ("mae", 4), ("r2", 8), ("rmse", 4))), _CV))
def model_bars(spark, sf):
    bars = ranking.model_bars(_summary(spark, sf))
    digits = {"mse": 0, "mae": 4, "r2": 8, "rmse": 4}

    def at(c):
        out = F.col(c)
        for m, d in digits.items():
            out = F.when(F.col("metric") == m, F.round(c, d)).otherwise(out)
        return out.alias(c)

    return bars.select("model", "side", "metric", at("mean"), at("std"))


@query(with_listing(" UNION ALL ".join(
    f"SELECT 'ranking' AS section, printf('%02d', rank) || '.{k}' AS key, {e} AS value FROM ranked"
    for k, e in (("model", "model"), ("val_r2", "printf('%.4f', r2)"), ("val_rmse", "printf('%.2f', rmse)"))),
    _VAL + ", ranked AS (SELECT row_number() OVER (ORDER BY r2 DESC)::INTEGER AS rank, model, r2, rmse FROM val)"))
def selection_report_rows(spark, sf):
    return reports.selection_report(ranking.rank_models(_summary(spark, sf)))
