"""Regression metrics as aggregates over (truth, prediction) columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.functions.quantiles import exact_quantiles

# Smallest divisor of the percentage error, guard of r2, bands.
EPSILON, SST_GUARD = 2.220446049250313e-16, 1e-10
WITHIN = (5, 10, 20)

BASIC = ["mse", "mae", "r2", "rmse", "mape", "explained_variance"]
ADVANCED = [
    "max_error", "median_ae", "mean_ae", "residual_std", "residual_skewness",
    "residual_kurtosis", "within_5pct", "within_10pct", "within_20pct",
]


def _basic(y: Column, e: Column) -> dict[str, Column]:
    sst = F.var_pop(y) * F.count(y)
    sse = F.sum(e * e)
    guard = sst > SST_GUARD
    return {
        "mse": F.avg(e * e),
        "mae": F.avg(F.abs(e)),
        "r2": F.when(guard, 1 - sse / sst).otherwise(0.0),
        "rmse": F.sqrt(F.avg(e * e)),
        "mape": F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPSILON))) * 100,
        "explained_variance": F.when(guard, 1 - F.var_pop(e) / F.var_pop(y)).otherwise(0.0),
    }


def _advanced(y: Column, e: Column) -> dict[str, Column]:
    share = F.abs(F.try_divide(e, y))
    within = {
        f"within_{p}pct": F.avg(F.when(e.isNotNull(), F.when(share <= p / 100.0, 1.0).otherwise(0.0))) * 100
        for p in WITHIN
    }
    return {
        "max_error": F.max(F.abs(e)),
        "mean_ae": F.avg(F.abs(e)),
        "residual_std": F.stddev_pop(e),
        "residual_skewness": F.coalesce(F.skewness(e), F.lit(0.0)),
        "residual_kurtosis": F.coalesce(F.kurtosis(e), F.lit(0.0)),
        **within,
    }


def _errors(df: DataFrame, truth: Column, prediction: Column, by: list[str]) -> DataFrame:
    """Truth and error of each row; both are NULL where either side is, so no metric counts the row."""
    error = (truth - prediction).cast("double")
    return df.select(*by, F.when(error.isNotNull(), truth.cast("double")).alias("_y"), error.alias("_e"))


def row_counts(df: DataFrame, truth: Column, prediction: Column, by: list[str] = ()) -> DataFrame:
    """``n`` rows with both sides, which the metrics are about, and ``n_unpredicted`` others."""
    both = truth.isNotNull() & prediction.isNotNull()
    counts = [F.count_if(both).alias("n"), F.count_if(~both).alias("n_unpredicted")]
    return df.groupBy(*by).agg(*counts)


def basic_metrics(df: DataFrame, truth: Column, prediction: Column, by: list[str] = ()) -> DataFrame:
    by = list(by)
    m = _basic(F.col("_y"), F.col("_e"))
    return _errors(df, truth, prediction, by).groupBy(*by).agg(*[v.alias(k) for k, v in m.items()])


def guarded_metrics(df: DataFrame, truth: Column, prediction: Column, by: list[str] = ()) -> DataFrame:
    """mse, mae, rmse and r2, with r2 = 0 for a target without spread."""
    return basic_metrics(df, truth, prediction, by).select(*by, "mse", "mae", "rmse", "r2")


def all_metrics(df: DataFrame, truth: Column, prediction: Column, by: list[str] = ()) -> DataFrame:
    """Basic and advanced metrics; the median error is an exact quantile."""
    by = list(by)
    errors = _errors(df, truth, prediction, by)
    y, e = F.col("_y"), F.col("_e")
    m = {**_basic(y, e), **_advanced(y, e)}
    main = errors.groupBy(*by).agg(*[v.alias(k) for k, v in m.items()])
    absolute = errors.select(*by, F.abs("_e").alias("_a"))
    median = exact_quantiles(absolute, ["_a"], [0.5], by=by).select(
        *by, F.col("q")[0].alias("median_ae")
    )
    if by:
        joined = main.join(median, by, "left")
    else:
        joined = main.withColumn("median_ae", median.select("median_ae").scalar())
    return joined.select(*by, *BASIC, *ADVANCED)


def to_long(metrics: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows ``(by..., metric, value)``."""
    by = list(by)
    return metrics.unpivot(by, [c for c in metrics.columns if c not in by], "metric", "value")


# Labels and number formats of the metric summary.
SUMMARY = [
    ("mse", "Mean Squared Error (MSE)", "", 2, ""),
    ("mae", "Mean Absolute Error (MAE)", "$", 2, ""),
    ("rmse", "Root Mean Squared Error (RMSE)", "$", 2, ""),
    ("r2", "R-squared (R²)", "", 4, ""),
    ("mape", "Mean Absolute Percentage Error (MAPE)", "", 2, "%"),
    ("explained_variance", "Explained Variance", "", 4, ""),
    ("max_error", "Maximum Error", "$", 2, ""),
    ("median_ae", "Median Absolute Error", "$", 2, ""),
    ("residual_std", "Residual Standard Deviation", "$", 2, ""),
    ("within_5pct", "Predictions within 5% error", "", 1, "%"),
    ("within_10pct", "Predictions within 10% error", "", 1, "%"),
    ("within_20pct", "Predictions within 20% error", "", 1, "%"),
]


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Labelled, formatted metric rows of a one-row metric table."""
    entries = []
    for i, (name, label, prefix, digits, suffix) in enumerate(SUMMARY):
        if prefix:
            text = F.format_number(name, digits)
        else:
            text = F.format_string(f"%.{digits}f", F.col(name))
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(label).alias("metric"),
                F.concat(F.lit(prefix), text, F.lit(suffix)).alias("value"),
            )
        )
    return metrics.select(F.inline(F.array(*entries)))


def assessment(metrics: DataFrame) -> DataFrame:
    """Quality bands of r2 and the percentage error, as labels."""
    r2, mape = F.col("r2"), F.col("mape")
    return metrics.withColumns(
        {
            "explanatory_power": F.when(r2 > 0.8, "excellent").when(r2 > 0.6, "good").otherwise("moderate"),
            "accuracy": F.when(mape < 10, "high").when(mape < 20, "good").otherwise("needs improvement"),
            "needs_features": r2 < 0.7,
            "needs_accuracy": mape > 15,
            "high_variability": F.col("residual_std") > F.col("mae"),
            "ready": (r2 > 0.8) & (mape < 15),
        }
    )
