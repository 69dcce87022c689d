"""Cross-validation, parameter search and learning curves on shared Grams.

One distributed pass gives a Gram per fold.  The training side of a fold is
the total minus the fold, so every model, penalty and fold is solved from the
same few matrices; mse and r2 need no further data pass, and the remaining
metrics of all candidates come from one more pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.functions.moments import Gram, error_sums, gram_by, metrics_from_sums, total
from gramlark.operators.linear import DEFAULTS, MODELS, LinearModel, fit_linear
from gramlark.sources.listing import hash_bucket

# The parameter grids of the search.
_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0]
GRIDS: dict[str, dict[str, list[float]]] = {
    "linear_regression": {},
    "ridge_regression": {"alpha": _ALPHAS + [100.0]},
    "lasso_regression": {"alpha": _ALPHAS},
    "elastic_net": {"alpha": _ALPHAS, "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]},
}

METRICS = ["mse", "mae", "r2", "rmse", "mape", "explained_variance"]


@dataclass
class FoldGrams:
    """Per-fold Grams of one table; see ``fold_grams``."""

    folds: dict[int, Gram]

    @property
    def total(self) -> Gram:
        return total(self.folds)

    def train(self, fold: int) -> Gram:
        return self.total - self.folds[fold]


def fold_grams(df: DataFrame, features: list[str], target: str, fold: str = "fold") -> FoldGrams:
    return FoldGrams(gram_by(df, features, target, fold))


def candidates(model: str, grid: dict[str, list[float]] | None = None) -> list[dict[str, float]]:
    grid = GRIDS[model] if grid is None else grid
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def cross_validate(
    df: DataFrame,
    features: list[str],
    target: str,
    models: dict[str, dict] | None = None,
    fold: str = "fold",
    grams: FoldGrams | None = None,
    **fit_args,
) -> DataFrame:
    """Train and validation metrics of every model on every fold.

    ``models`` maps a model name to its fit arguments.  Rows:
    ``(model, fold, side, metric, value)``.
    """
    models = models or {m: {} for m in MODELS}
    grams = grams or fold_grams(df, features, target, fold)
    fitted = [
        (name, k, fit_linear(grams.train(k), _family(name), **{**fit_args, **args}))
        for name, args in models.items()
        for k in grams.folds
    ]
    sums = error_sums(df, features, target, [(m.coef, m.intercept) for _, _, m in fitted], fold)
    rows = []
    for j, (name, k, _) in enumerate(fitted):
        sides = {
            "validation": sums[k][:, [j]],
            "train": sum(s[:, [j]] for f, s in sums.items() if f != k),
        }
        for side, s in sides.items():
            values = metrics_from_sums(s)
            rows += [(name, int(k), side, m, float(values[m][0])) for m in METRICS]
    return df.sparkSession.createDataFrame(
        rows, "model string, fold int, side string, metric string, value double"
    )


def _family(name: str) -> str:
    """Model family of a label such as ``ridge_regression`` or ``ridge_regression@a``."""
    return name.split("@")[0]


def summarise(cv: DataFrame) -> DataFrame:
    """Mean and population deviation over folds, and the best fold by r2."""
    wide = cv.groupBy("model", "side", "fold").pivot("metric", METRICS).agg(F.first("value"))
    return wide.groupBy("model", "side").agg(
        *[F.avg(m).alias(m) for m in METRICS],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in METRICS],
        F.max_by("fold", "r2").alias("best_fold"),
        F.count("*").alias("folds"),
    )


def grid_search(
    spark: SparkSession, grams: FoldGrams, model: str, grid=None, **fit_args
) -> tuple[DataFrame, LinearModel]:
    """Mean validation mse of every candidate, and the refitted best one.

    Needs no pass over the data beyond the Grams.
    """
    rows, best, best_mse = [], {}, np.inf
    for i, params in enumerate(candidates(model, grid)):
        scores = [
            fit_linear(grams.train(k), model, **params, **fit_args).score(g)["mse"]
            for k, g in grams.folds.items()
        ]
        mean = float(np.mean(scores))
        rows.append(
            (model, i, params.get("alpha"), params.get("l1_ratio"), mean, float(np.std(scores)))
        )
        if mean < best_mse:
            best, best_mse = params, mean
    frame = spark.createDataFrame(
        rows, "model string, candidate int, alpha double, l1_ratio double, mse double, mse_std double"
    )
    return frame, fit_linear(grams.total, model, **best, **fit_args)


def reduced_search(
    spark: SparkSession, train: Gram, validation: Gram, model: str, grid=None, **fit_args
) -> tuple[DataFrame, LinearModel]:
    """Defaults, then the first and last value of a one-parameter grid.

    Grids of two parameters use the defaults only.
    """
    grid = GRIDS[model] if grid is None else grid
    tried: list[dict] = [{}]
    if len(grid) == 1:
        ((name, values),) = grid.items()
        tried += [{name: values[0]}, {name: values[-1]}]
    rows, best = [], None
    for i, params in enumerate(tried):
        fitted = fit_linear(train, model, **params, **fit_args)
        mse = fitted.score(validation)["mse"]
        alpha = params.get("alpha", DEFAULTS["alpha"])
        rows.append((model, i, None if model == "linear_regression" else float(alpha), mse))
        if best is None or mse < best[0]:
            best = (mse, fitted)
    frame = spark.createDataFrame(rows, "model string, candidate int, alpha double, mse double")
    return frame, best[1]


def sensitivity(
    spark: SparkSession, train: Gram, validation: Gram, model: str, name: str, values: list[float],
    **fit_args,
) -> DataFrame:
    """r2 on both sides for each value of one parameter."""
    rows = []
    for v in values:
        arg = int(v) if name == "max_iter" else float(v)
        fitted = fit_linear(train, model, **{**fit_args, name: arg})
        nonzero = int(np.sum(np.abs(fitted.coef) > 1e-10))
        rows.append(
            (model, name, float(v), fitted.score(train)["r2"], fitted.score(validation)["r2"], nonzero)
        )
    return spark.createDataFrame(
        rows,
        "model string, parameter string, setting double, train_r2 double, val_r2 double, nonzero int",
    )


def sensitivity_spread(frame: DataFrame) -> DataFrame:
    return frame.groupBy("model", "parameter").agg(
        F.count("*").alias("settings"),
        (F.max("val_r2") - F.min("val_r2")).alias("r2_range"),
        F.stddev_pop("val_r2").alias("r2_std"),
    )


def learning_curve(
    df: DataFrame,
    features: list[str],
    target: str,
    key: str,
    model: str = "linear_regression",
    fold: str = "fold",
    sizes: int = 10,
    **fit_args,
) -> DataFrame:
    """Error by training size: growing hash shares of each training side.

    One Gram per (fold, share bucket); prefixes are running sums of buckets.
    """
    bucket = hash_bucket(F.concat_ws("-", F.lit("curve"), F.col(key)), sizes)
    cells = gram_by(
        df.withColumn("_cell", F.col(fold) * sizes + bucket), features, target, "_cell"
    )
    folds = sorted({c // sizes for c in cells})
    rows = []
    for step in range(1, sizes + 1):
        for k in folds:
            parts = {c: g for c, g in cells.items() if c // sizes != k and c % sizes < step}
            held = {c: g for c, g in cells.items() if c // sizes == k}
            if not parts or not held:
                continue
            train, val = total(parts), total(held)
            fitted = fit_linear(train, model, **fit_args)
            rows.append(
                (model, k, step, int(train.n), fitted.score(train)["mse"], fitted.score(val)["mse"])
            )
    return df.sparkSession.createDataFrame(
        rows, "model string, fold int, step int, rows bigint, train_mse double, val_mse double"
    )


def learning_curve_summary(curve: DataFrame) -> DataFrame:
    return curve.groupBy("model", "step").agg(
        F.avg("rows").alias("mean_rows"),
        F.avg("train_mse").alias("train_mean"),
        F.stddev_pop("train_mse").alias("train_std"),
        F.avg("val_mse").alias("val_mean"),
        F.stddev_pop("val_mse").alias("val_std"),
    )


def compare_implementations(cv_a: DataFrame, cv_b: DataFrame) -> DataFrame:
    """Validation metrics of two implementations side by side, with the gap."""
    def val(cv, name):
        return (
            cv.where(F.col("side") == "validation")
            .groupBy("model", "metric").agg(F.avg("value").alias(name))
        )

    both = val(cv_a, "standardized").join(val(cv_b, "raw"), ["model", "metric"])
    return both.withColumn("gap", F.col("standardized") - F.col("raw"))
