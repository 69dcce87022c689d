"""The same four models through ``pyspark.ml``, with penalties translated.

``pyspark.ml`` divides the squared-weight penalty by the target's standard
deviation and puts both penalties in the per-row form, so the reference's
``alpha`` has to be converted before it means the same thing.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.operators.linear import MODELS, LinearModel


def translate_penalty(
    model: str, alpha: float, l1_ratio: float, n: float, y_std: float
) -> tuple[float, float]:
    """``(regParam, elasticNetParam)`` that equal the given penalty."""
    if model == "linear_regression" or y_std == 0:
        return 0.0, 0.0
    if model == "ridge_regression":
        return alpha * y_std / n, 0.0
    ratio = 1.0 if model == "lasso_regression" else l1_ratio
    a1, a2 = alpha * ratio, alpha * (1.0 - ratio) * y_std
    reg = a1 + a2
    return (reg, a1 / reg) if reg else (0.0, 0.0)


def fit_mllib(
    df: DataFrame,
    features: list[str],
    target: str,
    model: str = "linear_regression",
    alpha: float = 1.0,
    l1_ratio: float = 0.5,
    max_iter: int = 10_000,
    convention: str = "raw",
    tol: float = 1e-10,
    solver: str = "normal",
) -> LinearModel:
    """``solver`` is Spark's; "normal" takes up to 4096 features and fails beyond, "l-bfgs" any number."""
    if model not in MODELS:
        raise ValueError(f"unknown model: {model}")
    stats = df.agg(F.count(target).alias("n"), F.stddev_pop(target).alias("s")).first()
    reg, mix = translate_penalty(model, alpha, l1_ratio, stats["n"], stats["s"] or 0.0)
    assembled = VectorAssembler(inputCols=features, outputCol="x").transform(
        df.select(*features, target)
    )
    fitted = LinearRegression(
        featuresCol="x",
        labelCol=target,
        regParam=reg,
        elasticNetParam=mix,
        maxIter=max_iter,
        tol=tol,
        standardization=convention == "standardized",
        solver=solver,
    ).fit(assembled)
    hyper = {} if model == "linear_regression" else {"alpha": float(alpha)}
    if model == "elastic_net":
        hyper["l1_ratio"] = float(l1_ratio)
    return LinearModel(
        model, list(features), np.array(fitted.coefficients), float(fitted.intercept), hyper
    )
