"""Stochastic gradient descent for plain linear regression.

Rows fall into mini-batches by a hash of their content.  One pass gives a Gram
matrix per batch, and the gradient of a batch's squared loss is
``(G w - c) / n``, so all epochs run on these matrices: the steps depend on the
rows alone, not on how they are laid out over tasks.  The number of batches is
fixed; their size grows with the table.

The step size is "adaptive": it stays until the training loss stops improving
for a number of epochs, then is divided by five.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import hashed_bucket
from gramlark.functions.moments import gram_by, total
from gramlark.operators.linear import LinearModel

BATCHES = 32
SMALLEST_RATE = 1e-6


def fit_sgd(
    df: DataFrame,
    features: list[str],
    target: str,
    learning_rate: float = 0.01,
    max_iter: int = 1000,
    tol: float = 1e-3,
    patience: int = 5,
    batches: int = BATCHES,
) -> LinearModel:
    """Unpenalised linear regression by mini-batch descent on standardised columns.

    Equal rows share a batch.  Missing values are an error: impute first.
    """
    names = list(features) + [target]
    content = F.struct(*[F.col(c).cast("double").alias(c) for c in names])
    placed = df.select(*names, hashed_bucket(content, F.lit(batches)).alias("_batch"))
    grams = gram_by(placed, list(features), target, by="_batch")
    if not grams:
        raise ValueError("no rows to fit on")
    whole = total(grams)
    mean, d = whole.mean, len(features)
    std = np.sqrt(np.maximum(np.diag(whole.scatter), 0.0) / whole.n)
    # a constant column keeps only rounding noise
    std = np.where(std <= 1e-7 * np.abs(mean), 1.0, std)
    std[std == 0.0] = 1.0
    units = {c: (float(m), float(s)) for c, m, s in zip(names, mean, std)}
    steps = []
    for gram in grams.values():
        z = gram.rescale(units)
        g = np.empty((d + 1, d + 1))  # of the features and a constant
        g[:d, :d], g[:d, d], g[d, :d], g[d, d] = z.q[:d, :d], z.s[:d], z.s[:d], z.n
        steps.append((z.n, g, np.append(z.q[:d, d], z.s[d]), z.q[d, d]))

    w = np.zeros(d + 1)
    rate, best, stale, history = learning_rate, math.inf, 0, []
    for epoch in range(max_iter):
        sse = 0.0
        for n, g, c, yy in steps:
            gw = g @ w
            sse += max(float(yy - 2.0 * w @ c + w @ gw), 0.0)
            w = w - rate * (gw - c) / n
        loss = sse / whole.n
        history.append((epoch, loss * float(std[d]) ** 2, None))
        stale = stale + 1 if loss > best - tol else 0
        best = min(best, loss)
        if stale >= patience:
            rate, stale = rate / 5.0, 0
            if rate < SMALLEST_RATE:
                break
    coef = w[:d] * std[d] / std[:d]
    intercept = mean[d] + w[d] * std[d] - float(coef @ mean[:d])
    return LinearModel(
        "sgd_regression", list(features), coef, float(intercept),
        {"learning_rate": learning_rate, "max_iter": float(max_iter)}, w[:d], history,
        converged=rate < SMALLEST_RATE,
    )
