"""Linear models solved from Gram statistics.

The data pass is the distributed Gram; everything here works on matrices whose
size is the number of features.  Two penalty conventions exist side by side:

``standardized``  features scaled to unit population variance, target centred;
                  the ridge penalty is on the sum form, lasso and elastic net
                  on the per-row form;
``raw``           features only centred, penalties on raw-scale weights.

Weights are reported on the raw scale, so a prediction is one column
expression.  Iterations start from zero, which makes every fit repeatable.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.functions.moments import Gram

MODELS = ("linear_regression", "ridge_regression", "lasso_regression", "elastic_net")

# Default settings of the four models.
DEFAULTS = {
    "alpha": 1.0,
    "l1_ratio": 0.5,
    "learning_rate": 0.01,
    "max_iter": 1000,
    "tol": 1e-6,
}


@dataclass
class LinearModel:
    name: str
    features: list[str]
    coef: np.ndarray
    intercept: float
    hyper: dict[str, float] = field(default_factory=dict)
    scaled_coef: np.ndarray | None = None
    history: list[tuple[int, float, float | None]] = field(default_factory=list)
    rank: int | None = None
    converged: bool = True

    def predict(self) -> Column:
        """The prediction as a column expression over the raw features."""
        out = F.lit(float(self.intercept))
        for name, w in zip(self.features, self.coef):
            if w != 0.0:
                out = out + F.col(name) * F.lit(float(w))
        return out

    def score(self, gram: Gram) -> dict[str, float]:
        """mse, rmse and r2 on the rows behind ``gram``, without reading them."""
        sse, sst = gram.sse(self.coef, self.intercept), gram.sst()
        mse = sse / gram.n
        return {
            "mse": mse,
            "rmse": math.sqrt(mse),
            "r2": 1.0 - sse / sst if sst > 1e-10 else 0.0,
        }

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.name, e, float(a), None if b is None else float(b)) for e, a, b in self.history],
            "model string, epoch int, loss double, val_loss double",
        )


@dataclass(frozen=True)
class EarlyStop:
    """Settings: stop after ``patience`` epochs without an improvement of ``min_delta``.

    What a fit has seen so far is kept by the fit, so one object serves many.
    """

    patience: int = 10
    min_delta: float = 1e-6

    def watch(self) -> Callable[[float], bool]:
        """A fresh judge of successive losses; true when it is time to stop."""
        best, waited = math.inf, 0

        def stop(loss: float) -> bool:
            nonlocal best, waited
            better = loss < best - self.min_delta
            best, waited = (loss, 0) if better else (best, waited + 1)
            return waited >= self.patience

        return stop


def learning_rate_at(
    initial: float,
    epoch: int,
    schedule: str = "constant",
    gamma: float | None = None,
    step_size: int = 10,
    power: float = 1.0,
) -> float:
    """Learning rate of an epoch under a constant, step, exp or inv schedule."""
    if schedule == "constant":
        return initial
    if schedule == "step":
        return initial * (0.1 if gamma is None else gamma) ** (epoch // step_size)
    if schedule == "exp":
        return initial * (0.95 if gamma is None else gamma) ** epoch
    if schedule == "inv":
        return initial / (1 + (0.1 if gamma is None else gamma) * epoch) ** power
    raise ValueError(f"unknown schedule: {schedule}")


@dataclass
class _Problem:
    """Per-row second moments in the space the penalty acts on."""

    n: float
    g: np.ndarray
    c: np.ndarray
    yy: float
    mean: np.ndarray
    scale: np.ndarray
    y_mean: float

    def mse(self, beta: np.ndarray) -> float:
        return max(float(self.yy - 2.0 * beta @ self.c + beta @ self.g @ beta), 0.0)

    def raw(self, beta: np.ndarray) -> tuple[np.ndarray, float]:
        coef = beta / self.scale
        return coef, float(self.y_mean - coef @ self.mean)


def _problem(gram: Gram, convention: str) -> _Problem:
    if gram.n < 1:
        raise ValueError("no rows to fit on")
    if convention not in ("standardized", "raw"):
        raise ValueError(f"unknown convention: {convention}")
    cov = gram.scatter / gram.n
    mean = gram.mean
    d = len(gram.features)
    var = np.diag(cov)[:d].copy()
    # a constant column keeps only rounding noise: treat its spread as zero
    raw2 = var + mean[:d] ** 2
    flat = var <= 1e-14 * np.maximum(raw2, 1e-300)
    cov = cov.copy()
    idx = np.flatnonzero(flat)
    cov[idx, :] = 0.0
    cov[:, idx] = 0.0
    scale = np.ones(d)
    if convention == "standardized":
        scale[~flat] = np.sqrt(var[~flat])
    g = cov[:d, :d] / np.outer(scale, scale)
    c = cov[:d, d] / scale
    return _Problem(gram.n, g, c, float(cov[d, d]), mean[:d], scale, float(mean[d]))


def fit_linear(
    gram: Gram,
    model: str = "linear_regression",
    alpha: float = DEFAULTS["alpha"],
    l1_ratio: float = DEFAULTS["l1_ratio"],
    method: str = "analytical",
    learning_rate: float = DEFAULTS["learning_rate"],
    max_iter: int = DEFAULTS["max_iter"],
    tol: float = DEFAULTS["tol"],
    relative_tol: bool = False,
    convention: str = "standardized",
    schedule: str = "constant",
    schedule_args: dict | None = None,
    early_stop: EarlyStop | None = None,
    val: Gram | None = None,
) -> LinearModel:
    """Fit one of ``MODELS`` from Gram statistics.

    ``method`` chooses the closed form or gradient descent for the first two
    models; the other two use coordinate descent.  The stop rule is an absolute
    change of the loss below ``tol``, as a share of the loss if
    ``relative_tol``.  ``val`` adds a validation loss to the history and feeds
    ``early_stop``.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model: {model}")
    p = _problem(gram, convention)
    hyper: dict[str, float] = {}
    if model != "linear_regression":
        hyper["alpha"] = float(alpha)
    if model == "elastic_net":
        hyper["l1_ratio"] = float(l1_ratio)

    rank = None
    history: list = []
    converged = True
    ridge = alpha if model == "ridge_regression" else 0.0
    stop = _StopRule(p, tol, relative_tol, early_stop, val)
    if model in ("linear_regression", "ridge_regression"):
        if method == "analytical":
            beta, rank = _closed_form(p, ridge)
        elif method == "gradient":
            hyper.update(learning_rate=float(learning_rate), max_iter=float(max_iter))
            beta, history, converged = _gradient(
                p, ridge, learning_rate, max_iter, stop, schedule, schedule_args or {}
            )
        else:
            raise ValueError(f"unknown method: {method}")
    else:
        ratio = 1.0 if model == "lasso_regression" else l1_ratio
        hyper["max_iter"] = float(max_iter)
        beta, history, converged = _coordinate(
            p, alpha * ratio, alpha * (1.0 - ratio), max_iter, stop
        )
    coef, intercept = p.raw(beta)
    return LinearModel(
        model, gram.features, coef, intercept, hyper, beta, history, rank, converged
    )


def _closed_form(p: _Problem, ridge: float) -> tuple[np.ndarray, int]:
    a = p.n * p.g + ridge * np.eye(len(p.c))
    b = p.n * p.c
    # least squares of minimum norm also covers exactly collinear columns
    beta, _, rank, _ = np.linalg.lstsq(a, b, rcond=1e-12)
    return beta, int(rank)


class _StopRule:
    def __init__(self, p, tol, relative, early, val):
        self.p, self.tol, self.relative, self.val = p, tol, relative, val
        self.early = early.watch() if early else None
        self.previous = math.inf
        self.history: list[tuple[int, float, float | None]] = []

    def __call__(self, epoch: int, loss: float, beta: np.ndarray) -> bool:
        val_loss = None
        if self.val is not None:
            coef, intercept = self.p.raw(beta)
            val_loss = self.val.sse(coef, intercept) / self.val.n
        self.history.append((epoch, loss, val_loss))
        limit = self.tol * abs(loss) if self.relative else self.tol
        done = abs(self.previous - loss) < limit
        self.previous = loss
        if self.early is not None:
            done = self.early(loss if val_loss is None else val_loss) or done
        return done


def _gradient(p, ridge, rate, max_iter, stop, schedule, schedule_args):
    beta = np.zeros(len(p.c))
    done = False
    for epoch in range(max_iter):
        step = learning_rate_at(rate, epoch, schedule, **schedule_args)
        with np.errstate(over="ignore", invalid="ignore"):  # too large a step diverges
            mse = p.mse(beta)
            beta = beta - step * (p.g @ beta - p.c + ridge * beta / p.n)
            # the recorded loss pairs the error before the step with the penalty after it
            loss = mse + ridge * float(beta @ beta) / (2.0 * p.n)
        if not math.isfinite(loss):
            stop.history.append((epoch, loss, None))
            break
        done = stop(epoch, loss, beta)
        if done:
            break
    return beta, stop.history, done


def _coordinate(p, l1, l2, max_iter, stop):
    d = len(p.c)
    beta = np.zeros(d)
    gb = np.zeros(d)  # g @ beta, kept current
    diag = np.diag(p.g)
    done = False
    for epoch in range(max_iter):
        for j in range(d):
            if diag[j] <= 0.0:
                continue
            rho = p.c[j] - gb[j] + diag[j] * beta[j]
            new = math.copysign(max(abs(rho) - l1, 0.0), rho) / (diag[j] + l2)
            if new != beta[j]:
                gb += p.g[:, j] * (new - beta[j])
                beta[j] = new
        loss = p.mse(beta) + l1 * float(np.abs(beta).sum()) + 0.5 * l2 * float(beta @ beta)
        done = stop(epoch, loss, beta)
        if done:
            break
    return beta, stop.history, done
