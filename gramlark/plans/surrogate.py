"""Parameter search led by a surrogate of the validation error."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gramlark.operators.linear import LinearModel, fit_linear
from gramlark.plans.search import FoldGrams

LENGTHS = (0.1, 0.2, 0.4, 0.8)
NOISE = 1e-6


def lattice(model: str, alphas: tuple[float, float], ratios: tuple[float, float], steps: int) -> list[dict[str, float]]:
    """Even steps of the penalty's logarithm and, for the elastic net, of the share of its first part."""
    powers = np.linspace(math.log10(alphas[0]), math.log10(alphas[1]), steps)
    if model != "elastic_net":
        return [{"alpha": float(10**p)} for p in powers]
    return [{"alpha": float(10**p), "l1_ratio": float(r)} for p in powers for r in np.linspace(*ratios, 9)]


def _places(points: list[dict[str, float]]) -> np.ndarray:
    raw = np.array([[math.log10(p["alpha"]), p.get("l1_ratio", 0.0)] for p in points])
    spread = np.ptp(raw, axis=0)
    return (raw - raw.min(axis=0)) / np.where(spread > 0.0, spread, 1.0)


def _kernel(a: np.ndarray, b: np.ndarray, length: float) -> np.ndarray:
    return np.exp(-0.5 * ((a[:, None] - b[None]) ** 2).sum(axis=2) / length**2)


class Surrogate:
    """Gaussian process through the tried points; the length with the largest likelihood is kept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.middle, self.spread = x, y.mean(), max(float(y.std()), 1e-300)
        z = (y - self.middle) / self.spread
        fits = []
        for length in LENGTHS:
            root = np.linalg.cholesky(_kernel(x, x, length) + NOISE * np.eye(len(x)))
            half = np.linalg.solve(root, z)
            fits.append((-0.5 * half @ half - np.log(np.diag(root)).sum(), length, root, half))
        _, self.length, self.root, self.half = max(fits, key=lambda f: f[0])

    def at(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of the error at ``x``."""
        across = np.linalg.solve(self.root, _kernel(self.x, x, self.length))
        variance = np.clip(1.0 + NOISE - (across * across).sum(axis=0), 1e-12, None)
        return self.middle + self.spread * (across.T @ self.half), self.spread * np.sqrt(variance)


def expected_improvement(mean: np.ndarray, deviation: np.ndarray, best: float) -> np.ndarray:
    z = (best - mean) / deviation
    below = np.array([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in z])
    return (best - mean) * below + deviation * np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)


def surrogate_search(
    spark: SparkSession,
    grams: FoldGrams,
    model: str,
    alphas: tuple[float, float] = (0.001, 100.0),
    ratios: tuple[float, float] = (0.1, 0.9),
    steps: int = 41,
    rounds: int = 6,
    batch: int = 3,
    **fit_args,
) -> tuple[DataFrame, LinearModel]:
    """Tried parameters with their mean validation mse, round by round, and the refitted best one.

    Every try is solved from the fold Grams, so no pass over the data is needed.
    Round 0 tries the ends and the middle; each further round tries the
    ``batch`` points of the lattice that promise the largest improvement, each
    taken as seen at its predicted error before the next is chosen.  It ends early
    when no point promises a ten-thousandth of the spread seen so far.  There is
    no chance in it: the same Grams give the same tries.
    """
    points = lattice(model, alphas, ratios, steps)
    places = _places(points)
    targets = np.array([[a, r] for a in (0.0, 0.5, 1.0) for r in ((0.0, 1.0) if model == "elastic_net" else (0.0,))])
    chosen = [int(((places - t) ** 2).sum(axis=1).argmin()) for t in targets]
    seen: dict[int, float] = {}
    rows = []
    for turn in range(rounds + 1):
        for i in chosen:
            errors = [fit_linear(grams.train(k), model, **points[i], **fit_args).score(g)["mse"] for k, g in grams.folds.items()]
            seen[i] = float(np.mean(errors))
            p = points[i]
            rows.append((model, turn, p["alpha"], p.get("l1_ratio"), seen[i], float(np.std(errors))))
        x, y = list(seen), np.log(np.maximum(list(seen.values()), 1e-300))
        chosen, best, spread = [], float(y.min()), float(np.ptp(y))
        for _ in range(batch):
            left = np.array([i for i in range(len(points)) if i not in seen and i not in chosen])
            if not len(left):
                break
            mean, deviation = (guess := Surrogate(places[x], y)).at(places[left])
            gain = expected_improvement(mean, deviation, best)
            if gain.max() <= 1e-4 * spread:
                break
            i = int(left[gain.argmax()])
            chosen.append(i)
            x, y = [*x, i], np.append(y, guess.at(places[[i]])[0])
        if not chosen:
            break
    frame = spark.createDataFrame(rows, "model string, round int, alpha double, l1_ratio double, mse double, mse_std double")
    return frame, fit_linear(grams.total, model, **points[min(seen, key=seen.get)], **fit_args)
