"""Feature selection: correlation, mutual information, elimination, hybrid."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from gramlark.functions.moments import Gram, column_means, gram_by, joint_bin_counts
from gramlark.functions.quantiles import quantile_map
from gramlark.operators.correlate import target_correlations
from gramlark.schema import TARGET, numeric_columns

METHODS = ("correlation", "mutual_info", "rfe", "hybrid")
MI_BINS = 10


def correlation_order(gram: Gram) -> list[str]:
    """Features by absolute correlation with the target, from one Gram."""
    s = gram.scatter
    var = np.diag(s)
    flat = var[:-1] <= 1e-12 * np.maximum(np.diag(gram.q)[:-1], 1e-300)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.abs(s[:-1, -1]) / np.sqrt(var[:-1] * var[-1])
    r = np.where(flat | ~np.isfinite(r), -1.0, r)
    return [gram.features[i] for i in np.argsort(-r, kind="stable")]


def by_correlation(df: DataFrame, features: list[str], target: str, k: int) -> list[str]:
    return [c for c, _ in target_correlations(df, target, features)][:k]


def mutual_information(
    df: DataFrame, features: list[str], target: str = TARGET, bins: int = MI_BINS
) -> dict[str, float]:
    """Mutual information (nats) of each feature with the target.

    Both sides are cut into equal-frequency bins; the joint counts of all
    features come from one pass.
    """
    probs = [i / bins for i in range(1, bins)]
    edges = quantile_map(df, features + [target], probs)
    out = {}
    for name, n in zip(features, joint_bin_counts(df, features, target, edges)):
        total = n.sum()
        if total == 0:
            out[name] = 0.0
            continue
        expected = np.outer(n.sum(axis=1), n.sum(axis=0))
        seen = n > 0
        out[name] = float((n[seen] / total * np.log(n[seen] * total / expected[seen])).sum())
    return out


def by_mutual_information(df, features, target, k, bins: int = MI_BINS) -> list[str]:
    score = mutual_information(df, features, target, bins)
    return sorted(features, key=lambda f: -score[f])[:k]


def eliminate(gram: Gram, k: int) -> list[str]:
    """Recursive elimination: drop the smallest squared weight until k are left.

    Works on one Gram matrix; weights are those of the raw-scale least squares
    fit, of minimum norm if columns are collinear.  Ties drop the first column.
    """
    left = list(gram.features)
    while len(left) > max(k, 1):
        g = gram.select(left)
        s = g.scatter
        d = len(left)
        # equilibrate before the rank decision, then go back to raw weights
        scale = np.sqrt(np.maximum(np.diag(s)[:d], 0.0))
        scale[scale == 0] = 1.0
        a = s[:d, :d] / np.outer(scale, scale)
        beta = np.linalg.lstsq(a, s[:d, d] / scale, rcond=1e-10)[0] / scale
        weight = beta**2
        left.pop(int(np.flatnonzero(weight <= weight.min() * (1 + 1e-9))[0]))
    return left


def select_features(
    df: DataFrame, target: str = TARGET, method: str = "hybrid", k_best: int = 20,
    features: list[str] | None = None,
    scaling: dict[str, tuple[float, float]] | None = None,
) -> list[str]:
    """Names of the selected features (the target is not among them).

    With ``scaling`` (center and scale per column) the choice is the one the
    scaled table would give, though the table passed in is not scaled:
    correlation and mutual information do not change under scaling, and the
    Gram of the scaled columns follows from the unscaled one.
    """
    features = features or numeric_columns(df, exclude=(target,))
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    if method == "correlation":
        return by_correlation(df, features, target, k_best)
    if method == "mutual_info":
        return by_mutual_information(df, features, target, k_best)
    shift = {c: center for c, (center, _) in (scaling or {}).items()}
    if shift:
        shift[target] = float(column_means(df, [target])[0])
    gram = gram_by(df, features, target, shift=shift or None)[0].rescale(scaling or {})
    if method == "rfe":
        return eliminate(gram, k_best)
    # one Gram serves the correlation filter and the elimination
    strong = correlation_order(gram)[: max(1, len(features) // 2)]
    informative = by_mutual_information(df, strong, target, max(1, len(strong) // 2))
    return eliminate(gram.select(informative), min(k_best, len(informative)))
