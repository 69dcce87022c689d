"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """True for vectors that are not null, not zero and hold finite numbers only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    clean = ~F.exists(column, bad) & F.exists(column, lambda x: x != 0)
    return F.col(column).isNotNull() & F.coalesce(clean, F.lit(False))


def matrix(values: pd.Series, width: int | None = None) -> np.ndarray:
    if not len(values):
        return np.zeros((0, width or 0))
    return np.stack(values.to_numpy()).astype("float64")


def sample(df: DataFrame, rows: int, key: str, column: str = "embedding") -> np.ndarray:
    """At most ``rows`` vectors, those with the smallest hash of ``key``: a bounded training sample."""
    got = df.select(key, column).orderBy(F.xxhash64(key), key).limit(rows).toPandas()
    return matrix(got[column])


def by_number(numbers: list[int], index: str) -> Column:
    """The number at a small index column, as an expression."""
    return F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col(index) + 1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's centres of a bounded sample; an empty centre moves to the farthest row."""
    k = max(1, min(k, len(x)))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        d = (centres**2).sum(1) - 2 * x @ centres.T
        near = d.argmin(1)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        full = size > 0
        centres[full] = total[full] / size[full, None]
        if not full.all():
            far = np.argsort(-(d[np.arange(len(x)), near] + (x**2).sum(1)), kind="stable")
            centres[~full] = x[far[: int((~full).sum())]]
    return centres
