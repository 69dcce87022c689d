"""Principal components from one pass of moments."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.functions.moments import gram_by


@dataclass
class Components:
    """Directions of the columns ``(x - mean) / scale``, strongest first; ``loadings[component, column]``."""

    columns: list[str]
    mean: np.ndarray
    scale: np.ndarray
    variances: np.ndarray
    loadings: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        return self.variances / max(self.variances.sum(), 1e-300)

    def score(self, component: int, whitened: bool = False) -> Column:
        """A row's place along a component, in units of its deviation if ``whitened``; NULL if a column is."""
        w = self.loadings[component] / self.scale
        if whitened:
            spread = np.sqrt(self.variances[component])
            w = w / spread if spread > 1e-12 else np.zeros(len(w))
        out = F.lit(0.0)
        for name, weight, middle in zip(self.columns, w, self.mean):
            out = out + (F.col(name) - F.lit(float(middle))) * F.lit(float(weight))
        return out

    def restore(self, scores: list[Column]) -> dict[str, Column]:
        """Columns rebuilt from the (unwhitened) scores of the first components."""
        out = {}
        for j, name in enumerate(self.columns):
            value = F.lit(float(self.mean[j]))
            for i, s in enumerate(scores):
                value = value + s * F.lit(float(self.loadings[i, j] * self.scale[j]))
            out[name] = value
        return out

    def rows(self, spark: SparkSession, count: int | None = None) -> DataFrame:
        """``(component, variance, share, column, loading)`` of the first components."""
        out = [
            (i + 1, float(self.variances[i]), float(self.shares[i]), c, float(self.loadings[i, j]))
            for i in range(len(self.variances if count is None else self.variances[:count]))
            for j, c in enumerate(self.columns)
        ]
        return spark.createDataFrame(out, "component int, variance double, share double, column string, loading double")


def principal_components(df: DataFrame, columns: list[str], scaled: bool = True) -> Components:
    """Eigenvectors of the columns' covariance, or of their correlation if ``scaled``.

    One Gram pass over the table.  A direction's largest loading is positive
    (the first of equals), so its sign is defined; a constant column has no part
    in any direction.  Missing values are an error, as for every Gram.
    """
    gram = gram_by(df, columns[:-1], columns[-1]).get(0)
    if gram is None:
        raise ValueError("no rows")
    cov = gram.scatter / gram.n
    spread = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    flat = spread <= 1e-7 * np.maximum(np.abs(gram.mean), 1e-300)
    scale = np.where(flat, 1.0, spread) if scaled else np.ones(len(columns))
    cov = np.where(flat[:, None] | flat[None, :], 0.0, cov) / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    loadings = vectors.T[order]
    size = np.abs(loadings)
    lead = np.argmax(size >= size.max(axis=1, keepdims=True) * (1 - 1e-9), axis=1)
    loadings = loadings * np.sign(loadings[np.arange(len(lead)), lead])[:, None]
    return Components(list(columns), gram.mean, scale, np.clip(values[order], 0.0, None), loadings)
