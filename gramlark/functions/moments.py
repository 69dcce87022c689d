"""First and second moments of wide numeric tables in one distributed pass.

Each task folds its Arrow batches into one small matrix per group with a BLAS
product and emits that matrix; Spark sums the cells by (group, cell).  What
reaches the driver depends on the number of groups and columns only.

Values are shifted by a constant per column (the mean, from one cheap
aggregate, unless the caller knows a good value) so that second moments do not
cancel for columns whose mean is far from zero.  The shift is algebraically
exact: any constant gives the same moments.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Gram:
    """Sufficient statistics of columns ``names`` (the target is the last one)."""

    names: list[str]
    n: float
    shift: np.ndarray
    s: np.ndarray  # sum of (z - shift)
    q: np.ndarray  # sum of (z - shift)(z - shift)'

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n + other.n, self.shift, self.s + other.s, self.q + other.q)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n - other.n, self.shift, self.s - other.s, self.q - other.q)

    @property
    def features(self) -> list[str]:
        return self.names[:-1]

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.s / self.n

    @property
    def scatter(self) -> np.ndarray:
        """Centred sums of squares and products."""
        return self.q - np.outer(self.s, self.s) / self.n

    def select(self, features: list[str]) -> "Gram":
        idx = [self.names.index(f) for f in features] + [len(self.names) - 1]
        return Gram(
            [self.names[i] for i in idx], self.n, self.shift[idx], self.s[idx],
            self.q[np.ix_(idx, idx)],
        )

    def rescale(self, params: dict[str, tuple[float, float]]) -> "Gram":
        """Statistics of ``(column - center) / scale`` for the columns in ``params``."""
        pairs = [params.get(c, (0.0, 1.0)) for c in self.names]
        delta = self.shift - np.array([c for c, _ in pairs])
        k = np.array([s for _, s in pairs])
        s = self.s + self.n * delta
        q = (
            self.q + np.outer(self.s, delta) + np.outer(delta, self.s)
            + self.n * np.outer(delta, delta)
        )
        return Gram(self.names, self.n, np.zeros(len(k)), s / k, q / np.outer(k, k))

    def sse(self, coef: np.ndarray, intercept: float) -> float:
        """Sum of squared errors of ``intercept + coef.x`` on these rows."""
        w = np.append(-np.asarray(coef, float), 1.0)
        bias = w @ self.mean - intercept
        return float(max(w @ self.scatter @ w, 0.0) + self.n * bias**2)

    def sst(self) -> float:
        return float(max(self.scatter[-1, -1], 0.0))


def column_means(df: DataFrame, columns: list[str]) -> np.ndarray:
    row = df.agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([0.0 if v is None else float(v) for v in row])


def _batch_matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    cols = [
        batch.column(i).to_numpy(zero_copy_only=False).astype(float, copy=False)
        for i in range(first, batch.num_columns)
    ]
    return np.column_stack(cols) if cols else np.empty((batch.num_rows, 0))


def _sum_cells(df: DataFrame, group: str, columns: list[str], cells_of, n_cells: int):
    """Sum ``cells_of(matrix)`` per integer group over the whole table."""
    picked = df.select(
        F.col(group).cast("int").alias("g") if group else F.lit(0).alias("g"),
        *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)],
    )

    def fold(batches):
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            z = _batch_matrix(batch, 1)
            g = batch.column(0).to_numpy(zero_copy_only=False)
            for key in np.unique(g):
                rows = z if (g == key).all() else z[g == key]
                cells = cells_of(rows)
                acc[int(key)] = acc[int(key)] + cells if int(key) in acc else cells
        if acc:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(acc), pa.int32()),
                    pa.array([c.tolist() for c in acc.values()], pa.list_(pa.float64())),
                ],
                names=["g", "cells"],
            )

    partial = picked.where("g IS NOT NULL").mapInArrow(fold, "g int, cells array<double>")
    rows = (
        partial.select("g", F.posexplode("cells").alias("pos", "val"))
        .groupBy("g", "pos")
        .agg(F.sum("val").alias("val"))
        .collect()
    )
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["g"], np.zeros(n_cells))[r["pos"]] = r["val"]
    return out


def gram_by(
    df: DataFrame,
    features: list[str],
    target: str,
    by: str | None = None,
    shift: dict[str, float] | None = None,
) -> dict[int, Gram]:
    """Gram statistics of ``[features, target]`` per integer group ``by``.

    ``shift`` names constants near the column means (0 for columns it leaves
    out) and saves the pass that would find the means.  Missing values are an error: impute first.
    """
    names = list(features) + [target]
    m = len(names)
    center = (
        np.array([float(shift.get(c, 0.0)) for c in names]) if shift else column_means(df, names)
    )

    def cells(z):
        missing = float(np.isnan(z).sum())
        z = z - center
        return np.concatenate([[len(z), missing], z.sum(axis=0), (z.T @ z).ravel()])

    sums = _sum_cells(df, by, names, cells, 2 + m + m * m)
    bad = sum(np.nan_to_num(v[1]) for v in sums.values())
    if bad:
        raise ValueError(f"{int(bad)} missing values among {names}; impute first")
    return {
        g: Gram(names, float(v[0]), center, v[2 : 2 + m], v[2 + m :].reshape(m, m))
        for g, v in sorted(sums.items())
    }


def total(grams: dict[int, Gram]) -> Gram:
    parts = iter(grams.values())
    acc = next(parts)
    for g in parts:
        acc = acc + g
    return acc


def pairwise_pearson(
    df: DataFrame, columns: list[str], shift: float | None = None
) -> np.ndarray:
    """Pearson correlations over the rows where both columns are present.

    A pair with a constant side, or without common rows, is NaN.  ``shift`` is
    a constant near all column means and saves the pass that finds them.
    """
    m = len(columns)
    center = column_means(df, columns) if shift is None else np.full(m, float(shift))

    def cells(z):
        present = ~np.isnan(z)
        x = np.where(present, z - center, 0.0)
        p = present.astype(float)
        return np.concatenate(
            [(p.T @ p).ravel(), (x.T @ p).ravel(), ((x * x).T @ p).ravel(), (x.T @ x).ravel()]
        )

    sums = _sum_cells(df, None, columns, cells, 4 * m * m).get(0)
    if sums is None:
        return np.full((m, m), np.nan)
    n, sx, sxx, sxy = (b.reshape(m, m) for b in np.split(sums, 4))
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sx.T / n
        var = sxx - sx * sx / n
        # rounding noise of a constant column is not variance
        var = np.where(var <= 1e-12 * np.abs(sxx), 0.0, var)
        r = cov / np.sqrt(var * var.T)
    r[~np.isfinite(r)] = np.nan
    return np.clip(r, -1.0, 1.0)


def joint_bin_counts(
    df: DataFrame, columns: list[str], target: str, edges: dict[str, list[float]]
) -> np.ndarray:
    """Rows per (column, bin of the column, bin of the target), one pass.

    A value's bin is the number of edges below it; rows without a target and
    cells without a value are left out.
    """
    cuts = [np.array(edges.get(c, []), float) for c in columns]
    target_cuts = np.array(edges.get(target, []), float)
    bins = 1 + max(len(c) for c in [*cuts, target_cuts])

    def cells(z):
        z = z[~np.isnan(z[:, -1])]
        by = np.searchsorted(target_cuts, z[:, -1], side="left")
        parts = []
        for j, cut in enumerate(cuts):
            known = ~np.isnan(z[:, j])
            slot = np.searchsorted(cut, z[known, j], side="left") * bins + by[known]
            parts.append(np.bincount(slot, minlength=bins * bins).astype(float))
        return np.concatenate(parts)

    shape = (len(columns), bins, bins)
    sums = _sum_cells(df, None, list(columns) + [target], cells, int(np.prod(shape)))
    return sums[0].reshape(shape) if sums else np.zeros(shape)


def error_sums(
    df: DataFrame,
    features: list[str],
    target: str,
    models: list[tuple[np.ndarray, float]],
    by: str | None = None,
) -> dict[int, np.ndarray]:
    """Error sums of many linear models in one pass.

    Per group, an array ``[stat, model]`` of the sums of: 1, e, e^2, |e|,
    |e|/max(|y|, eps), and the sums of y and (y-shift)^2 needed for r2.
    """
    w = np.column_stack([c for c, _ in models])
    b = np.array([i for _, i in models])
    k = len(models)
    eps = np.finfo(float).eps
    shift = float(column_means(df, [target])[0])

    def cells(z):
        x, y = z[:, :-1], z[:, -1]
        e = y[:, None] - (x @ w + b)
        a = np.abs(e)
        share = a / np.maximum(np.abs(y), eps)[:, None]
        d = y - shift
        return np.concatenate(
            [
                np.full(k, float(len(y))), e.sum(0), (e * e).sum(0), a.sum(0), share.sum(0),
                np.full(k, d.sum()), np.full(k, (d * d).sum()),
            ]
        )

    sums = _sum_cells(df, by, list(features) + [target], cells, 7 * k)
    return {g: v.reshape(7, k) for g, v in sorted(sums.items())}


def metrics_from_sums(s: np.ndarray) -> dict[str, np.ndarray]:
    """Metric arrays per model from (summed) ``error_sums`` cells."""
    n, e, se, ae, pe, d, dd = s
    sst = dd - d * d / n
    ok = sst > 1e-10
    safe = np.where(ok, sst, 1.0)
    mse = se / n
    return {
        "n": n,
        "mse": mse,
        "rmse": np.sqrt(mse),
        "mae": ae / n,
        "mape": 100.0 * pe / n,
        "r2": np.where(ok, 1.0 - se / safe, 0.0),
        "explained_variance": np.where(ok, 1.0 - (se - e * e / n) / safe, 0.0),
    }
