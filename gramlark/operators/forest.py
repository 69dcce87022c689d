"""Isolation forest over one column.

A forest over a single column is a step function of the value: trees only ever
cut the line.  The trees are grown from bounded samples (that is the method:
100 trees of 256 rows), their cuts are merged into one sorted list of steps,
and scoring the table is a binary search in that list per row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import flag
from gramlark.functions.quantiles import quantile_map

# Forest size, sample size and expected share of outliers.
TREES, SAMPLE, CONTAMINATION, SEED = 100, 256, 0.1, 42


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a tree over n rows."""
    n = np.asarray(n, float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _tree_steps(values: np.ndarray, rng: np.random.Generator, limit: int):
    """Cut points of one random tree and the path length between them."""
    cuts, lengths = [], []
    pending = [(np.sort(values), 0)]
    while pending:  # leaves come out from left to right
        v, depth = pending.pop()
        if depth >= limit or len(v) <= 1 or v[0] == v[-1]:
            lengths.append(depth + float(average_path(len(v))))
            if pending:
                cuts.append(pending[-1][2])
                pending[-1] = pending[-1][:2]
            continue
        cut = rng.uniform(v[0], v[-1])
        k = int(np.searchsorted(v, cut, side="right"))
        pending.append((v[k:], depth + 1, cut))
        pending.append((v[:k], depth + 1))
    return np.array(cuts), np.array(lengths)


@dataclass
class IsolationScorer:
    column: str
    steps: np.ndarray
    scores: np.ndarray  # score left of each step, and right of the last one
    cut: float

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        column: str,
        contamination: float = CONTAMINATION,
        trees: int = TREES,
        sample: int = SAMPLE,
        seed: int = SEED,
    ) -> "IsolationScorer":
        # rows are drawn by a hash of their content, so any layout gives the same sample
        draw = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed)).bitwiseAND(2**53 - 1) / 2.0**53
        values = df.select(F.col(column).cast("double").alias("v"), draw.alias("h")).where("v IS NOT NULL")
        # thin the table to a few times the wanted rows before anything is gathered
        wanted = trees * sample
        rows = values.count()
        keep = min(1.0, 3.0 * wanted / max(rows, 1))
        thin = values.where(F.col("h") <= F.lit(keep))
        picked = thin.orderBy("h", "v").limit(wanted).collect()
        data = np.array([r["v"] for r in picked])
        if len(data) == 0:
            return cls(column, np.array([]), np.array([0.5]), math.inf)
        rng = np.random.default_rng(seed)
        size = min(sample, len(data))
        limit = int(math.ceil(math.log2(max(size, 2))))
        grown = []
        for _ in range(trees):
            grown.append(_tree_steps(rng.choice(data, size, replace=False), rng, limit))
        steps = np.unique(np.concatenate([c for c, _ in grown]))
        probe = np.append(steps, np.inf)
        depth = sum(lengths[np.searchsorted(cuts, probe, side="left")] for cuts, lengths in grown)
        norm = float(average_path(size)) or 1.0
        scores = np.power(2.0, -(depth / trees) / norm)
        scorer = cls(column, steps, scores, math.inf)
        # distinct scores are at most the number of steps
        counts = scorer.with_score(df.select(column)).select("_score")
        q = quantile_map(counts, ["_score"], [1.0 - contamination])
        scorer.cut = q["_score"][0]
        return scorer

    def with_score(self, df: DataFrame, name: str = "_score") -> DataFrame:
        steps, scores = self.steps, self.scores

        @F.pandas_udf("double")
        def score(v: pd.Series) -> pd.Series:
            x = v.to_numpy(float, na_value=np.nan)
            out = scores[np.searchsorted(steps, x, side="left").clip(0, len(scores) - 1)]
            return pd.Series(np.where(np.isnan(x), np.nan, out)).where(~np.isnan(x), None)

        return df.withColumn(name, score(F.col(self.column).cast("double")))

    def _is_outlier(self, df: DataFrame) -> DataFrame:
        return self.with_score(df).withColumn(
            "_out", F.coalesce(F.col("_score") > F.lit(self.cut), F.lit(False))
        )

    def mark(self, df: DataFrame) -> DataFrame:
        return (
            self._is_outlier(df)
            .withColumn(f"{self.column}_is_outlier", flag(F.col("_out")))
            .drop("_score", "_out")
        )

    def remove(self, df: DataFrame) -> DataFrame:
        return self._is_outlier(df).where(~F.col("_out")).drop("_score", "_out")
