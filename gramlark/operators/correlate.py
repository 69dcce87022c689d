"""Correlation matrices: Pearson, Spearman and Kendall, pairwise complete."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.functions.expressions import attach
from gramlark.functions.moments import pairwise_pearson
from gramlark.functions.ranks import value_ranks
from gramlark.schema import TARGET, numeric_columns
from gramlark.session import stage


def correlation_matrix(
    df: DataFrame, method: str = "pearson", columns: list[str] | None = None
) -> np.ndarray:
    columns = columns or numeric_columns(df)
    if method == "pearson":
        return pairwise_pearson(df, columns)
    if method not in ("spearman", "kendall"):
        raise ValueError(f"unknown method: {method}")
    rank_corr = _spearman if method == "spearman" else _kendall
    df = stage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "correlate")
    return rank_corr(df, columns)


def correlation_rows(df: DataFrame, method: str = "pearson", columns=None) -> DataFrame:
    """The matrix as rows ``(column_a, column_b, correlation)``; NULL if undefined."""
    columns = columns or numeric_columns(df)
    m = correlation_matrix(df, method, columns)
    rows = [
        (a, b, None if math.isnan(m[i, j]) else float(m[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_a string, column_b string, correlation double"
    )


def target_correlations(
    df: DataFrame, target: str = TARGET, columns: list[str] | None = None
) -> list[tuple[str, float | None]]:
    """``(column, |r|)`` by falling strength; undefined ones last, ties in column order."""
    columns = columns or numeric_columns(df, exclude=(target,))
    m = pairwise_pearson(df, columns + [target])[:, -1]
    pairs = [(c, None if math.isnan(r) else abs(float(r))) for c, r in zip(columns, m)]
    return sorted(pairs, key=lambda p: (p[1] is None, -(p[1] or 0.0)))


def _null_columns(df: DataFrame, columns: list[str]) -> set[str]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c for i, c in enumerate(columns) if row[f"n{i}"] > 0}


def _ranked(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace values by average ranks, one lookup per column."""
    long = df.unpivot([], columns, "column", "v")
    ranks = value_ranks(long, "v", ["column"])
    out = df
    for c in columns:
        table = ranks.where(F.col("column") == c).select(
            F.col("v").alias(c), F.col("avg_rank").alias(f"{c}__rank")
        )
        out = attach(out, table, c)
    return out.select([F.col(f"{c}__rank").alias(c) for c in columns])


def _spearman(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Pearson over ranks; ranks are taken among the rows a pair has in common."""
    gaps = _null_columns(df, columns)
    solid = [c for c in columns if c not in gaps]
    m = len(columns)
    out = np.full((m, m), np.nan)
    at = {c: i for i, c in enumerate(columns)}

    def place(subset: DataFrame, names: list[str]):
        where = [at[c] for c in names]
        # average ranks have the mean (n + 1) / 2, whatever the ties
        middle = (subset.count() + 1) / 2.0
        out[np.ix_(where, where)] = pairwise_pearson(_ranked(subset, names), names, middle)

    # pairs with gaps first: their solid-solid cells are overwritten below
    for a, b in combinations([c for c in columns if c in gaps], 2):
        place(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b), [a, b])
    for c in (c for c in columns if c in gaps):
        place(df.where(F.col(c).isNotNull()).select(*solid, c), solid + [c])
    if solid:
        place(df.select(solid), solid)
    return out


def _kendall(df: DataFrame, columns: list[str]) -> np.ndarray:
    m = len(columns)
    out = np.full((m, m), np.nan)
    for i, a in enumerate(columns):
        out[i, i] = 1.0 if df.where(F.col(a).isNotNull()).select(a).distinct().limit(2).count() > 1 else np.nan
        for j in range(i + 1, m):
            out[i, j] = out[j, i] = kendall_tau_b(df, a, columns[j])
    return out


def kendall_tau_b(df: DataFrame, x: str, y: str, block: int = 4096) -> float:
    """Kendall's tau-b without forming pairs of rows.

    Distinct (x, y) combinations are counted and both sides replaced by dense
    ranks.  A pair with x1 < x2 is concordant if, at the highest bit where the
    two y ranks differ, the first has 0 and the second 1.  So for every bit
    level, rows are grouped by the bits above it, and ordered pairs (0 before
    1, and 1 before 0) are counted with a running sum over x.  The running sum
    is taken over blocks of x ranks first and then inside each block, so no
    group is read by a single task whole.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).alias("x"), F.col(y).alias("y")
    )
    joint = stage(both.groupBy("x", "y").agg(F.count("*").alias("w")), "kendall")

    def weighted_ranks(col):
        per = joint.groupBy(F.col(col).alias("v")).agg(F.sum("w").alias("w"))
        ties = per.agg(
            F.sum("w").alias("n"),
            F.count("*").alias("distinct"),
            F.sum(F.col("w").cast("decimal(38,0)") * (F.col("w") - 1) / 2).cast("double").alias("t"),
        ).first()
        ranks = value_ranks(per.select("v"), "v")
        return ranks.select(F.col("v").alias(col), F.col("dense").alias(f"r{col}")), ties

    rx, tx = weighted_ranks("x")
    ry, ty = weighted_ranks("y")
    n = tx["n"]
    if n is None or n < 2:
        return math.nan
    pairs = n * (n - 1) / 2.0
    if tx["t"] >= pairs or ty["t"] >= pairs:
        return math.nan
    ranked = attach(attach(joint, rx, "x"), ry, "y").select("rx", "ry", "w")
    levels = max(1, (ty["distinct"] - 1).bit_length())
    lv = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    bits = ranked.withColumn("level", lv)
    bit = F.expr("shiftright(ry, level) & 1")
    per_x = (
        bits.withColumn("prefix", F.expr("shiftright(ry, level + 1)"))
        .groupBy("level", "prefix", "rx")
        .agg(
            F.sum(F.when(bit == 0, F.col("w")).otherwise(0)).alias("zeros"),
            F.sum(F.when(bit == 1, F.col("w")).otherwise(0)).alias("ones"),
        )
        .withColumn("blk", F.floor(F.col("rx") / block))
    )
    per_x = stage(per_x, "kendall-bits")
    before_blk = W.partitionBy("level", "prefix").orderBy("blk").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        per_x.groupBy("level", "prefix", "blk")
        .agg(F.sum("zeros").alias("z"), F.sum("ones").alias("o"))
        .select(
            "level", "prefix", "blk",
            F.coalesce(F.sum("z").over(before_blk), F.lit(0)).alias("z0"),
            F.coalesce(F.sum("o").over(before_blk), F.lit(0)).alias("o0"),
        )
    )
    inside = (
        W.partitionBy("level", "prefix", "blk").orderBy("rx").rowsBetween(W.unboundedPreceding, -1)
    )
    counted = per_x.join(blocks, ["level", "prefix", "blk"]).select(
        (F.col("z0") + F.coalesce(F.sum("zeros").over(inside), F.lit(0))).alias("zb"),
        (F.col("o0") + F.coalesce(F.sum("ones").over(inside), F.lit(0))).alias("ob"),
        "zeros", "ones",
    )
    row = counted.agg(
        F.sum(F.col("ones").cast("decimal(38,0)") * F.col("zb")).cast("double").alias("concordant"),
        F.sum(F.col("zeros").cast("decimal(38,0)") * F.col("ob")).cast("double").alias("discordant"),
    ).first()
    return (row["concordant"] - row["discordant"]) / math.sqrt(
        (pairs - tx["t"]) * (pairs - ty["t"])
    )
