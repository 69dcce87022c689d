"""Tests of regression residuals: order, spread and normality.

All of them are sums.  Values in order are compared without a global window:
rows are range-partitioned, lags are taken inside each partition, and only the
first and last rows of the partitions, a few each, are joined across borders by
their global position.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.functions.moments import Gram, gram_by
from gramlark.functions.ranks import value_ranks
from gramlark.functions.tails import chi_square_tail, normal_quantile, normal_tail
from gramlark.operators.linear import LinearModel, fit_linear
from gramlark.session import stage


@dataclass
class LagSums:
    n: int
    mean: float
    squares: float  # of the centred values
    pairs: list[int]  # per lag 1, 2, ...
    products: list[float]  # of centred values a lag apart
    first: float = math.nan  # centred values at the ends
    last: float = math.nan


def lag_sums(df: DataFrame, order: list[str], value: str, lags: int, partitions: int | None = None) -> LagSums:
    """Products of values 1 to ``lags`` rows apart in the order of ``order``, which must be unique.

    Rows without a value are left out before they are put in order.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"k{i}" for i in range(len(order))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], F.col(value).cast("double").alias("v"))
    rows = rows.where("v IS NOT NULL").repartitionByRange(partitions, *keys)
    rows = stage(rows.withColumn("part", F.spark_partition_id()), "in-order")
    n, mean = rows.agg(F.count("*"), F.avg("v")).first()
    if not n:
        return LagSums(0, math.nan, 0.0, [0] * lags, [0.0] * lags)
    d = F.col("v") - F.lit(mean)
    inside = W.partitionBy("part").orderBy(*keys)
    back = [F.lag(d, k).over(inside).alias(f"lag{k}") for k in range(1, lags + 1)]
    at = F.row_number().over(inside).alias("at")
    size = F.count("*").over(W.partitionBy("part")).alias("size")
    placed = rows.select("part", d.alias("d"), at, size, *back)
    ends = F.struct("at", "d")
    sums = [F.sum(F.col("d") * F.col(f"lag{k}")).alias(f"s{k}") for k in range(1, lags + 1)]
    # one row per partition, with at most ``lags`` values of either end
    parts = placed.groupBy("part").agg(
        F.max("size").alias("size"), F.sum(F.col("d") * F.col("d")).alias("squares"), *sums,
        F.collect_list(F.when(F.col("at") <= lags, ends)).alias("head"),
        F.collect_list(F.when(F.col("at") > F.col("size") - lags, ends)).alias("tail"),
    )
    before = F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = stage(parts.withColumn("off", before), "order-ends")
    heads = parts.select("off", F.inline("head")).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(lags))))
    heads = heads.where("at - k < 1").select("k", F.col("d").alias("d1"), (F.col("off") + F.col("at") - F.col("k")).alias("pos"))
    tails = parts.select("off", F.inline("tail")).select(F.col("d").alias("d0"), (F.col("off") + F.col("at")).alias("pos"))
    across = heads.join(tails, "pos").groupBy("k").agg(F.sum(F.col("d0") * F.col("d1")).alias("s"))
    border = {r.k: r.s for r in across.collect()}
    own = parts.agg(F.sum("squares").alias("squares"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(1, lags + 1)]).first()
    products = [(own[f"s{k}"] or 0.0) + border.get(k, 0.0) for k in range(1, lags + 1)]
    outer = parts.agg(F.min_by("head", "part").alias("head"), F.max_by("tail", "part").alias("tail")).first()
    pairs = [max(0, n - k) for k in range(1, lags + 1)]
    return LagSums(n, mean, own.squares, pairs, products, min(outer.head).d, max(outer.tail).d)


def durbin_watson(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """Squared steps between neighbours as a share of the squares: about 2 without serial correlation.

    One row ``(n, durbin_watson)``; NULL where all residuals are zero or none is there.
    """
    s = lag_sums(df, order, value, 1)
    squares = s.squares + s.n * s.mean**2 if s.n else 0.0
    ratio = None
    if squares > 0.0:
        # neighbours' squared steps: all squares twice, without the two ends, less twice the products
        ratio = (2.0 * s.squares - s.first**2 - s.last**2 - 2.0 * s.products[0]) / squares
    return df.sparkSession.createDataFrame([(s.n, ratio)], "n long, durbin_watson double")


def autocorrelation(df: DataFrame, order: list[str], value: str, lags: int = 5) -> DataFrame:
    """Serial correlation by lag with the Ljung-Box statistic of all lags so far and its tail probability."""
    s = lag_sums(df, order, value, lags)
    rows, box = [], 0.0
    for k, (pairs, product) in enumerate(zip(s.pairs, s.products), 1):
        if pairs < 1 or s.squares <= 0.0:
            rows.append((k, pairs, None, None, None))
            continue
        r = product / s.squares
        box += s.n * (s.n + 2.0) * r * r / pairs
        rows.append((k, pairs, r, box, chi_square_tail(box, k)))
    schema = "lag int, pairs long, autocorrelation double, ljung_box double, p_value double"
    return df.sparkSession.createDataFrame(rows, schema)


def breusch_pagan(df: DataFrame, model: LinearModel, gram: Gram, target: str) -> DataFrame:
    """Does the spread of a model's residuals follow its features?

    ``gram`` are the moments the model was fitted on.  A second Gram, of the
    features and the squared residuals, is one more pass; it needs no pass for
    its shift, as the mean squared residual is known from the first.  Rows
    ``(statistic, value, freedom, p_value)``: ``classic`` is half the explained
    squares of the residuals in units of their variance, ``studentized`` the
    rows times the share explained.
    """
    variance = gram.sse(model.coef, model.intercept) / gram.n
    squared = df.withColumn("_squared", (F.col(target) - model.predict()) ** 2)
    shift = dict(zip(gram.features, gram.mean)) | {"_squared": variance}
    second = gram_by(squared, gram.features, "_squared", shift=shift)[0]
    fitted = fit_linear(second)
    explained = max(0.0, second.sst() - second.sse(fitted.coef, fitted.intercept))
    k, out = fitted.rank, []
    for name, value in (
        ("classic", explained / (2.0 * variance**2) if variance > 0.0 else None),
        ("studentized", second.n * explained / second.sst() if second.sst() > 0.0 else None),
    ):
        out.append((name, value, k, None if value is None else chi_square_tail(value, k)))
    return df.sparkSession.createDataFrame(out, "statistic string, value double, freedom int, p_value double")


def ordered_scores(df: DataFrame, column: str) -> DataFrame:
    """Normality by the squared correlation of the values with normal scores of their average ranks.

    Equal values share the score of their average rank, so the work is per
    distinct value.  ``z`` and ``p_value`` follow the usual log-normal
    approximation of one minus the statistic, made for 5 to 5,000 rows and used
    beyond that as it is.  One row ``(n, w, z, p_value)``; ``w`` is NULL for
    fewer than three rows or a constant column.
    """
    ranks = value_ranks(df.select(F.col(column).cast("double").alias("v")))
    n, mean = df.agg(F.count(column), F.avg(F.col(column).cast("double"))).first()
    w = z = p = None
    if n >= 3:
        score = F.expr(normal_quantile(f"((avg_rank - 3.75e-1) / ({n} + 2.5e-1))"))
        each = ranks.select("cnt", (F.col("v") - F.lit(mean)).alias("d"), score.alias("m"))
        sums = {"xm": "cnt * d * m", "mm": "cnt * m * m", "xx": "cnt * d * d", "x": "cnt * d", "m": "cnt * m"}
        s = each.agg(*[F.sum(F.expr(e)).alias(k) for k, e in sums.items()]).first()
        xx, mm = s.xx - s.x**2 / n, s.mm - s.m**2 / n
        if xx > 1e-14 * max(mean * mean * n, 1e-300) and mm > 0.0:
            w = (s.xm - s.x * s.m / n) ** 2 / (xx * mm)
            u, v = math.log(n), math.log(math.log(n))
            if n >= 5 and w < 1.0:
                z = (math.log1p(-w) - (1.0521 * (v - u) - 1.2725)) / (1.0308 - 0.26758 * (v + 2.0 / u))
                p = normal_tail(z)
    return df.sparkSession.createDataFrame([(n, w, z, p)], "n long, w double, z double, p_value double")
