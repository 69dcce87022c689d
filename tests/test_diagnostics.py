"""Residual tests, components, power transforms and the surrogate search against plain arithmetic."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramlark.functions.moments import gram_by
from gramlark.functions.tails import chi_square_tail, normal_quantile, normal_tail
from gramlark.operators import power, principal, residuals
from gramlark.operators.linear import fit_linear
from gramlark.plans import search
from gramlark.plans.surrogate import lattice, surrogate_search


@pytest.mark.parametrize("x", [1e-6, 0.3, 1.0, 4.0, 11.0, 30.0, 200.0])
def test_chi_square_tail(x):
    assert chi_square_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
    for half in (1, 2, 5, 20):  # closed form for even freedom
        plain = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(half))
        assert chi_square_tail(x, 2 * half) == pytest.approx(plain, rel=1e-10, abs=1e-15)
    assert chi_square_tail(0.0, 3) == 1.0 and chi_square_tail(-1.0, 3) == 1.0
    assert normal_tail(0.0) == 0.5


def test_normal_quantile(spark):
    p = [1e-12, 1e-5, 0.02, 0.0243, 0.3, 0.5, 0.77, 0.9757, 0.98, 1 - 1e-6]
    df = spark.createDataFrame([(v,) for v in p], "p double")
    got = [r[0] for r in df.select(F.expr(normal_quantile("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(v) for v in p], rel=3e-9, abs=1e-12)


def series(spark, values):
    return spark.createDataFrame([(i // 3, i % 3, v) for i, v in enumerate(values)], "a int, v int, e double")


@pytest.mark.parametrize("n, partitions", [(40, 3), (9, 16), (2, 4), (1, 4), (200, 60)])
def test_lags_cross_partition_borders(spark, n, partitions):
    e = np.random.default_rng(n).normal(3.0, 1.0, n)
    df = series(spark, e.tolist()).orderBy(F.rand(1))
    got = residuals.lag_sums(df, ["a", "v"], "e", 5, partitions)
    d = e - e.mean()
    assert got.n == n and got.squares == pytest.approx(d @ d, abs=1e-12)
    assert got.pairs == [max(0, n - k) for k in range(1, 6)]
    assert got.products == pytest.approx([float(d[k:] @ d[:-k]) for k in range(1, 6)], abs=1e-9)
    ratio = residuals.durbin_watson(df, ["a", "v"], "e").first().durbin_watson
    assert ratio == pytest.approx(float((np.diff(e) ** 2).sum() / (e @ e)), abs=1e-9)


def test_lags_without_values(spark):
    df = series(spark, [1.0, None, 4.0, None, 2.0])
    d = np.array([1.0, 4.0, 2.0])
    got = residuals.durbin_watson(df, ["a", "v"], "e").first()
    assert tuple(got) == (3, pytest.approx((np.diff(d) ** 2).sum() / (d @ d)))
    none = series(spark, [None, None])
    assert tuple(residuals.durbin_watson(none, ["a", "v"], "e").first()) == (0, None)
    rows = residuals.autocorrelation(series(spark, [2.0, 2.0, 2.0]), ["a", "v"], "e", 4).collect()
    assert [(r.lag, r.pairs, r.autocorrelation) for r in rows] == [(1, 2, None), (2, 1, None), (3, 0, None), (4, 0, None)]


def test_autocorrelation(spark):
    noise = np.random.default_rng(4).normal(size=300)
    e = noise[1:] + 0.6 * noise[:-1]
    rows = residuals.autocorrelation(series(spark, e.tolist()), ["a", "v"], "e", 3).collect()
    d, n, box = e - e.mean(), len(e), 0.0
    for k, r in enumerate(rows, 1):
        own = float(d[k:] @ d[:-k] / (d @ d))
        box += n * (n + 2) * own**2 / (n - k)
        assert (r.autocorrelation, r.ljung_box) == (pytest.approx(own), pytest.approx(box))
        assert r.p_value == pytest.approx(chi_square_tail(box, k)) and r.p_value < 1e-4


@pytest.mark.parametrize("uneven", [False, True])
def test_breusch_pagan(spark, uneven):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 2))
    y = 2 + x @ [1.5, -1.0] + rng.normal(size=500) * (np.exp(0.5 * x[:, 0]) if uneven else 1.0)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "x0 double, x1 double, y double")
    gram = gram_by(df, ["x0", "x1"], "y")[0]
    got = {r.statistic: r for r in residuals.breusch_pagan(df, fit_linear(gram), gram, "y").collect()}
    a = np.column_stack([np.ones(500), x])
    e2 = (y - a @ np.linalg.lstsq(a, y, rcond=None)[0]) ** 2
    fitted = a @ np.linalg.lstsq(a, e2, rcond=None)[0]
    explained, total = ((fitted - e2.mean()) ** 2).sum(), ((e2 - e2.mean()) ** 2).sum()
    assert got["classic"].value == pytest.approx(explained / (2 * e2.mean() ** 2))
    assert got["studentized"].value == pytest.approx(500 * explained / total)
    assert all(r.freedom == 2 and r.p_value == pytest.approx(math.exp(-r.value / 2)) for r in got.values())
    assert (got["studentized"].p_value < 1e-6) == uneven


def test_ordered_scores(spark):
    rng = np.random.default_rng(3)
    for values, normal in ((rng.normal(7, 2, 400).round(1), True), (rng.exponential(size=400), False)):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        got = residuals.ordered_scores(df, "v").first()
        rank = np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])
        m = [NormalDist().inv_cdf((r - 0.375) / 400.25) for r in rank]
        assert got.n == 400 and got.w == pytest.approx(np.corrcoef(values, m)[0, 1] ** 2, rel=1e-7)
        assert (got.p_value > 0.01) == normal
    flat = spark.createDataFrame([(2.0,)] * 9, "v double")
    assert tuple(residuals.ordered_scores(flat, "v").first()) == (9, None, None, None)
    assert tuple(residuals.ordered_scores(flat.limit(0), "v").first()) == (0, None, None, None)


def test_principal_components(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 4)) + [1000, 0, -5, 2]
    x = np.column_stack([x, np.full(300, 7.0)])
    names = [f"c{i}" for i in range(5)]
    df = spark.createDataFrame(x.tolist(), ", ".join(f"{c} double" for c in names))
    got = principal.principal_components(df, names)
    assert np.allclose(got.loadings @ got.loadings.T, np.eye(5), atol=1e-9)
    assert got.shares.sum() == pytest.approx(1) and got.variances[3:] == pytest.approx([0, 0], abs=1e-9)
    for row in got.loadings:
        assert row[np.argmax(np.abs(row))] > 0
    scores = np.array(df.select(*[got.score(i, whitened=True) for i in range(3)]).collect())
    assert np.allclose(np.cov(scores.T, ddof=0), np.eye(3), atol=1e-8)
    back = got.restore([got.score(i) for i in range(3)])
    assert np.allclose(np.array(df.select(*back.values()).collect()), x, atol=1e-7)
    plain = principal.principal_components(df, names, scaled=False)
    assert plain.variances == pytest.approx(np.linalg.eigvalsh(np.cov(x.T, ddof=0))[::-1].clip(0), abs=1e-8)


def test_box_cox(spark):
    rng = np.random.default_rng(6)
    x = np.column_stack([np.exp(rng.normal(size=400)), rng.normal(20, 3, 400) ** 2, rng.uniform(1, 2, 400)])
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = power.fit_box_cox(df, ["a", "b", "c"])
    for i, c in enumerate("abc"):
        z = np.log(x[:, i]) - np.log(x[:, i]).mean()
        score = lambda k: -0.5 * math.log(np.var(z if k == 0 else np.exp(z * k / 100) / (k / 100)))  # noqa: E731, B023
        assert round(got.exponents[c] * 100) == max(range(-200, 301), key=score)
    made = got.transform(df)
    assert np.allclose(np.array(got.inverse(made).collect()), x, rtol=1e-9)
    zero = spark.createDataFrame([(0.0,), (1.0,)], "a double")
    with pytest.raises(ValueError, match="at or below zero"):
        power.fit_box_cox(zero, ["a"])
    with pytest.raises(ValueError, match="different values"):
        power.fit_box_cox(zero.where("a > 0"), ["a"])
    assert power.PowerTransform({"a": 0.5}, {}).transform(zero).first().a is None


@pytest.mark.parametrize("model", ["ridge_regression", "lasso_regression", "elastic_net"])
def test_surrogate_search_beats_the_grid_with_fewer_solves(spark, model):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(90, 6))
    y = x @ [3, 0, 0, -2, 0, 0.5] + rng.normal(size=90) * 4
    rows = [(*map(float, r), float(v), i % 5) for i, (r, v) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, fold int")
    grams = search.fold_grams(df, names, "y")
    wide = {"alpha": [float(10**k) for k in np.arange(-3, 2.01, 0.25)]}
    if model == "elastic_net":
        wide["l1_ratio"] = [0.1, 0.3, 0.5, 0.7, 0.9]
    grid = search.grid_search(spark, grams, model, wide)[0].toPandas()
    tried, best = surrogate_search(spark, grams, model)
    tried = tried.toPandas()
    assert len(tried) < len(grid) + (model != "elastic_net") * 4
    assert len(tried) < len(lattice(model, (0.001, 100.0), (0.1, 0.9), 41)) / 2
    assert tried.mse.min() <= grid.mse.min() * 1.001
    assert best.hyper["alpha"] == tried.loc[tried.mse.idxmin(), "alpha"]
    again = surrogate_search(spark, grams, model)[0].toPandas()
    assert again.equals(tried)
