"""Quantiles, ranks and moments against NumPy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gramlark.functions import ranks
from gramlark.functions.moments import error_sums, gram_by, metrics_from_sums, pairwise_pearson, total
from gramlark.functions.quantiles import exact_quantiles, quantile_map
from gramlark.operators.correlate import correlation_matrix, kendall_tau_b

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _columns(n=5000, seed=1):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 100)
    return pd.DataFrame(
        {
            "uniform": rng.random(n),
            "heavy": np.exp(rng.normal(size=n) * 6),
            "hot": hot,
            "constant": 3.5,
            "few": rng.integers(0, 4, n).astype(float),
            "group": rng.choice(["a", "b", "c"], n, p=[0.7, 0.25, 0.05]),
        }
    )


NAMES = ["uniform", "heavy", "hot", "constant", "few"]


@pytest.mark.parametrize("small,final", [(10**9, 10), (10, 5), (10, 100_000), (1000, 50)])
def test_quantiles_equal_numpy(spark, small, final):
    pdf = _columns()
    df = spark.createDataFrame(pdf)
    got = quantile_map(df, NAMES, PROBS, small_group_rows=small, bins=16, final_rows=final)
    for c in NAMES:
        np.testing.assert_allclose(got[c], np.quantile(pdf[c], PROBS), rtol=1e-12)


@pytest.mark.parametrize("small", [10**9, 400, 10])
def test_grouped_quantiles_mix_hot_and_small_groups(spark, small):
    pdf = _columns()
    pdf.loc[:50, "group"] = None
    df = spark.createDataFrame(pdf)
    rows = exact_quantiles(df, ["uniform", "hot"], [0.5], by=["group"], small_group_rows=small, bins=16, final_rows=20)
    got = {(r["group"], r["column"]): r["q"][0] for r in rows.collect()}
    assert len(got) == 6
    for (g, c), v in got.items():
        assert v == pytest.approx(pdf.loc[pdf.group == g, c].median(), rel=1e-12)


@pytest.mark.parametrize("small", [10**9, 2])
def test_quantiles_skip_missing_and_keep_infinities(spark, small):
    values = [float("-inf"), 1.0, 2.0, None, float("nan"), 3.0, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantile_map(df, ["x"], [0.0, 0.2, 0.4, 1.0], small_group_rows=small)["x"]
    assert got == [float("-inf"), 1.0, 2.0, float("inf")]


def test_equal_neighbours_give_exactly_their_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7.3).otherwise(0.1).alias("x"))
    probs = [i / 17 for i in range(18)]
    got = quantile_map(df, ["x"], probs, small_group_rows=10)["x"]
    assert set(got) == {0.1, 7.3}


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert quantile_map(df, ["x", "y"], [0.5]) == {"y": [1.0]}


@pytest.mark.parametrize("small", [0, 10**6])
def test_value_ranks_equal_pandas(spark, small, monkeypatch):
    monkeypatch.setattr(ranks, "SMALL_VALUES", small)
    pdf = _columns(2000)
    df = spark.createDataFrame(pdf[["group", "hot"]]).repartition(5)
    got = ranks.value_ranks(df, "hot", ["group"]).toPandas().set_index(["group", "hot"]).sort_index()
    want = pdf.assign(
        avg=pdf.groupby("group").hot.rank(), dense=pdf.groupby("group").hot.rank(method="dense") - 1
    ).drop_duplicates(["group", "hot"]).set_index(["group", "hot"]).sort_index()
    assert len(got) == len(want)
    np.testing.assert_allclose(got.avg_rank, want.avg)
    np.testing.assert_array_equal(got.dense, want.dense.astype(int))


@pytest.mark.parametrize("parts", [1, 7])
def test_row_positions(spark, parts):
    df = spark.range(1000).withColumn("h", F.md5(F.col("id").cast("string"))).repartition(parts)
    got = ranks.row_positions(df, ["h"]).orderBy("pos").toPandas()
    assert list(got.pos) == list(range(1000))
    assert list(got.h) == sorted(got.h)


def test_gram_equals_numpy_with_large_means(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(4000, 3)) + [1e7, -1e6, 0.5], columns=["a", "b", "y"])
    pdf["g"] = rng.integers(0, 3, len(pdf)).astype("int32")
    df = spark.createDataFrame(pdf)
    for shift in (None, {"a": 1e7}):
        grams = gram_by(df.repartition(6), ["a", "b"], "y", "g", shift)
        for g, part in pdf.groupby("g"):
            z = part[["a", "b", "y"]].to_numpy()
            np.testing.assert_allclose(grams[g].mean, z.mean(0), rtol=1e-12)
            # without a shift for b its second moments lose digits, as they must
            tol = 1e-9 if shift is None else 1e-2
            np.testing.assert_allclose(grams[g].scatter, np.cov(z.T, bias=True) * len(z), rtol=tol, atol=tol * len(z))
    whole = total(gram_by(df, ["a", "b"], "y", "g"))
    one = gram_by(df.coalesce(1), ["a", "b"], "y")[0]
    np.testing.assert_allclose(whole.scatter, one.scatter, rtol=1e-10)
    rest = whole - gram_by(df, ["a", "b"], "y", "g")[0]
    assert rest.n == (pdf.g != 0).sum()


def test_gram_refuses_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "x double, y double")
    with pytest.raises(ValueError, match="missing"):
        gram_by(df, ["x"], "y")


def _gappy(n=600):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.integers(0, 12, (n, 4)).astype(float), columns=list("abcd"))
    pdf["b"] += pdf["a"]
    pdf["d"] -= pdf["c"]
    for c in "ab":
        pdf.loc[rng.random(n) < 0.1, c] = np.nan
    pdf["k"] = 1.0
    return pdf


def _frame(spark, pdf):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))


def test_pearson_is_pairwise_complete_and_undefined_for_constants(spark):
    pdf = _gappy()
    got = pairwise_pearson(_frame(spark, pdf).repartition(5), list(pdf.columns))
    np.testing.assert_allclose(got[:4, :4], pdf[list("abcd")].corr().to_numpy(), atol=1e-12)
    assert np.isnan(got[4]).all()


def test_spearman_ranks_within_common_rows(spark):
    pdf = _gappy().drop(columns="k")
    got = correlation_matrix(_frame(spark, pdf), "spearman")
    for i, a in enumerate(pdf.columns):
        for j, b in enumerate(pdf.columns):
            both = pdf[[a, b]].dropna() if a != b else pdf[[a]].dropna()
            want = 1.0 if a == b else both[a].rank().corr(both[b].rank())
            assert got[i, j] == pytest.approx(want, abs=1e-12)


def _tau(x, y):
    s = np.sign(np.subtract.outer(x, x)) * np.sign(np.subtract.outer(y, y))
    tx, ty = np.sign(np.subtract.outer(x, x)) ** 2, np.sign(np.subtract.outer(y, y)) ** 2
    return s.sum() / np.sqrt(tx.sum() * ty.sum())


@pytest.mark.parametrize("small,block", [(10**6, 4096), (0, 3)])
def test_kendall_equals_brute_force(spark, small, block, monkeypatch):
    monkeypatch.setattr(ranks, "SMALL_VALUES", small)
    pdf = _gappy(300)
    df = _frame(spark, pdf)
    both = pdf[["a", "b"]].dropna()
    assert kendall_tau_b(df, "a", "b", block) == pytest.approx(_tau(both.a.to_numpy(), both.b.to_numpy()), abs=1e-12)
    assert np.isnan(kendall_tau_b(df, "a", "k", block))


def test_error_sums_give_metrics_of_many_models(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(500, 2)) + 5, columns=["x", "y"])
    models = [(np.array([1.0]), 0.0), (np.array([0.0]), 5.0)]
    sums = error_sums(spark.createDataFrame(pdf), ["x"], "y", models)[0]
    m = metrics_from_sums(sums)
    e = pdf.y - pdf.x
    assert m["mse"][0] == pytest.approx((e**2).mean())
    assert m["mae"][0] == pytest.approx(e.abs().mean())
    assert m["r2"][0] == pytest.approx(1 - (e**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
    assert m["explained_variance"][1] == pytest.approx(0.0, abs=1e-12)
