"""Solvers against NumPy, optimality conditions and the built-in library."""

import numpy as np
import pandas as pd
import pytest

from gramlark.functions.moments import gram_by
from gramlark.operators.linear import EarlyStop, fit_linear, learning_rate_at
from gramlark.operators.mllib import fit_mllib, translate_penalty
from gramlark.operators.sgd import fit_sgd
from gramlark.plans import search

COEF = [1.5, -2.0, 0.5, 3.0, -1.0]
XS = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def lin5():
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame(rng.normal(size=(400, 5)) * [1, 2, 3, 0.1, 5] + [0, 10, -5, 1, 100], columns=XS)
    pdf["y"] = pdf[XS].to_numpy() @ COEF + 1.5 + rng.normal(size=400) * 0.1
    pdf["fold"] = (np.arange(400) % 4).astype("int32")
    return pdf


@pytest.fixture(scope="module")
def df(spark, lin5):
    return spark.createDataFrame(lin5)


@pytest.fixture(scope="module")
def gram(df):
    return gram_by(df, XS, "y")[0]


def _standard(pdf):
    x = pdf[XS].to_numpy()
    mean, std = x.mean(0), x.std(0)
    return (x - mean) / std, pdf.y.to_numpy() - pdf.y.mean(), mean, std


def test_ols_equals_lstsq(gram, lin5):
    m = fit_linear(gram)
    a = np.column_stack([np.ones(len(lin5)), lin5[XS].to_numpy()])
    want = np.linalg.lstsq(a, lin5.y.to_numpy(), rcond=None)[0]
    np.testing.assert_allclose([m.intercept, *m.coef], want, rtol=1e-8)
    assert m.rank == 5


def test_raw_convention_gives_the_same_ols(gram):
    a, b = fit_linear(gram), fit_linear(gram, convention="raw")
    np.testing.assert_allclose(a.coef, b.coef, rtol=1e-8)


@pytest.mark.parametrize("alpha", [0.001, 1.0, 100.0])
def test_ridge_closed_form(gram, lin5, alpha):
    x, y, _, std = _standard(lin5)
    want = np.linalg.solve(x.T @ x + alpha * np.eye(5), x.T @ y) / std
    np.testing.assert_allclose(fit_linear(gram, "ridge_regression", alpha).coef, want, rtol=1e-8)
    xc = lin5[XS].to_numpy() - lin5[XS].to_numpy().mean(0)
    raw = np.linalg.solve(xc.T @ xc + alpha * np.eye(5), xc.T @ y)
    got = fit_linear(gram, "ridge_regression", alpha, convention="raw").coef
    np.testing.assert_allclose(got, raw, rtol=1e-8)


@pytest.mark.parametrize("model,alpha,ratio", [
    ("lasso_regression", 0.1, 1.0), ("lasso_regression", 2.0, 1.0),
    ("elastic_net", 0.1, 0.5), ("elastic_net", 1.0, 0.1),
])
def test_coordinate_descent_meets_optimality(gram, lin5, model, alpha, ratio):
    x, y, _, _ = _standard(lin5)
    m = fit_linear(gram, model, alpha, ratio, tol=1e-14, max_iter=5000)
    b = m.scaled_coef
    g = x.T @ (y - x @ b) / len(y) - alpha * (1 - ratio) * b
    l1 = alpha * ratio
    np.testing.assert_allclose(g[b != 0], l1 * np.sign(b[b != 0]), atol=1e-6)
    assert (np.abs(g[b == 0]) <= l1 + 1e-9).all()


def test_strong_lasso_keeps_nothing(gram, lin5):
    m = fit_linear(gram, "lasso_regression", 1e6)
    assert (m.coef == 0).all() and m.intercept == pytest.approx(lin5.y.mean())


@pytest.mark.parametrize("model", ["linear_regression", "ridge_regression"])
def test_gradient_descent_reaches_the_closed_form(gram, model):
    a = fit_linear(gram, model, alpha=5.0)
    b = fit_linear(gram, model, alpha=5.0, method="gradient", learning_rate=0.5, max_iter=5000, tol=1e-15)
    np.testing.assert_allclose(b.coef, a.coef, rtol=1e-4)
    assert (np.diff([h[1] for h in b.history]) <= 1e-9).all()


def test_gradient_descent_equals_row_wise_iteration(gram, lin5):
    x, y, _, _ = _standard(lin5)
    beta, losses = np.zeros(5), []
    for _ in range(25):
        e = x @ beta - y
        beta = beta - 0.1 * (x.T @ e + 3.0 * beta) / len(y)
        losses.append((e**2).mean() + 3.0 * (beta**2).sum() / (2 * len(y)))
    m = fit_linear(gram, "ridge_regression", 3.0, method="gradient", learning_rate=0.1, max_iter=25)
    np.testing.assert_allclose([h[1] for h in m.history], losses, rtol=1e-8)
    np.testing.assert_allclose(m.scaled_coef, beta, rtol=1e-8)


def test_divergence_is_reported_not_raised(gram):
    m = fit_linear(gram, method="gradient", learning_rate=1e6, max_iter=2000)
    assert not m.converged


def test_parameters_matter_and_reruns_agree(gram):
    r2 = [fit_linear(gram, "ridge_regression", a).score(gram)["r2"] for a in (0.01, 100.0, 0.01)]
    assert r2[0] == r2[2] and abs(r2[0] - r2[1]) > 1e-6


def test_collinear_and_constant_columns(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.normal(size=200)})
    pdf["b"], pdf["c"] = pdf.a, 7.0
    pdf["y"] = 4 * pdf.a + 1
    m = fit_linear(gram_by(spark.createDataFrame(pdf), ["a", "b", "c"], "y")[0])
    assert m.rank == 1
    np.testing.assert_allclose(m.coef, [2.0, 2.0, 0.0], atol=1e-8)
    lasso = fit_linear(gram_by(spark.createDataFrame(pdf), ["a", "b", "c"], "y")[0], "lasso_regression", 0.1)
    assert np.isfinite(lasso.coef).all() and lasso.coef[2] == 0


def test_constant_target_scores_zero(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(10)], "x double, y double")
    g = gram_by(df, ["x"], "y")[0]
    assert fit_linear(g).score(g)["r2"] == 0.0


def test_single_row(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    g = gram_by(df, ["x"], "y")[0]
    m = fit_linear(g)
    assert m.intercept == 2.0 and m.score(g)["r2"] == 0.0


def test_prediction_column_equals_matrix_product(df, gram, lin5):
    m = fit_linear(gram, "elastic_net", 0.01)
    got = df.select(m.predict().alias("p"), "y").toPandas()
    want = lin5[XS].to_numpy() @ m.coef + m.intercept
    np.testing.assert_allclose(np.sort(got.p), np.sort(want), rtol=1e-12)


@pytest.mark.parametrize("model,alpha,ratio", [
    ("linear_regression", 1.0, 0.5), ("ridge_regression", 10.0, 0.5),
    ("lasso_regression", 0.2, 0.5), ("elastic_net", 0.2, 0.3),
])
@pytest.mark.parametrize("convention", ["raw", "standardized"])
def test_built_in_library_agrees(df, gram, model, alpha, ratio, convention):
    ours = fit_linear(gram, model, alpha, ratio, convention=convention, tol=1e-14, max_iter=20000)
    theirs = fit_mllib(df, XS, "y", model, alpha, ratio, convention=convention)
    np.testing.assert_allclose(theirs.coef, ours.coef, rtol=1e-4, atol=1e-4)
    assert theirs.intercept == pytest.approx(ours.intercept, rel=1e-3)


def test_penalty_translation():
    assert translate_penalty("linear_regression", 1, 0.5, 10, 2.0) == (0.0, 0.0)
    assert translate_penalty("ridge_regression", 5.0, 0.5, 10, 2.0) == (1.0, 0.0)
    reg, mix = translate_penalty("elastic_net", 1.0, 0.25, 10, 2.0)
    assert reg == pytest.approx(0.25 + 1.5) and mix == pytest.approx(0.25 / 1.75)


def test_sgd_comes_close_to_least_squares(df, gram):
    m = fit_sgd(df, XS, "y", learning_rate=0.05, max_iter=40, batches=32)
    assert m.score(gram)["r2"] > 0.99


def test_schedules_and_early_stop():
    assert learning_rate_at(1.0, 25, "step") == pytest.approx(0.01)
    assert learning_rate_at(1.0, 2, "exp") == pytest.approx(0.9025)
    assert learning_rate_at(1.0, 10, "inv") == pytest.approx(0.5)
    assert learning_rate_at(0.3, 7) == 0.3
    with pytest.raises(ValueError):
        learning_rate_at(1.0, 1, "cosine")
    settings = EarlyStop(patience=2)
    for _ in range(2):  # every fit starts anew
        stop = settings.watch()
        assert [stop(v) for v in (1.0, 0.5, 0.5, 0.5)] == [False, False, False, True]


def test_cross_validation_matches_direct_fits(df, lin5):
    cv = search.cross_validate(df, XS, "y", {"ridge_regression": {"alpha": 3.0}}).toPandas()
    for k in range(4):
        train, val = lin5[lin5.fold != k], lin5[lin5.fold == k]
        x, y, mean, std = _standard(train)
        b = np.linalg.solve(x.T @ x + 3.0 * np.eye(5), x.T @ y)
        for side, part in (("train", train), ("validation", val)):
            e = part.y - ((part[XS].to_numpy() - mean) / std @ b + train.y.mean())
            row = cv[(cv.fold == k) & (cv.side == side)].set_index("metric").value
            assert row["mse"] == pytest.approx((e**2).mean(), rel=1e-6)
            assert row["mae"] == pytest.approx(e.abs().mean(), rel=1e-6)
            assert row["mape"] == pytest.approx(100 * (e / part.y).abs().mean(), rel=1e-6)


def test_grid_search_finds_the_best_candidate(spark, df):
    grams = search.fold_grams(df, XS, "y")
    frame, best = search.grid_search(spark, grams, "ridge_regression")
    rows = frame.toPandas()
    assert len(rows) == 6
    assert best.hyper["alpha"] == rows.loc[rows.mse.idxmin(), "alpha"]
    assert len(search.candidates("elastic_net")) == 25


def test_reduced_search_candidates(spark, df):
    grams = search.fold_grams(df, XS, "y")
    frame, _ = search.reduced_search(spark, grams.train(0), grams.folds[0], "lasso_regression")
    assert [r["alpha"] for r in frame.orderBy("candidate").collect()] == [1.0, 0.001, 10.0]
    frame, _ = search.reduced_search(spark, grams.train(0), grams.folds[0], "elastic_net")
    assert frame.count() == 1


def test_learning_curve_reaches_the_full_training_side(df, lin5):
    keyed = df.withColumn("key", df.x0.cast("string"))
    curve = search.learning_curve(keyed, XS, "y", "key").toPandas()
    last = curve[curve.step == 10]
    assert (last["rows"] == 300).all()
    assert curve.groupby("fold")["rows"].apply(lambda s: s.is_monotonic_increasing).all()
