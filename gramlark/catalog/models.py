"""Gram, solver, cross-validation and search queries.

The solvers work on any number of features; where a query has one or two
features, the reference SQL spells out the closed form or iterates it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gramlark.catalog.base import q, query, rounded, staged_listing
from gramlark.catalog.fits_sql import FILLED, TRAIN_SIDES, moments, prediction, renamed, side_metrics, solved
from gramlark.functions.moments import gram_by, total
from gramlark.operators import folds
from gramlark.operators.impute import handle_missing
from gramlark.operators.linear import MODELS, EarlyStop, fit_linear
from gramlark.operators.mllib import fit_mllib
from gramlark.operators.sgd import fit_sgd
from gramlark.plans import search
from gramlark.schema import NUMERIC, TARGET
from gramlark.sources import registry
from gramlark.sources.listing import listing, with_listing

X1, X2 = "median_income", "total_rooms"
# the four single-feature models compared in the ranking queries
SINGLES = ["median_income", "total_rooms", "housing_median_age", "population"]


def complete(spark, sf):
    """Listing with median-filled bedrooms and folds: what the solvers need."""
    df = staged_listing(spark, sf, NUMERIC + [TARGET, "row_key"], fold=True)
    return handle_missing(df, "median", indicators=False)


# -- folds ------------------------------------------------------------------


@query(with_listing("SELECT row_key, fold FROM listing"))
def fold_by_hash(spark, sf):
    return folds.assign_folds(listing(spark, sf, ["row_key"]), "row_key", 5, seed=None)


@query(with_listing("""
SELECT row_key, CASE WHEN pos < head THEN pos // (size + 1) ELSE n % 5 + (pos - head) // size END::INTEGER AS fold
FROM (SELECT row_key, pos, n, n // 5 AS size, (n % 5) * (n // 5 + 1) AS head
      FROM (SELECT row_key, row_number() OVER (ORDER BY md5(concat_ws('-', '42', row_key)), row_key) - 1 AS pos,
                   count(*) OVER () AS n FROM listing))"""))
def fold_balanced(spark, sf):
    return folds.assign_balanced_folds(listing(spark, sf, ["row_key"]), "row_key", 5)


@query(with_listing("""
SELECT row_key, least(4, CASE WHEN pos < head THEN pos // (size + 1) ELSE n % 5 + (pos - head) // size END)::INTEGER AS fold
FROM (SELECT row_key, pos, n, n // 5 AS size, (n % 5) * (n // 5 + 1) AS head
      FROM (SELECT row_key, row_number() OVER (ORDER BY row_key) - 1 AS pos, count(*) OVER () AS n FROM listing))"""))
def fold_ordered(spark, sf):
    return folds.ordered_folds(listing(spark, sf, ["row_key"]), ["row_key"], 5)


@query(with_listing("""
SELECT row_key, CASE WHEN s < 700000 THEN 'train' WHEN s < 850000 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT row_key, ('0x' || substr(md5(concat_ws('-', '42', row_key)), 1, 8))::BIGINT % 1000000 AS s FROM listing)"""))
def three_way_split(spark, sf):
    return folds.three_way_split(listing(spark, sf, ["row_key"]), "row_key")


@query(with_listing(f"""
SELECT v.fold, n - v.c AS train_size, v.c AS validation_size, {q('t.m', 4)} AS train_mean_target,
       {q('v.m', 4)} AS validation_mean_target, {q('t.s', 4)} AS train_std_target, {q('v.s', 4)} AS validation_std_target,
       8::INTEGER AS train_features, 8::INTEGER AS validation_features,
       {q('100.0::DOUBLE * (n - v.c) / n', 6)} AS train_percentage, {q('100.0::DOUBLE * v.c / n', 6)} AS validation_percentage
FROM (SELECT fold, count(*) AS c, avg({TARGET}) AS m, stddev_samp({TARGET}) AS s FROM listing GROUP BY 1) v
JOIN (SELECT f.fold, avg({TARGET}) AS m, stddev_samp({TARGET}) AS s FROM listing l JOIN (SELECT DISTINCT fold FROM listing) f ON l.fold <> f.fold GROUP BY 1) t USING (fold),
     (SELECT count(*) AS n FROM listing)"""))
def fold_summary(spark, sf):
    df = listing(spark, sf, NUMERIC + [TARGET], fold=True)
    out = folds.fold_summary(df)
    return rounded(out, {c: 6 if "percent" in c else 4 for c in out.columns if "size" not in c and c != "fold" and "features" not in c})


@query(with_listing("""
SELECT min(n - c) AS min_train_size, max(n - c) AS max_train_size, avg(n - c) AS mean_train_size,
       min(c) AS min_validation_size, max(c) AS max_validation_size, avg(c) AS mean_validation_size
FROM (SELECT fold, count(*) AS c FROM listing GROUP BY 1), (SELECT count(*) AS n FROM listing)"""))
def fold_size_stats(spark, sf):
    return folds.fold_size_stats(folds.fold_summary(listing(spark, sf, [TARGET], fold=True)))


@query(with_listing(f"""
SELECT CASE WHEN fold = 2 THEN 'validation' ELSE 'train' END AS side, count(*) AS rows, {q(f'avg({TARGET})', 4)} AS mean
FROM listing GROUP BY 1"""))
def split_by_ids(spark, sf):
    df = staged_listing(spark, sf, ["row_key", TARGET], fold=True)
    train, validation = folds.split_by_ids(df, df.where("fold = 2"), "row_key")
    one = lambda part, name: part.agg(
        F.lit(name).alias("side"), F.count("*").alias("rows"), F.avg(TARGET).alias("mean")
    )
    return rounded(one(train, "train").unionByName(one(validation, "validation")), 4)


# -- Gram -------------------------------------------------------------------

_GRAM_COLS = [X1, X2, "housing_median_age", TARGET]


@query(with_listing(" UNION ALL ".join(
    f"SELECT fold, '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, {q(f'covar_pop({a}, {b})', 4)} AS covariance FROM listing GROUP BY 1"
    for a in _GRAM_COLS for b in _GRAM_COLS)))
def gram_by_fold(spark, sf):
    df = staged_listing(spark, sf, _GRAM_COLS, fold=True)
    grams = gram_by(df, _GRAM_COLS[:-1], TARGET, "fold")
    rows = [
        (k, a, b, int(g.n), float(g.scatter[i, j] / g.n))
        for k, g in grams.items()
        for i, a in enumerate(_GRAM_COLS)
        for j, b in enumerate(_GRAM_COLS)
    ]
    return rounded(
        spark.createDataFrame(rows, "fold int, column_a string, column_b string, n bigint, covariance double"), 4
    )


# -- solvers with one and two features --------------------------------------


def _train_moments(cols):
    """Moments of each training side (all folds but one)."""
    aggs = ", ".join(
        [f"avg({c}) AS m_{c}" for c in cols]
        + [f"covar_pop({a}, {b}) AS c_{a}_{b}" for i, a in enumerate(cols) for b in cols[i:]]
    )
    return (
        f"tr AS (SELECT f.fold, count(*)::DOUBLE AS n, {aggs} FROM listing l"
        f" JOIN (SELECT DISTINCT fold FROM listing) f ON l.fold <> f.fold GROUP BY 1)"
    )


def _one(rate):
    """One standardised feature: beta per model from correlation sums."""
    return f"SELECT fold, {q(f'{rate} / sx', 6)} AS coef, {q(f'my - ({rate}) / sx * mx', 4)} AS intercept FROM s"


_S = f""", s AS (SELECT fold, n, m_{X1} AS mx, m_{TARGET} AS my, sqrt(c_{X1}_{X1}) AS sx,
  c_{X1}_{TARGET} / sqrt(c_{X1}_{X1}) AS rho, c_{TARGET}_{TARGET} AS yy FROM tr)"""
_ONE = _train_moments([X1, TARGET]) + _S
ALPHA, L1 = 250.0, 0.3


def _fit_rows(spark, sf, features, models):
    """Coefficients per fold's training side: rows (model, fold, coef..., intercept)."""
    df = staged_listing(spark, sf, features + [TARGET], fold=True)
    grams = search.fold_grams(df, features, TARGET)
    rows = []
    for k in grams.folds:
        for args in models:
            m = fit_linear(grams.train(k), **args)
            rows.append((int(k), *map(float, m.coef), float(m.intercept)))
    names = ["coef"] if len(features) == 1 else [f"coef_{i + 1}" for i in range(len(features))]
    frame = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{n} double" for n in names) + ", intercept double")
    return rounded(frame, {**{n: 6 for n in names}, "intercept": 4})


@query(with_listing(_one("rho"), _ONE))
def fit_ols(spark, sf):
    return _fit_rows(spark, sf, [X1], [{"model": "linear_regression"}])


@query(with_listing(_one(f"n * rho / (n + {ALPHA}::DOUBLE)"), _ONE))
def fit_ridge(spark, sf):
    return _fit_rows(spark, sf, [X1], [{"model": "ridge_regression", "alpha": ALPHA}])


@query(with_listing(_one(f"sign(rho) * greatest(abs(rho) - {ALPHA}::DOUBLE, 0)"), _ONE))
def fit_lasso(spark, sf):
    return _fit_rows(spark, sf, [X1], [{"model": "lasso_regression", "alpha": ALPHA}])


@query(with_listing(_one(f"sign(rho) * greatest(abs(rho) - {ALPHA * L1}::DOUBLE, 0) / (1 + {ALPHA * (1 - L1)}::DOUBLE)"), _ONE))
def fit_elastic_net(spark, sf):
    return _fit_rows(spark, sf, [X1], [{"model": "elastic_net", "alpha": ALPHA, "l1_ratio": L1}])


_RAW = f"""SELECT fold, {{coef}} AS coef, {{icpt}} AS intercept FROM (SELECT *, {{beta}} AS b FROM (
  SELECT fold, n, m_{X1} AS mx, m_{TARGET} AS my, c_{X1}_{X1} AS xx, c_{X1}_{TARGET} AS xy FROM tr))"""


def _raw(beta):
    return with_listing(
        _RAW.format(beta=beta, coef=q("b", 6), icpt=q("my - b * mx", 4)), _train_moments([X1, TARGET])
    )


@query(_raw(f"n * xy / (n * xx + {ALPHA}::DOUBLE)"))
def fit_ridge_raw_scale(spark, sf):
    """Penalty on the raw-scale weight."""
    return _fit_rows(spark, sf, [X1], [{"model": "ridge_regression", "alpha": ALPHA, "convention": "raw"}])


@query(_raw(f"sign(xy) * greatest(abs(xy) - {ALPHA}::DOUBLE, 0) / xx"))
def fit_lasso_raw_scale(spark, sf):
    return _fit_rows(spark, sf, [X1], [{"model": "lasso_regression", "alpha": ALPHA, "convention": "raw"}])


_TWO = _train_moments([X1, X2, TARGET]) + f""", t AS (SELECT fold, n, m_{X1} AS m1, m_{X2} AS m2, m_{TARGET} AS my,
  sqrt(c_{X1}_{X1}) AS s1, sqrt(c_{X2}_{X2}) AS s2, c_{X1}_{X2} / sqrt(c_{X1}_{X1} * c_{X2}_{X2}) AS r,
  c_{X1}_{TARGET} / sqrt(c_{X1}_{X1}) AS g1, c_{X2}_{TARGET} / sqrt(c_{X2}_{X2}) AS g2, c_{TARGET}_{TARGET} AS yy FROM tr)"""


def _two(lam):
    """Cramer's rule for two standardised features with a ridge term."""
    return f"""
SELECT fold, {q('b1 / s1', 6)} AS coef_1, {q('b2 / s2', 6)} AS coef_2, {q('my - b1 / s1 * m1 - b2 / s2 * m2', 4)} AS intercept
FROM (SELECT *, n * (g1 * (n + {lam}) - n * r * g2) / det AS b1, n * (g2 * (n + {lam}) - n * r * g1) / det AS b2
      FROM (SELECT *, (n + {lam}) * (n + {lam}) - n * n * r * r AS det FROM t))"""


@query(with_listing(_two("0"), _TWO))
def fit_ols_two_features(spark, sf):
    return _fit_rows(spark, sf, [X1, X2], [{"model": "linear_regression"}])


@query(with_listing(_two(f"{ALPHA}::DOUBLE"), _TWO))
def fit_ridge_two_features(spark, sf):
    return _fit_rows(spark, sf, [X1, X2], [{"model": "ridge_regression", "alpha": ALPHA}])


def _cd_sql(l1, l2, sweeps=60):
    """Coordinate descent on two features as a recursive query."""
    def soft(v):
        return f"(sign({v}) * greatest(abs({v}) - {l1}::DOUBLE, 0) / (1 + {l2}::DOUBLE))"

    first = soft("(g1 - r * b2)")
    second = soft("(g2 - r * nb1)")
    rec = f"""cd AS (
  SELECT fold, 0 AS step, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM t
  UNION ALL
  SELECT fold, step + 1, nb1, {second} FROM (
    SELECT c.fold, step, r, g2, {first} AS nb1 FROM cd c JOIN t USING (fold) WHERE step < {sweeps}))"""
    body = f"""
SELECT fold, {q('b1 / s1', 4)} AS coef_1, {q('b2 / s2', 4)} AS coef_2, {q('my - b1 / s1 * m1 - b2 / s2 * m2', 2)} AS intercept
FROM cd JOIN t USING (fold) WHERE step = {sweeps}"""
    return with_listing(body, _TWO + ", " + rec, recursive=True)


def _cd_rows(spark, sf, **args):
    frame = _fit_rows(spark, sf, [X1, X2], [args])
    return rounded(frame, {"coef_1": 4, "coef_2": 4, "intercept": 2})


@query(_cd_sql(ALPHA, 0.0))
def fit_lasso_two_features(spark, sf):
    return _cd_rows(spark, sf, model="lasso_regression", alpha=ALPHA)


@query(_cd_sql(2.0 * L1, 2.0 * (1 - L1)))
def fit_elastic_net_two_features(spark, sf):
    return _cd_rows(spark, sf, model="elastic_net", alpha=2.0, l1_ratio=L1)


EPOCHS = 40


def _gd_sql(alpha, rate):
    """Gradient descent on one feature, all epochs, over one Gram of all rows."""
    extra = f"""s AS (SELECT count(*)::DOUBLE AS n, avg({X1}) AS mx, avg({TARGET}) AS my, stddev_pop({X1}) AS sx,
  covar_pop({X1}, {TARGET}) / stddev_pop({X1}) AS rho, var_pop({TARGET}) AS yy FROM listing),
gd AS (SELECT 0 AS epoch, 0.0::DOUBLE AS b, ({rate.format(e='0')}) * s.rho AS nb FROM s
  UNION ALL
  SELECT epoch + 1, nb, nb - ({rate.format(e='(epoch + 1)')}) * (nb - s.rho + {alpha}::DOUBLE * nb / s.n) FROM gd, s WHERE epoch < {EPOCHS - 1})"""
    body = f"""SELECT epoch::INTEGER AS epoch, {q(f'yy - 2 * b * rho + b * b + {alpha}::DOUBLE * nb * nb / (2 * n)', 0)} AS loss,
       {q('yy - 2 * nb * rho + nb * nb', 0)} AS val_loss FROM gd, s"""
    return with_listing(body, extra, recursive=True)


def _gd_rows(spark, sf, **args):
    df = staged_listing(spark, sf, [X1, TARGET])
    gram = gram_by(df, [X1], TARGET)[0]
    m = fit_linear(gram, method="gradient", max_iter=EPOCHS, val=gram, **args)
    return rounded(m.history_frame(spark).drop("model"), 0)


@query(_gd_sql(0.0, "0.1::DOUBLE"))
def fit_ols_gradient_history(spark, sf):
    return _gd_rows(spark, sf, model="linear_regression", learning_rate=0.1)


@query(_gd_sql(ALPHA, "0.1::DOUBLE"))
def fit_ridge_gradient_history(spark, sf):
    return _gd_rows(spark, sf, model="ridge_regression", alpha=ALPHA, learning_rate=0.1)


@query(_gd_sql(0.0, "0.1::DOUBLE / (1 + 0.1::DOUBLE * {e})"))
def fit_gradient_inverse_schedule(spark, sf):
    return _gd_rows(spark, sf, model="linear_regression", learning_rate=0.1, schedule="inv")


@query(_gd_sql(0.0, "0.1::DOUBLE * pow(0.95::DOUBLE, {e})"))
def fit_gradient_exponential_schedule(spark, sf):
    return _gd_rows(spark, sf, model="linear_regression", learning_rate=0.1, schedule="exp")


@query(_gd_sql(0.0, "0.1::DOUBLE * pow(0.1::DOUBLE, {e} // 10)"))
def fit_gradient_step_schedule(spark, sf):
    return _gd_rows(spark, sf, model="linear_regression", learning_rate=0.1, schedule="step")


@query()
def fit_early_stopping(spark, sf):
    """Gradient descent stopped by the validation loss, per fold."""
    grams = search.fold_grams(complete(spark, sf), NUMERIC, TARGET)
    rows = []
    for k, val in grams.folds.items():
        m = fit_linear(grams.train(k), "ridge_regression", method="gradient", learning_rate=0.1,
                       early_stop=EarlyStop(patience=10, min_delta=1.0), val=val)
        rows.append((int(k), len(m.history), float(m.history[-1][1]), float(m.history[-1][2])))
    return rounded(spark.createDataFrame(rows, "fold int, epochs int, loss double, val_loss double"), 0)


@query(with_listing(f"""
SELECT {q('n * xy / (n * xx + ' + str(ALPHA) + '::DOUBLE)', 5)} AS coef FROM (
  SELECT count(*)::DOUBLE AS n, covar_pop({X1}, {TARGET}) AS xy, var_pop({X1}) AS xx FROM listing)"""))
def fit_ridge_spark_ml(spark, sf):
    """The built-in regression with a translated penalty."""
    df = staged_listing(spark, sf, [X1, TARGET])
    m = fit_mllib(df, [X1], TARGET, "ridge_regression", ALPHA)
    return rounded(spark.createDataFrame([(float(m.coef[0]),)], "coef double"), 5)


@query()
def fit_sgd_regressor(spark, sf):
    df = complete(spark, sf)
    m = fit_sgd(df, NUMERIC, TARGET, learning_rate=0.05)
    return rounded(m.history_frame(spark).drop("model", "val_loss"), 0)


def _pred(cols="fold"):
    """Out-of-fold prediction of the one-feature fit."""
    return _ONE + f""", p AS (SELECT l.row_key, l.fold, l.{TARGET} AS y, s.my + s.rho / s.sx * (l.{X1} - s.mx) AS yhat
  FROM listing l JOIN s ON l.fold = s.fold)"""


@query(with_listing(f"SELECT row_key, fold, {q('y', 4)} AS y, {q('yhat', 4)} AS yhat FROM p", _pred()))
def predict_out_of_fold(spark, sf):
    return rounded(out_of_fold(spark, sf).select("row_key", "fold", "y", "yhat"), 4)


def out_of_fold(spark, sf):
    """Every row predicted by the fit that did not see its fold."""
    df = staged_listing(spark, sf, [X1, TARGET, "row_key"], fold=True)
    grams = search.fold_grams(df, [X1], TARGET)
    yhat = None
    for k in grams.folds:
        m = fit_linear(grams.train(k), "linear_regression")
        branch = F.col("fold") == int(k)
        yhat = F.when(branch, m.predict()) if yhat is None else yhat.when(branch, m.predict())
    return df.select("row_key", "fold", X1, F.col(TARGET).alias("y"), yhat.alias("yhat"))


# -- cross-validation and search --------------------------------------------


_FOUR = [("linear_regression", 0, 0.0, 0.0), ("ridge_regression", 1, 0.0, 0.0), ("lasso_regression", 0, 1.0, 0.0), ("elastic_net", 0, 0.5, 0.5)]
_CV_DIGITS = {"mse": 1, "mae": 4, "r2": 6, "rmse": 4, "mape": 4, "explained_variance": 6}


@query(with_listing(
    side_metrics(_CV_DIGITS), ",\n".join([FILLED, TRAIN_SIDES, moments(NUMERIC), solved(_FOUR, len(NUMERIC))]), recursive=True
))
def cv_four_models(spark, sf):
    """Mean and deviation of the metrics of all four models over five folds."""
    cv = search.cross_validate(complete(spark, sf), NUMERIC, TARGET)
    return rounded(search.summarise(cv), _CV_DIGITS | {f"{m}_std": d for m, d in _CV_DIGITS.items()})


def _all_features(models):
    # the walk ends by the change of its loss, which leaves later digits of a weight open
    columns = ", ".join(q(f"coef[{i}]", 4) + f" AS coef_{i}" for i in range(1, len(NUMERIC) + 1))
    body = f"SELECT grp::INTEGER AS fold, {columns}, {q('intercept', 2)} AS intercept FROM coefs"
    return with_listing(body, ",\n".join([FILLED, TRAIN_SIDES, moments(NUMERIC), solved(models, len(NUMERIC))]), recursive=True)


def _fit_all(spark, sf, **args):
    grams = search.fold_grams(complete(spark, sf), NUMERIC, TARGET)
    fits = [(int(k), fit_linear(grams.train(k), **args)) for k in grams.folds]
    names = [f"coef_{i + 1}" for i in range(len(NUMERIC))]
    rows = [(k, *map(float, m.coef), float(m.intercept)) for k, m in fits]
    frame = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{n} double" for n in names) + ", intercept double")
    return rounded(frame, {**{n: 4 for n in names}, "intercept": 2})


@query(_all_features(_FOUR[:1]))
def fit_ols_all_features(spark, sf):
    return _fit_all(spark, sf, model="linear_regression")


@query(_all_features([("ridge_regression", ALPHA, 0.0, 0.0)]))
def fit_ridge_all_features(spark, sf):
    return _fit_all(spark, sf, model="ridge_regression", alpha=ALPHA)


@query(_all_features([("lasso_regression", 0, ALPHA, 0.0)]))
def fit_lasso_all_features(spark, sf):
    return _fit_all(spark, sf, model="lasso_regression", alpha=ALPHA)


@query(_all_features([("elastic_net", 0, ALPHA * L1, ALPHA * (1 - L1))]))
def fit_elastic_net_all_features(spark, sf):
    return _fit_all(spark, sf, model="elastic_net", alpha=ALPHA, l1_ratio=L1)


def _single_cv(spark, sf):
    """Four one-feature least-squares models, cross-validated from shared Grams."""
    from gramlark.functions.moments import error_sums, metrics_from_sums

    df = staged_listing(spark, sf, SINGLES + [TARGET], fold=True)
    grams = search.fold_grams(df, SINGLES, TARGET)
    fits = []
    for name in SINGLES:
        for k in grams.folds:
            m = fit_linear(grams.train(k).select([name]))
            coef = [float(m.coef[0]) if c == name else 0.0 for c in SINGLES]
            fits.append((name, k, coef, m.intercept))
    sums = error_sums(df, SINGLES, TARGET, [(c, b) for _, _, c, b in fits], "fold")
    rows = []
    for j, (name, k, _, _) in enumerate(fits):
        for side, s in (("validation", sums[k][:, [j]]),
                        ("train", sum(v[:, [j]] for f, v in sums.items() if f != k))):
            values = metrics_from_sums(s)
            rows += [(f"on_{name}", int(k), side, m, float(values[m][0])) for m in search.METRICS]
    return spark.createDataFrame(rows, "model string, fold int, side string, metric string, value double")


def _cv_sql():
    fits = " UNION ALL ".join(
        f"SELECT 'on_{c}' AS model, f.fold, avg({c}) AS mx, avg({TARGET}) AS my, covar_pop({c}, {TARGET}) / var_pop({c}) AS b"
        f" FROM listing l JOIN (SELECT DISTINCT fold FROM listing) f ON l.fold <> f.fold GROUP BY 2"
        for c in SINGLES
    )
    xs = " ".join(f"WHEN 'on_{c}' THEN {c}" for c in SINGLES)
    return f"""fits AS ({fits}),
e AS (SELECT model, f.fold, CASE WHEN l.fold = f.fold THEN 'validation' ELSE 'train' END AS side, {TARGET} AS y,
        {TARGET} - (my + b * (CASE model {xs} END - mx)) AS err FROM listing l, fits f),
m AS (SELECT model, fold, side, avg(err * err) AS mse, avg(abs(err)) AS mae, 1 - sum(err * err) / (var_pop(y) * count(*)) AS r2,
        sqrt(avg(err * err)) AS rmse, avg(abs(err) / greatest(abs(y), 2.220446049250313e-16)) * 100 AS mape,
        1 - var_pop(err) / var_pop(y) AS explained_variance FROM e GROUP BY 1, 2, 3),
summary AS (SELECT model, side, {', '.join(f'avg({m}) AS {m}, stddev_pop({m}) AS {m}_std' for m in search.METRICS)},
        arg_max(fold, r2)::INTEGER AS best_fold, count(*) AS folds FROM m GROUP BY 1, 2)"""


_CV = _cv_sql()
# mse is of the order 1e8, so it is compared to whole units
_DIGITS = {"mse": 0, "mae": 4, "r2": 8, "rmse": 4, "mape": 6, "explained_variance": 8}


@query(with_listing(" UNION ALL ".join(
    f"SELECT model, fold, side, '{m}' AS metric, {q(m, d)} AS value FROM m" for m, d in _DIGITS.items()), _CV))
def cv_single_feature(spark, sf):
    cv = _single_cv(spark, sf)
    value = F.col("value")
    for m, d in _DIGITS.items():
        value = F.when(F.col("metric") == m, F.round("value", d)).otherwise(value)
    return cv.withColumn("value", value)


@query(with_listing("SELECT model, side, " + ", ".join(
    f"{q(m, d)} AS {m}, {q(m + '_std', d)} AS {m}_std" for m, d in _DIGITS.items()) + ", best_fold, folds FROM summary", _CV))
def cv_summary(spark, sf):
    out = search.summarise(_single_cv(spark, sf))
    return rounded(out, {**_DIGITS, **{f"{m}_std": d for m, d in _DIGITS.items()}})


_GRID = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]


def _grid_sql(alphas, extra_where=""):
    values = ", ".join(f"({i}::INTEGER, {a}::DOUBLE)" for i, a in enumerate(alphas))
    return _ONE + f""", grid(candidate, alpha) AS (VALUES {values}),
v AS (SELECT fold, count(*)::DOUBLE AS n, avg({X1}) AS mx, avg({TARGET}) AS my, var_pop({X1}) AS xx, covar_pop({X1}, {TARGET}) AS xy,
        var_pop({TARGET}) AS yy FROM listing GROUP BY 1),
sc AS (SELECT candidate, alpha, s.fold, v.yy - 2 * b * v.xy + b * b * v.xx + pow(v.my - s.my - b * (v.mx - s.mx), 2) AS mse,
        v.yy AS vyy FROM (SELECT *, s.n * rho / (s.n + alpha) / sx AS b FROM s, grid) s JOIN v ON s.fold = v.fold)"""


@query(with_listing(f"SELECT candidate, alpha, {q('avg(mse)', 0)} AS mse, {q('stddev_pop(mse)', 0)} AS mse_std FROM sc GROUP BY 1, 2",
                    _grid_sql(_GRID)))
def grid_search_ridge(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET], fold=True)
    frame, _ = search.grid_search(spark, search.fold_grams(df, [X1], TARGET), "ridge_regression")
    return rounded(frame.drop("model", "l1_ratio"), {"mse": 0, "mse_std": 0})


def _grid_all_sql():
    """Validation error of every candidate on all features; a model's name carries its parameters."""
    fits = []
    for m in MODELS:
        for i, p in enumerate(search.candidates(m)):
            alpha, share = p.get("alpha", 0.0), p.get("l1_ratio", 1.0)
            walked = m in ("lasso_regression", "elastic_net")
            name = f"{m}/{i}/{alpha if p else ''}/{p.get('l1_ratio', '')}"
            fits.append((name, 0 if walked else alpha, alpha * share if walked else 0.0, alpha * (1 - share) if walked else 0.0))
    ctes = [FILLED, TRAIN_SIDES, moments(NUMERIC, scaled=False), solved(fits, len(NUMERIC))]
    ctes.append(f"""tries AS (SELECT model, avg(mse) AS mse FROM (
  SELECT model, grp, avg(({TARGET} - ({prediction()})) ** 2) AS mse FROM filled JOIN coefs ON fold = grp GROUP BY ALL) GROUP BY model)""")
    part = lambda i: f"nullif(split_part(arg_min(model, mse), '/', {i}), '')::DOUBLE"
    body = f"""SELECT split_part(model, '/', 1) AS model, count(*) AS candidates, {q('min(mse)', 0)} AS best_mse,
  {part(3)} AS alpha, {part(4)} AS l1_ratio FROM tries GROUP BY split_part(model, '/', 1)"""
    return with_listing(body, ",\n".join(ctes), recursive=True)


@query(_grid_all_sql())
def grid_search_all(spark, sf):
    """Best candidate of each model's full grid on all eight features."""
    grams = search.fold_grams(complete(spark, sf), NUMERIC, TARGET)
    parts = [
        search.grid_search(spark, grams, m, convention="raw")[0] for m in MODELS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    best = out.groupBy("model").agg(
        F.count("*").alias("candidates"), F.min("mse").alias("best_mse"),
        F.min_by("alpha", "mse").alias("alpha"), F.min_by("l1_ratio", "mse").alias("l1_ratio"),
    )
    return rounded(best, {"best_mse": 0})


@query(with_listing(f"SELECT candidate, alpha, {q('mse', 0)} AS mse FROM sc WHERE fold = 0", _grid_sql([1.0, 0.001, 100.0])))
def reduced_search_ridge(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET], fold=True)
    grams = search.fold_grams(df, [X1], TARGET)
    frame, _ = search.reduced_search(spark, grams.train(0), grams.folds[0], "ridge_regression")
    return rounded(frame.drop("model"), {"mse": 0})


_SENS = [0.01, 1.0, 100.0, 10000.0]


@query(with_listing(f"SELECT alpha AS setting, {q('1 - mse / vyy', 8)} AS val_r2 FROM sc WHERE fold = 0", _grid_sql(_SENS)))
def sensitivity_ridge(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET], fold=True)
    grams = search.fold_grams(df, [X1], TARGET)
    frame = search.sensitivity(spark, grams.train(0), grams.folds[0], "ridge_regression", "alpha", _SENS)
    return rounded(frame.select("setting", "val_r2"), {"val_r2": 8})


@query(with_listing(f"""SELECT 4::BIGINT AS settings, {q('max(1 - mse / vyy) - min(1 - mse / vyy)', 8)} AS r2_range,
 {q('stddev_pop(1 - mse / vyy)', 8)} AS r2_std FROM sc WHERE fold = 0""", _grid_sql(_SENS)))
def sensitivity_ridge_spread(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET], fold=True)
    grams = search.fold_grams(df, [X1], TARGET)
    frame = search.sensitivity(spark, grams.train(0), grams.folds[0], "ridge_regression", "alpha", _SENS)
    return rounded(search.sensitivity_spread(frame).drop("model", "parameter"), 8)


@query()
def sensitivity_all(spark, sf):
    """Penalty, learning-rate and iteration sweeps of the iterative fits."""
    grams = search.fold_grams(complete(spark, sf), NUMERIC, TARGET)
    train, val = grams.train(0), grams.folds[0]
    sweeps = [
        ("linear_regression", "learning_rate", [0.001, 0.01, 0.1], {"method": "gradient"}),
        ("ridge_regression", "alpha", [0.01, 1.0, 100.0], {"method": "gradient"}),
        ("lasso_regression", "alpha", [1.0, 100.0, 1000.0], {}),
        ("elastic_net", "l1_ratio", [0.1, 0.5, 0.9], {}),
        ("linear_regression", "max_iter", [10, 100, 1000], {"method": "gradient"}),
    ]
    out = None
    for model, name, values, args in sweeps:
        part = search.sensitivity(spark, train, val, model, name, values, **args)
        out = part if out is None else out.unionByName(part)
    return rounded(out, {"train_r2": 6, "val_r2": 6})


_CURVE = f"""
cell AS (SELECT *, (('0x' || substr(md5(concat_ws('-', 'curve', row_key)), 1, 8))::BIGINT % 10)::INTEGER AS bucket FROM listing),
steps AS (SELECT f.fold, st.step, count(*) AS rows, avg({X1}) AS mx, avg({TARGET}) AS my, covar_pop({X1}, {TARGET}) / var_pop({X1}) AS b,
   var_pop({TARGET}) - covar_pop({X1}, {TARGET}) ** 2 / var_pop({X1}) AS train_mse
   FROM cell c JOIN (SELECT DISTINCT fold FROM listing) f ON c.fold <> f.fold
   JOIN (SELECT unnest(range(1, 11))::INTEGER AS step) st ON c.bucket < st.step GROUP BY 1, 2),
curve AS (SELECT s.fold, step, any_value(rows) AS rows, any_value(train_mse) AS train_mse,
   avg(({TARGET} - my - b * ({X1} - mx)) ** 2) AS val_mse FROM steps s JOIN listing l ON l.fold = s.fold GROUP BY 1, 2)"""


@query(with_listing(f"SELECT fold, step, rows, {q('train_mse', 0)} AS train_mse, {q('val_mse', 0)} AS val_mse FROM curve", _CURVE))
def learning_curve(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET, "row_key"], fold=True)
    return rounded(search.learning_curve(df, [X1], TARGET, "row_key").drop("model"), 0)


@query(with_listing(f"""SELECT step, {q('avg(rows)', 4)} AS mean_rows, {q('avg(train_mse)', 0)} AS train_mean, {q('stddev_pop(train_mse)', 0)} AS train_std,
  {q('avg(val_mse)', 0)} AS val_mean, {q('stddev_pop(val_mse)', 0)} AS val_std FROM curve GROUP BY 1""", _CURVE))
def learning_curve_bands(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET, "row_key"], fold=True)
    out = search.learning_curve_summary(search.learning_curve(df, [X1], TARGET, "row_key"))
    return rounded(out.drop("model"), {"mean_rows": 4, "train_mean": 0, "train_std": 0, "val_mean": 0, "val_std": 0})


def _conventions_sql():
    ctes, sides = [FILLED, TRAIN_SIDES], []
    for name, scaled in (("standardized", True), ("raw", False)):
        fits = moments(NUMERIC, scaled) + ",\n" + solved(_FOUR, len(NUMERIC))
        ctes.append(renamed(fits, f"_{name}"))
        metrics = renamed(side_metrics(dict.fromkeys(_CV_DIGITS, 12)), f"_{name}")
        ctes.append(f"""{name}_rows AS (SELECT model, metric, v AS {name} FROM (SELECT model, {", ".join(_CV_DIGITS)} FROM ({metrics}) WHERE side = 'validation')
  UNPIVOT (v FOR metric IN ({", ".join(_CV_DIGITS)})))""")
    value = lambda v: "CASE metric " + " ".join(f"WHEN '{m}' THEN {q(v, d)}" for m, d in _CV_DIGITS.items()) + " END"
    body = f"""SELECT model, metric, {value('standardized')} AS standardized, {value('raw')} AS raw, {value('standardized - raw')} AS gap
FROM standardized_rows JOIN raw_rows USING (model, metric)"""
    return with_listing(body, ",\n".join(ctes), recursive=True)


@query(_conventions_sql())
def compare_conventions(spark, sf):
    """The four models under both penalty conventions, with the metric gap."""
    df = complete(spark, sf)
    grams = search.fold_grams(df, NUMERIC, TARGET)
    one = search.cross_validate(df, NUMERIC, TARGET, grams=grams)
    two = search.cross_validate(df, NUMERIC, TARGET, grams=grams, convention="raw")
    out = search.compare_implementations(one, two)
    digits = F.expr("CASE metric " + " ".join(f"WHEN '{m}' THEN {d}" for m, d in _CV_DIGITS.items()) + " END")
    whole = {c: sum((F.when(digits == d, F.round(c, d)).otherwise(0.0) for d in sorted(set(_CV_DIGITS.values()))), F.lit(0.0)) for c in ("standardized", "raw", "gap")}
    return out.withColumns(whole)


@query()
def compare_with_spark_ml(spark, sf):
    """The four models through the Gram solvers and through the built-in library."""
    df = complete(spark, sf)
    gram = gram_by(df, NUMERIC, TARGET)[0]
    rows = []
    for model in MODELS:
        ours = fit_linear(gram, model, 0.5, convention="raw", tol=1e-9, relative_tol=True)
        theirs = fit_mllib(df, NUMERIC, TARGET, model, 0.5)
        a, b = ours.score(gram), theirs.score(gram)
        rows.append((model, a["r2"], b["r2"], a["r2"] - b["r2"], a["rmse"], b["rmse"]))
    frame = spark.createDataFrame(
        rows, "model string, gram_r2 double, ml_r2 double, r2_gap double, gram_rmse double, ml_rmse double"
    )
    return rounded(frame, {"gram_r2": 6, "ml_r2": 6, "r2_gap": 6, "gram_rmse": 2, "ml_rmse": 2})


# -- registry ---------------------------------------------------------------

_EPOCH = datetime(2024, 1, 1)


def saved_models(spark, sf):
    """One single-feature model per feature and fold, stamped by fold."""
    df = staged_listing(spark, sf, SINGLES + [TARGET], fold=True)
    grams = search.fold_grams(df, SINGLES, TARGET)
    rows = []
    for name in SINGLES:
        for k in grams.folds:
            g = grams.train(k).select([name])
            m = fit_linear(g)
            m.name = f"on_{name}"
            rows.append((m, int(k), m.score(g), _EPOCH + timedelta(days=int(k))))
    return registry.model_rows(spark, rows)


def _reg_sql(body):
    fits = " UNION ALL ".join(
        f"SELECT 'on_{c}' AS model, '{c}' AS feature, f.fold::INTEGER AS fold, covar_pop({c}, {TARGET}) / var_pop({c}) AS w,"
        f" avg({TARGET}) - covar_pop({c}, {TARGET}) / var_pop({c}) * avg({c}) AS intercept, corr({c}, {TARGET}) ** 2 AS r2"
        f" FROM listing l JOIN (SELECT DISTINCT fold FROM listing) f ON l.fold <> f.fold GROUP BY 3"
        for c in SINGLES
    )
    return with_listing(body, f"reg AS ({fits})")


@query(_reg_sql(f"""SELECT model, arg_max(fold, fold) AS fold, {q('arg_max(intercept, fold)', 3)} AS intercept, {q('arg_max(w, fold)', 6)} AS weight
FROM reg GROUP BY 1"""))
def registry_latest(spark, sf):
    """Write the models, read them back, take the newest of each name."""
    from gramlark.session import stage

    last = registry.latest(stage(saved_models(spark, sf), "registry"))
    out = last.select("model", "fold", "intercept", F.col("coefficients")[0].alias("weight"))
    return rounded(out, {"intercept": 3, "weight": 6})


@query(_reg_sql(f"SELECT model, fold, {q('r2', 8)} AS r2 FROM reg WHERE fold = 3"))
def registry_at_time(spark, sf):
    models = saved_models(spark, sf)
    hits = models.where(F.col("ts") == F.lit(_EPOCH + timedelta(days=3)))
    return rounded(registry.listing_by_age(hits).select("model", "fold", "r2"), 8)


@query(_reg_sql(f"SELECT model, fold, 0::INTEGER AS position, feature, {q('w', 6)} AS weight FROM reg"))
def registry_weights(spark, sf):
    rows = registry.coefficient_rows(saved_models(spark, sf), ["model", "fold"])
    return rounded(registry.first_and_last(rows, by=["model", "fold"]), 6)


@query(_reg_sql(f"""SELECT model, count(*) AS n, {q('min(w)', 6)} AS min, {q('max(w)', 6)} AS max, {q('avg(w)', 6)} AS mean, {q('stddev_pop(w)', 6)} AS std,
  {q('sqrt(sum(w * w))', 6)} AS l2_norm, {q('quantile_cont(w, 0.25)', 6)} AS q1, {q('quantile_cont(w, 0.5)', 6)} AS q2, {q('quantile_cont(w, 0.75)', 6)} AS q3,
  count(*) FILTER (abs(w) < 1e-10) AS zeros, {q('avg(CASE WHEN abs(w) < 1e-10 THEN 100.0::DOUBLE ELSE 0 END)', 4)} AS zero_percent,
  count(*) FILTER (abs(w) < 1e-3) AS small, {q('avg(CASE WHEN abs(w) < 1e-3 THEN 100.0::DOUBLE ELSE 0 END)', 4)} AS small_percent
FROM reg GROUP BY 1"""))
def registry_weight_stats(spark, sf):
    rows = registry.coefficient_rows(saved_models(spark, sf), ["model", "fold"])
    out = registry.coefficient_stats(rows)
    digits = {c: 6 for c in ("min", "max", "mean", "std", "l2_norm", "q1", "q2", "q3")}
    return rounded(out, {**digits, "zero_percent": 4, "small_percent": 4})


@query(_gd_sql(0.0, "0.1::DOUBLE").replace(
    "SELECT epoch::INTEGER AS epoch,", "SELECT count(*) AS epochs,").replace(
    "(round(yy - 2 * b", "(round(arg_max(yy - 2 * b").replace("/ (2 * n), 0)", "/ (2 * n), epoch), 0)").replace(
    "(round(yy - 2 * nb * rho + nb * nb, 0)", "(round(arg_max(yy - 2 * nb * rho + nb * nb, epoch), 0)").replace(
    "AS loss,", "AS final_loss,").replace("AS val_loss FROM", "AS final_val_loss FROM"))
def training_final_losses(spark, sf):
    df = staged_listing(spark, sf, [X1, TARGET])
    gram = gram_by(df, [X1], TARGET)[0]
    m = fit_linear(gram, method="gradient", learning_rate=0.1, max_iter=EPOCHS, val=gram)
    return rounded(registry.final_losses(m.history_frame(spark)).drop("model"), 0)


@query(with_listing(f"""SELECT f.fold, count(*)::DOUBLE AS train_rows, {q(f'avg({TARGET})', 4)} AS train_mean
FROM listing l JOIN (SELECT DISTINCT fold FROM listing) f ON l.fold <> f.fold GROUP BY 1"""))
def fold_all_total(spark, sf):
    """Training side by subtraction equals a direct sum of the other folds."""
    grams = gram_by(complete(spark, sf), NUMERIC, TARGET, "fold")
    whole = total(grams)
    rows = [(int(k), float((whole - g).n), float((whole - g).mean[-1])) for k, g in grams.items()]
    return rounded(spark.createDataFrame(rows, "fold int, train_rows double, train_mean double"), 4)
