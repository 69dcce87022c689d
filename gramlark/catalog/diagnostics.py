"""Residual tests, principal components, power transforms and the surrogate search."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import long_cte, q, query, rounded, staged_listing
from gramlark.catalog.fits_sql import ALL_ROWS, FILLED, moments, prediction, solved
from gramlark.catalog.models import complete
from gramlark.functions.moments import gram_by
from gramlark.functions.tails import normal_quantile
from gramlark.operators import power, principal, residuals
from gramlark.operators.linear import fit_linear
from gramlark.plans import search
from gramlark.plans.surrogate import surrogate_search
from gramlark.schema import NUMERIC, TARGET
from gramlark.sources.listing import with_listing

# -- residuals of least squares on all eight features ---------------------------

_OLS = ",\n".join([
    FILLED, ALL_ROWS, moments(NUMERIC), solved([("linear_regression", 0, 0.0, 0.0)], len(NUMERIC)),
    f"res AS (SELECT filled.*, {TARGET} - ({prediction()}) AS e FROM filled CROSS JOIN coefs)",
])
LAGS = 5


def _residuals(spark, sf):
    df = complete(spark, sf)
    gram = gram_by(df, NUMERIC, TARGET)[0]
    model = fit_linear(gram)
    return df.withColumn("residual", F.col(TARGET) - model.predict()), model, gram


@query(with_listing(f"""
SELECT count(*) AS n, {q('sum((e - p) * (e - p)) / sum(e * e)', 6)} AS durbin_watson
FROM (SELECT e, lag(e) OVER (ORDER BY row_key) AS p FROM res)""", _OLS, recursive=True))
def residual_durbin_watson(spark, sf):
    return rounded(residuals.durbin_watson(_residuals(spark, sf)[0], ["row_key"], "residual"), 6)


_LAGGED = ", ".join(f"lag(d, {k}) OVER (ORDER BY row_key) AS d{k}" for k in range(1, LAGS + 1))
_BY_LAG = " UNION ALL ".join(
    f"SELECT {k} AS lag, count(d{k}) AS pairs, sum(d * d{k}) / sum(d * d) AS r, count(*) AS n FROM lagged" for k in range(1, LAGS + 1)
)


@query(with_listing(f"""
SELECT lag, pairs, {q('r', 6)} AS autocorrelation,
       {q('sum(n * (n + 2.0) * r * r / pairs) OVER (ORDER BY lag)', 4)} AS ljung_box
FROM ({_BY_LAG})""", _OLS + f""",
lagged AS (SELECT d, {_LAGGED} FROM (SELECT row_key, e - avg(e) OVER () AS d FROM res))""", recursive=True))
def residual_autocorrelation(spark, sf):
    out = residuals.autocorrelation(_residuals(spark, sf)[0], ["row_key"], "residual", LAGS)
    return rounded(out.drop("p_value"), {"autocorrelation": 6, "ljung_box": 4})


_PER_ROW = moments(NUMERIC).replace(TARGET, "e2").replace("cov AS", "cov2 AS").replace("FROM cov)", "FROM cov2)")


@query(with_listing(f"""
SELECT statistic, {q('value', 4)} AS value, {len(NUMERIC)}::INTEGER AS freedom FROM (
  SELECT 'classic' AS statistic, explained * n / (2 * s * s) AS value FROM parts
  UNION ALL SELECT 'studentized', n * explained / total FROM parts)""", _OLS + f""",
two AS (SELECT 0 AS grp, *, e * e AS e2 FROM res),
{_PER_ROW.replace("mom AS", "mom2 AS").replace("FROM sides", "FROM two")},
gj2 AS (
  SELECT 1 AS k, list_transform(g, lambda r, i: list_append(r, c[i])) AS a FROM mom2
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / r[k])
    ELSE list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]) END) FROM gj2 WHERE k <= {len(NUMERIC)}),
parts AS (SELECT n, my AS s, yy AS total, list_dot_product(c, list_transform(a, lambda r: r[{len(NUMERIC) + 1}])) AS explained
  FROM mom2, gj2 WHERE k = {len(NUMERIC) + 1})""", recursive=True))
def residual_breusch_pagan(spark, sf):
    df, model, gram = _residuals(spark, sf)
    return rounded(residuals.breusch_pagan(df, model, gram, TARGET).drop("p_value"), {"value": 4})


@query(with_listing(f"""
SELECT count(*) AS n, {q('corr(d, m) * corr(d, m)', 6)} AS w FROM (
  SELECT d, {normal_quantile('p')} AS m FROM (
    SELECT d, (rank() OVER (ORDER BY d) + (count(*) OVER (PARTITION BY d) - 1) / 2.0::DOUBLE - 0.375::DOUBLE) / (count(*) OVER () + 0.25::DOUBLE) AS p
    FROM (SELECT {TARGET} - avg({TARGET}) OVER () AS d FROM listing)))"""))
def target_ordered_scores(spark, sf):
    """How close the target is to a normal distribution."""
    out = residuals.ordered_scores(staged_listing(spark, sf, [TARGET]), TARGET)
    return rounded(out.drop("z", "p_value"), {"w": 6})


# -- principal components ---------------------------------------------------------

KEPT = 2


def _components_sql():
    """Power iteration on the correlations, and again after taking the first direction out."""
    turn = "list_transform(a, lambda r: list_dot_product(r, v))"
    ctes, size = [FILLED, ALL_ROWS, moments(NUMERIC), "m1 AS (SELECT g AS a FROM mom)"], len(NUMERIC)
    start = "[" + ", ".join(f"{1 + i / 10}::DOUBLE" for i in range(size)) + "]"
    for k in range(1, KEPT + 1):
        ctes.append(f"""it{k} AS (
  SELECT 0 AS i, {start} AS v
  UNION ALL
  SELECT i + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) FROM (SELECT i, {turn} AS w FROM it{k}, m{k}) WHERE i < 1000)""")
        ctes.append(f"""pc{k} AS (SELECT variance, list_transform(v, lambda x: x * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END) AS v
  FROM (SELECT v, list_dot_product(v, {turn}) AS variance FROM it{k}, m{k} WHERE i = 1000))""")
        ctes.append(f"""m{k + 1} AS (SELECT list_transform(a, lambda r, i: list_transform(r, lambda x, j: x - variance * v[i] * v[j])) AS a
  FROM m{k}, pc{k})""")
    return ",\n".join(ctes)


_NAMES = "[" + ", ".join(f"'{c}'" for c in NUMERIC) + "]"


@query(with_listing(" UNION ALL ".join(
    f"""SELECT {k} AS component, {q('variance', 6)} AS variance, {q(f'variance / {len(NUMERIC)}', 6)} AS share,
  unnest({_NAMES}) AS "column", unnest(list_transform(v, lambda x: round(x, 5) + 0.0)) AS loading FROM pc{k}"""
    for k in range(1, KEPT + 1)), _components_sql(), recursive=True))
def principal_directions(spark, sf):
    found = principal.principal_components(complete(spark, sf), NUMERIC)
    return rounded(found.rows(spark, KEPT), {"variance": 6, "share": 6, "loading": 5})


_SCORE = " + ".join(f"({c} - mx[{i}]) / sd[{i}] * {{v}}[{i}]" for i, c in enumerate(NUMERIC, 1))


@query(with_listing("SELECT row_key, " + ", ".join(
    f"round(({_SCORE.format(v=f'pc{k}.v')}) / sqrt(pc{k}.variance), 4) + 0.0 AS score_{k}" for k in range(1, KEPT + 1))
    + " FROM filled, mom, " + ", ".join(f"pc{k}" for k in range(1, KEPT + 1)), _components_sql(), recursive=True))
def principal_scores(spark, sf):
    """Every row's place along the two strongest directions, in units of their deviation."""
    df = complete(spark, sf)
    found = principal.principal_components(df, NUMERIC)
    scores = [found.score(k, whitened=True).alias(f"score_{k + 1}") for k in range(KEPT)]
    return rounded(df.select("row_key", *scores), 4)


# -- power transforms ---------------------------------------------------------------

POSITIVE = ["housing_median_age", "total_rooms", "population", "households", "median_income", TARGET]


@query(with_listing(f"""
SELECT "column", arg_max(l, f) AS exponent, {q('max(f)', 6)} AS score FROM (
  SELECT "column", l, -0.5 * ln(var_pop(CASE WHEN l = 0 THEN z ELSE exp(z * l) / l END)) AS f
  FROM rel, (SELECT i / 100.0::DOUBLE AS l FROM range(-200, 301) t(i)) GROUP BY ALL) GROUP BY "column" """,
    long_cte(POSITIVE) + """, rel AS (SELECT "column", ln(v) - avg(ln(v)) OVER (PARTITION BY "column") AS z FROM long)"""))
def power_exponents(spark, sf):
    """The Box-Cox exponent of every positive column."""
    df = staged_listing(spark, sf, POSITIVE)
    return rounded(power.fit_box_cox(df, POSITIVE).rows(spark), {"score": 6})


# -- search ---------------------------------------------------------------------------


@query()
def surrogate_search_elastic_net(spark, sf):
    """Tries of the surrogate search for the elastic net on all eight features."""
    grams = search.fold_grams(complete(spark, sf), NUMERIC, TARGET)
    return rounded(surrogate_search(spark, grams, "elastic_net")[0], {"alpha": 9, "l1_ratio": 4, "mse": 1, "mse_std": 1})
