"""Chart-data queries."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from gramlark.catalog.base import long_cte, q, query, rounded, staged_listing
from gramlark.catalog.models import _pred, out_of_fold
from gramlark.operators.derive import ratio_features
from gramlark.operators.impute import handle_missing
from gramlark.operators.outliers import clip_outliers, iqr_bounds
from gramlark.plans import plotdata
from gramlark.schema import CATEGORY, NUMERIC, TARGET
from gramlark.sources.listing import listing, with_listing

ALL_NUMERIC = NUMERIC + [TARGET]


def _bin(v, lo, hi, bins):
    return f"greatest(least(floor(({v} - {lo}) / (({hi} - {lo}) / {bins})), {bins - 1}), 0)::INTEGER"


def _hist_sql(columns, bins):
    return with_listing(f"""
SELECT "column", bin, {q('lo + bin * w', 6)} AS left, {q('lo + (bin + 1) * w', 6)} AS right, count,
       {q('count / (sum(count) OVER (PARTITION BY "column") * w)', 12)} AS density
FROM (SELECT "column", {_bin('v', 'lo', 'hi', bins)} AS bin, any_value(lo) AS lo, any_value((hi - lo) / {bins}) AS w, count(*) AS count
      FROM long JOIN rng USING ("column") GROUP BY 1, 2)""",
        long_cte(columns) + ', rng AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM long GROUP BY 1)')


_HIST = {"left": 6, "right": 6, "density": 12}


@query(_hist_sql(NUMERIC, 30))
def histogram_features(spark, sf):
    return rounded(plotdata.histogram(staged_listing(spark, sf, NUMERIC), NUMERIC), _HIST)


@query(_hist_sql([TARGET], 50))
def histogram_target(spark, sf):
    return rounded(plotdata.histogram(staged_listing(spark, sf, [TARGET]), [TARGET], 50), _HIST)


@query(with_listing(f"""
SELECT {q('x', 4)} AS x, {q('sum(c * exp(-0.5 * ((x - center) / h) * ((x - center) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 12)} AS density
FROM bins, (SELECT lo - 3 * h + i * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x FROM st, range(200) t(i)) GROUP BY x""", f"""
st AS (SELECT count({TARGET}) AS n, stddev_samp({TARGET}) * pow(count({TARGET}), -0.2::DOUBLE) AS h, min({TARGET}) AS lo, max({TARGET}) AS hi FROM listing),
bins AS (SELECT lo + ({_bin(TARGET, 'lo', 'hi', 2048)} + 0.5) * ((hi - lo) / 2048) AS center, count(*) AS c, any_value(h) AS h, any_value(n) AS n
         FROM listing, st GROUP BY 1)"""))
def density_target(spark, sf):
    return rounded(plotdata.kde(staged_listing(spark, sf, [TARGET]), TARGET), {"x": 4, "density": 12})


@query(with_listing(f"""
SELECT "column", {q('any_value(q1)', 6)} AS q1, {q('any_value(m)', 6)} AS median, {q('any_value(q3)', 6)} AS q3,
  {q('min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))', 6)} AS whisker_low,
  {q('max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))', 6)} AS whisker_high,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS fliers
FROM long JOIN b USING ("column") GROUP BY 1""", long_cte(ALL_NUMERIC) + """,
b AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS m, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1)"""))
def box_plot(spark, sf):
    return rounded(plotdata.box_stats(staged_listing(spark, sf, ALL_NUMERIC), ALL_NUMERIC), 6)


_PROBS = [(i + 0.5) / 20 for i in range(20)]


@query(with_listing("SELECT prob, " + q("theoretical", 8) + " AS theoretical, " + q("ordered", 6) + " AS ordered FROM ("
    + " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS prob, {NormalDist().inv_cdf(p)!r}::DOUBLE AS theoretical, quantile_cont({TARGET}, {p}) AS ordered FROM listing"
        for p in _PROBS) + ")"))
def qq_plot(spark, sf):
    out = plotdata.qq_points(staged_listing(spark, sf, [TARGET]), TARGET, 20)
    return rounded(out, {"theoretical": 8, "ordered": 6})


_TRI = [(a, b) for i, a in enumerate(ALL_NUMERIC) for b in ALL_NUMERIC[:i]]


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q(f'corr({a}, {b})', 8)} AS correlation FROM listing" for a, b in _TRI)))
def correlation_lower_triangle(spark, sf):
    return rounded(plotdata.correlation_triangle(staged_listing(spark, sf, ALL_NUMERIC)), 8)


_RANKED = f"""
st AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, abs(corr({c}, {TARGET})) AS r FROM listing" for c in NUMERIC)}),
pos AS (SELECT c, row_number() OVER (ORDER BY r DESC) AS p FROM st UNION ALL SELECT '{TARGET}', 99),
allc AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM listing" for a in ALL_NUMERIC for b in ALL_NUMERIC if a != b)})"""


@query(with_listing(f"""SELECT a AS column_a, b AS column_b, {q('r', 8)} AS correlation FROM allc
JOIN pos pa ON a = pa.c JOIN pos pb ON b = pb.c
WHERE pa.p > pb.p AND (pa.p <= 4 OR pa.p = 99) AND pb.p <= 4""", _RANKED))
def correlation_top_block(spark, sf):
    return rounded(plotdata.top_correlation_block(staged_listing(spark, sf, ALL_NUMERIC), n=4), 8)


_STRENGTH = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", abs(corr({c}, {TARGET})) AS r, regr_slope({TARGET}, {c}) AS s, regr_intercept({TARGET}, {c}) AS i FROM listing"
    for c in NUMERIC
)


@query(with_listing(f"""SELECT (row_number() OVER (ORDER BY r DESC))::INTEGER AS rank, "column", {q('r', 8)} AS strength FROM ({_STRENGTH})"""))
def feature_importance(spark, sf):
    return rounded(plotdata.top_features(staged_listing(spark, sf, ALL_NUMERIC)), 8)


@query(with_listing(f"""SELECT "column", {q('s', 4)} AS slope, {q('i', 2)} AS intercept, {q('r', 8)} AS strength
FROM ({_STRENGTH}) ORDER BY r DESC LIMIT 6"""))
def feature_regression_lines(spark, sf):
    out = plotdata.regression_lines(staged_listing(spark, sf, ALL_NUMERIC))
    return rounded(out, {"slope": 4, "intercept": 2, "strength": 8})


_MAP = ["total_rooms", "total_bedrooms", "median_income"]


@query(with_listing(" UNION ALL ".join(
    f"""SELECT (('0x' || substr(md5(row_key), 1, 8))::BIGINT % 50)::INTEGER AS bucket, '{c}' AS "column",
  {q(f'avg(({c} IS NULL)::INTEGER)', 8)} AS missing_share FROM listing GROUP BY 1""" for c in _MAP)))
def missing_heat_map(spark, sf):
    return rounded(plotdata.missing_map(listing(spark, sf, ["row_key", *_MAP]), "row_key"), 8)


@query(with_listing(f"""SELECT floor(latitude / 0.5)::INTEGER AS lat_cell, floor(longitude / 0.5)::INTEGER AS lon_cell,
  count(*) AS rows, {q(f'sum({TARGET})', 3)} AS total_value FROM listing GROUP BY 1, 2"""))
def geo_value_grid(spark, sf):
    grid = plotdata.geo_grid(listing(spark, sf, ["latitude", "longitude", TARGET]))
    total = F.round(F.col("rows") * F.col("mean_value"), 3).alias("total_value")
    return grid.select("lat_cell", "lon_cell", "rows", total)


def _pairs_sql(x, y):
    return with_listing(
        f"""SELECT {_bin('x', 'xl', 'xh', 40)} AS x_bin, {_bin('y', 'yl', 'yh', 40)} AS y_bin, count(*) AS count,
  {q('sum(x)', 3)} AS x_total, {q('sum(y)', 3)} AS y_total FROM pr, lim GROUP BY 1, 2""",
        _pred() + f""", pr AS (SELECT {x} AS x, {y} AS y FROM p),
lim AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM pr)""",
    )


def _totals(pairs):
    """Bin means as totals, which do not sit on rounding ties."""
    total = lambda c: F.round(F.col(f"{c}_mean") * F.col("count"), 3).alias(f"{c}_total")
    return pairs.select("x_bin", "y_bin", "count", total("x"), total("y"))


@query(with_listing(f"""SELECT {_bin('x', 'xl', 'xh', 40)} AS x_bin, {_bin('y', 'yl', 'yh', 40)} AS y_bin, count(*) AS count,
  {q('sum(x)', 3)} AS x_total, {q('sum(y)', 3)} AS y_total FROM pr, lim GROUP BY 1, 2""", f"""
pr AS (SELECT median_income AS x, {TARGET} AS y FROM listing), lim AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM pr)"""))
def income_value_pairs(spark, sf):
    df = staged_listing(spark, sf, ["median_income", TARGET])
    return _totals(plotdata.binned_pairs(df, F.col("median_income"), F.col(TARGET)))


@query(_pairs_sql("y", "yhat"))
def predicted_actual_pairs(spark, sf):
    return _totals(plotdata.binned_pairs(out_of_fold(spark, sf), F.col("y"), F.col("yhat")))


@query(_pairs_sql("yhat", "y - yhat"))
def residual_pairs(spark, sf):
    df = out_of_fold(spark, sf)
    return _totals(plotdata.binned_pairs(df, F.col("yhat"), F.col("y") - F.col("yhat")))


@query(with_listing(f"""
SELECT {_bin('e', 'lo', 'hi', 30)} AS bin, count(*) AS count FROM er, (SELECT min(e) AS lo, max(e) AS hi FROM er) GROUP BY 1""",
    _pred() + ", er AS (SELECT y - yhat AS e FROM p)"))
def residual_histogram(spark, sf):
    df = out_of_fold(spark, sf).select((F.col("y") - F.col("yhat")).alias("e"))
    return plotdata.histogram(df, ["e"], 30).select("bin", "count")


_CLIP = """
b AS (SELECT quantile_cont(population, 0.25) AS q1, quantile_cont(population, 0.75) AS q3 FROM listing),
aft AS (SELECT greatest(q1 - 0.45::DOUBLE * (q3 - q1), least(q3 + 0.45::DOUBLE * (q3 - q1), population)) AS v FROM listing, b),
bef AS (SELECT population AS v FROM listing),
rng AS (SELECT min(v) AS lo, max(v) AS hi FROM bef)"""


@query(with_listing(f"""
SELECT 'before' AS version, 'population' AS "column", {_bin('v', 'lo', 'hi', 30)} AS bin, count(*) AS count FROM bef, rng GROUP BY 3
UNION ALL SELECT 'after', 'population', {_bin('v', 'lo', 'hi', 30)} AS bin, count(*) FROM aft, rng GROUP BY 3""", _CLIP))
def histogram_before_after(spark, sf):
    before = staged_listing(spark, sf, ["population"])
    after = clip_outliers(before, iqr_bounds(before, ["population"], 0.45))
    out = plotdata.before_after_histogram(before, after, ["population"])
    return out.select("version", "column", "bin", "count")


_AFTER = f"""aft AS (SELECT * REPLACE (coalesce(total_bedrooms, (SELECT median(total_bedrooms) FROM listing)) AS total_bedrooms) FROM listing),
rat AS (SELECT *, total_rooms / households AS rooms_per_household, total_bedrooms / total_rooms AS bedrooms_per_room,
  population / households AS population_per_household, median_income / (population / households) AS income_per_person,
  median_income / (total_rooms / households) AS income_to_rooms_ratio FROM aft)"""
_AFTER_COLS = NUMERIC + ["rooms_per_household", "bedrooms_per_room", "population_per_household",
                         "income_per_person", "income_to_rooms_ratio"]


def _top_sql(version, source, columns):
    inner = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", abs(corr({c}, {TARGET})) AS r FROM {source}" for c in columns
    )
    return (
        f"SELECT '{version}' AS version, (row_number() OVER (ORDER BY r DESC))::INTEGER AS rank, \"column\","
        f" {q('r', 8)} AS strength FROM ({inner}) QUALIFY row_number() OVER (ORDER BY r DESC) <= 5"
    )


@query(with_listing(f"({_top_sql('before', 'listing', NUMERIC)}) UNION ALL ({_top_sql('after', 'rat', _AFTER_COLS)})", _AFTER))
def importance_before_after(spark, sf):
    before = staged_listing(spark, sf, NUMERIC + [TARGET])
    after = ratio_features(handle_missing(before, "median", indicators=False))
    return rounded(plotdata.before_after_importance(before, after, n=5), 8)


@query(with_listing("SELECT \"column\", " + q("median(v)", 6) + " AS median FROM long GROUP BY 1", long_cte(ALL_NUMERIC)))
def column_medians(spark, sf):
    return rounded(plotdata.medians(staged_listing(spark, sf, ALL_NUMERIC), ALL_NUMERIC), 6)


@query(with_listing(f"""
SELECT 'rows' AS key, count(*)::DOUBLE AS value FROM listing
UNION ALL SELECT 'missing', count(*) FILTER (total_bedrooms IS NULL) FROM listing
UNION ALL SELECT 'target_mean', {q(f'avg({TARGET})', 4)} FROM listing
UNION ALL SELECT 'target_std', {q(f'stddev_samp({TARGET})', 4)} FROM listing
UNION ALL SELECT 'target_min', {q(f'min({TARGET})', 4)} FROM listing
UNION ALL SELECT 'target_max', {q(f'max({TARGET})', 4)} FROM listing
UNION ALL SELECT 'categories', count(DISTINCT {CATEGORY}) FROM listing"""))
def dashboard_numbers(spark, sf):
    df = listing(spark, sf, ["total_bedrooms", TARGET, CATEGORY])
    y = F.col(TARGET)
    one = df.agg(
        F.count("*").cast("double").alias("rows"),
        F.count_if(F.col("total_bedrooms").isNull()).cast("double").alias("missing"),
        F.round(F.avg(y), 4).alias("target_mean"), F.round(F.stddev_samp(y), 4).alias("target_std"),
        F.round(F.min(y), 4).alias("target_min"), F.round(F.max(y), 4).alias("target_max"),
        F.count_distinct(CATEGORY).cast("double").alias("categories"),
    )
    return one.unpivot([], one.columns, "key", "value")
