"""Imputation, outlier, derivation, encoding, scaling and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import lean_listing, long_cte, q, query, rounded, staged_listing
from gramlark.catalog.fits_sql import ALL_ROWS, FILLED, eliminated, moments
from gramlark.functions.moments import gram_by
from gramlark.operators import cluster, derive, encode, outliers, scale, select
from gramlark.operators.impute import Imputer, handle_missing
from gramlark.plans.feature_flow import FeatureFlow
from gramlark.plans.plotdata import display_sample
from gramlark.schema import CATEGORY, NUMERIC, TARGET
from gramlark.sources.listing import listing, with_listing

NUM_LIST = ", ".join(NUMERIC)
KEYED = ["row_key"] + NUMERIC

# -- missing values ---------------------------------------------------------


@query(with_listing("""
SELECT row_key, total_bedrooms, (total_bedrooms IS NULL)::INTEGER AS total_bedrooms_is_missing FROM listing"""))
def missing_indicator(spark, sf):
    from gramlark.operators.impute import add_indicators, columns_with_nulls

    df = staged_listing(spark, sf, ["row_key", "total_bedrooms"])
    return add_indicators(df, columns_with_nulls(df, ["total_bedrooms"]))


def _impute(spark, sf, strategy):
    df = staged_listing(spark, sf, ["row_key", "total_bedrooms", CATEGORY])
    return rounded(handle_missing(df, strategy), 6)


def _impute_sql(fill):
    return with_listing(
        f"SELECT row_key, {q(f'coalesce(total_bedrooms, {fill})', 6)} AS total_bedrooms, ocean_proximity,"
        f" (total_bedrooms IS NULL)::INTEGER AS total_bedrooms_is_missing FROM listing"
    )


@query(_impute_sql("(SELECT avg(total_bedrooms) FROM listing)"))
def impute_mean(spark, sf):
    return _impute(spark, sf, "mean")


@query(_impute_sql("(SELECT median(total_bedrooms) FROM listing)"))
def impute_median(spark, sf):
    return _impute(spark, sf, "median")


@query(with_listing(f"""
SELECT row_key, {q('coalesce(total_bedrooms, m.fill, (SELECT median(total_bedrooms) FROM listing))', 6)} AS total_bedrooms,
       l.ocean_proximity, (total_bedrooms IS NULL)::INTEGER AS total_bedrooms_is_missing
FROM listing l LEFT JOIN (SELECT ocean_proximity AS g, median(total_bedrooms) AS fill FROM listing
                          WHERE ocean_proximity IS NOT NULL GROUP BY 1) m ON l.ocean_proximity = m.g"""))
def impute_grouped_median(spark, sf):
    return _impute(spark, sf, "grouped_median")


@query(with_listing(f"""
SELECT row_key, {q('median(total_rooms) OVER (PARTITION BY ocean_proximity)', 6)} AS group_median FROM listing"""))
def group_median_on_rows(spark, sf):
    from gramlark.functions.expressions import attach
    from gramlark.operators.impute import group_medians

    df = staged_listing(spark, sf, ["row_key", "total_rooms", CATEGORY])
    table = group_medians(df, ["total_rooms"], CATEGORY)
    return rounded(
        attach(df, table, CATEGORY).select("row_key", F.col("total_rooms_fill").alias("group_median")), 6
    )


@query()
def impute_knn(spark, sf):
    df = lean_listing(spark, sf, KEYED)
    filled = Imputer("knn").fit(df, NUMERIC).transform(df)
    return rounded(filled.select("row_key", "total_bedrooms", "total_bedrooms_is_missing"), 6)


# -- outliers ---------------------------------------------------------------

_IQR = """
b AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1),
lim AS (SELECT "column", q1 - t * (q3 - q1) AS lo, q3 + t * (q3 - q1) AS hi FROM b, (SELECT {t}::DOUBLE AS t))"""


def _lim(c, side):
    return f"(SELECT {side} FROM lim WHERE \"column\" = '{c}')"


# a narrow fence, so that the evenly spread columns have outliers too
_T = 0.45


@query(with_listing(f"""
SELECT "column", count(*) FILTER (v < lo OR v > hi) AS outliers,
       {q('count(*) FILTER (v < lo OR v > hi) * 100.0::DOUBLE / (SELECT count(*) FROM listing)', 8)} AS percent,
       {q('any_value(lo)', 6)} AS lower, {q('any_value(hi)', 6)} AS upper
FROM long JOIN lim USING ("column") GROUP BY 1""", long_cte() + "," + _IQR.format(t=_T)))
def outliers_iqr(spark, sf):
    df = staged_listing(spark, sf, NUMERIC)
    report = outliers.outlier_report(df, outliers.iqr_bounds(df, NUMERIC, _T))
    return rounded(report, {"percent": 8, "lower": 6, "upper": 6})


@query(with_listing("SELECT row_key, " + ", ".join(
    q(f"CASE WHEN {c} < {_lim(c, 'lo')} THEN {_lim(c, 'lo')} WHEN {c} > {_lim(c, 'hi')} THEN {_lim(c, 'hi')} ELSE {c} END", 6)
    + f" AS {c}" for c in NUMERIC) + " FROM listing", long_cte() + "," + _IQR.format(t=_T)))
def outliers_iqr_clip(spark, sf):
    df = staged_listing(spark, sf, KEYED)
    return rounded(outliers.handle_outliers(df, "iqr", "clip", _T, NUMERIC), 6)


@query(with_listing("SELECT row_key, " + ", ".join(
    f"coalesce({c} < {_lim(c, 'lo')} OR {c} > {_lim(c, 'hi')}, false)::INTEGER AS {c}_is_outlier" for c in NUMERIC)
    + " FROM listing", long_cte() + "," + _IQR.format(t=_T)))
def outliers_iqr_mark(spark, sf):
    df = staged_listing(spark, sf, KEYED)
    marked = outliers.handle_outliers(df, "iqr", "mark", _T, NUMERIC)
    return marked.select("row_key", *[f"{c}_is_outlier" for c in NUMERIC])


def _remove_sql():
    parts, source = [], "listing"
    for i, c in enumerate(NUMERIC):
        parts.append(
            f"r{i} AS (SELECT s.* FROM {source} s, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3"
            f" FROM {source}) b WHERE coalesce({c} >= q1 - {_T}::DOUBLE * (q3 - q1) AND {c} <= q3 + {_T}::DOUBLE * (q3 - q1), true))"
        )
        source = f"r{i}"
    return with_listing(f"SELECT row_key FROM {source}", ",\n".join(parts))


@query(_remove_sql())
def outliers_iqr_remove(spark, sf):
    df = staged_listing(spark, sf, KEYED)
    return outliers.handle_outliers(df, "iqr", "remove", _T, NUMERIC).select("row_key")


_Z = """z AS (SELECT "column", avg(v) AS m, stddev_pop(v) AS p, stddev_samp(v) AS s FROM long GROUP BY 1)"""


def _zs(c, what):
    return f"(SELECT {what} FROM z WHERE \"column\" = '{c}')"


@query(with_listing("SELECT \"column\", count(*) FILTER (abs((v - m) / p) > 1.5) AS outliers FROM long JOIN z USING (\"column\") GROUP BY 1",
                    long_cte() + "," + _Z))
def outliers_zscore(spark, sf):
    df = staged_listing(spark, sf, NUMERIC)
    return outliers.outlier_report(df, outliers.zscore_bounds(df, NUMERIC)).select("column", "outliers")


@query(with_listing("SELECT row_key, " + ", ".join(
    q(f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest({_zs(c, 'm - 1.5 * s')}, least({_zs(c, 'm + 1.5 * s')}, {c})) END", 6)
    + f" AS {c}" for c in NUMERIC) + " FROM listing", long_cte() + "," + _Z))
def outliers_zscore_clip(spark, sf):
    df = staged_listing(spark, sf, KEYED)
    return rounded(outliers.handle_outliers(df, "zscore", "clip", 1.5, NUMERIC), 6)


@query()
def outliers_isolation_forest(spark, sf):
    """Rows and marked rows of every numeric column but the target."""
    df = staged_listing(spark, sf, KEYED)
    marked = outliers.handle_outliers(df, "isolation_forest", "mark", columns=NUMERIC)
    flags = [c for c in marked.columns if c.endswith("_is_outlier")]
    return marked.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in flags])


# -- derived features -------------------------------------------------------

_DERIVED = {
    "rooms_per_household": "total_rooms / nullif(households, 0)",
    "bedrooms_per_room": "total_bedrooms / nullif(total_rooms, 0)",
    "population_per_household": "population / nullif(households, 0)",
    "income_per_person": "median_income / nullif(population / nullif(households, 0), 0)",
    "income_to_rooms_ratio": "median_income / nullif(total_rooms / nullif(households, 0), 0)",
    "location_score": "sqrt((longitude + 118) * (longitude + 118) + (latitude - 34) * (latitude - 34))",
    "population_density": "population / nullif(total_rooms, 0)",
    "room_density": "total_rooms / nullif(households, 0)",
    "age_income_interaction": "housing_median_age * median_income",
    "location_income_interaction": "sqrt((longitude + 118) * (longitude + 118) + (latitude - 34) * (latitude - 34)) * median_income",
    "log_total_rooms": "ln(1 + total_rooms)",
    "log_total_bedrooms": "ln(1 + total_bedrooms)",
    "log_population": "ln(1 + population)",
    "log_households": "ln(1 + households)",
}
_FLAGS = {
    "is_new_house": "housing_median_age <= 10",
    "is_old_house": "housing_median_age >= 30",
    "high_income_area": "median_income > (SELECT quantile_cont(median_income, 0.75) FROM listing)",
    "low_population_area": "population < (SELECT quantile_cont(population, 0.25) FROM listing)",
}


def _derived_sql(names):
    # divisions, products and roots agree to the last bit; logarithms are rounded
    def value(n):
        return q(_DERIVED[n], 8) if n.startswith("log_") else f"({_DERIVED[n]})"

    cols = [f"{value(n)} AS {n}" if n in _DERIVED else f"({_FLAGS[n]})::INTEGER AS {n}" for n in names]
    return with_listing("SELECT row_key, " + ", ".join(cols) + " FROM listing")


_ALL = list(_DERIVED) + list(_FLAGS)


@query(_derived_sql(_ALL))
def derived_features(spark, sf):
    df = staged_listing(spark, sf, KEYED)
    out = derive.Deriver().fit(df).transform(df).select("row_key", *_ALL)
    return rounded(out, {f"log_{c}": 8 for c in derive.LOGGED})


@query(_derived_sql(derive.RATIO_FEATURES))
def derived_ratios(spark, sf):
    df = listing(spark, sf, ["row_key", "total_rooms", "total_bedrooms", "population", "households", "median_income"])
    return derive.ratio_features(df).select("row_key", *derive.RATIO_FEATURES)


@query(_derived_sql(["location_score"]))
def derived_location(spark, sf):
    df = derive.location_features(listing(spark, sf, ["row_key", "longitude", "latitude"]))
    return df.select("row_key", "location_score")


@query(_derived_sql(["is_new_house", "is_old_house"]))
def derived_age_flags(spark, sf):
    df = derive.age_features(listing(spark, sf, ["row_key", "housing_median_age"]))
    return df.select("row_key", "is_new_house", "is_old_house")


@query(_derived_sql(["high_income_area", "low_population_area"]))
def derived_quantile_flags(spark, sf):
    df = staged_listing(spark, sf, ["row_key", "median_income", "population"])
    return derive.Deriver().fit(df).threshold_features(df).select(
        "row_key", "high_income_area", "low_population_area"
    )


@query(_derived_sql(["log_total_rooms", "log_total_bedrooms", "log_population", "log_households"]))
def derived_logs(spark, sf):
    df = derive.log_features(listing(spark, sf, ["row_key", *derive.LOGGED]))
    return rounded(df.select("row_key", *[f"log_{c}" for c in derive.LOGGED]), 8)


_POLY = ["median_income", "housing_median_age"]


@query(with_listing("SELECT row_key, " + ", ".join(
    f"{q(f'{c} * {c}', 6)} AS \"{c}_{c}^2\", {q(f'{c} * {c} * {c}', 6)} AS \"{c}_{c}^3\"" for c in _POLY) + " FROM listing"))
def derived_polynomials(spark, sf):
    df = derive.polynomial_features(listing(spark, sf, ["row_key", *_POLY]), 3, _POLY)
    return rounded(df.drop(*_POLY), 6)


@query(with_listing(f"""SELECT "column" || '_' || "column" || '^2' AS "column", {q('m', 4)} AS mean FROM (
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", abs(corr({c}, {TARGET})) AS r, avg({c} * {c}) AS m FROM listing" for c in NUMERIC)
    + ") ORDER BY r DESC LIMIT 5"))
def derived_polynomials_top5(spark, sf):
    """Mean squares of the five columns most correlated with the target."""
    df = derive.polynomial_features(staged_listing(spark, sf, NUMERIC + [TARGET]))
    new = [c for c in df.columns if "^" in c]
    means = df.agg(*[F.avg(c).alias(c) for c in new])
    return rounded(means.unpivot([], [F.col(f"`{c}`") for c in new], "column", "mean"), 4)


# -- row subsets ------------------------------------------------------------


@query(with_listing("SELECT * EXCLUDE (fold) FROM listing ORDER BY row_key LIMIT 1000"))
def first_rows(spark, sf):
    cols = NUMERIC + [TARGET, CATEGORY, "row_key"]
    return listing(spark, sf, cols).orderBy("row_key").limit(1000)


@query(with_listing(f"SELECT row_key, {TARGET} FROM listing ORDER BY md5(concat_ws('-', '42', row_key)), row_key LIMIT 200"))
def display_rows(spark, sf):
    return display_sample(listing(spark, sf, ["row_key", TARGET]), "row_key")


# -- encoders ---------------------------------------------------------------

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(with_listing("SELECT row_key, " + ", ".join(
    f"(coalesce(ocean_proximity = '{s}', false))::INTEGER::DOUBLE AS \"ocean_proximity_{s}\"" for s in _SEGMENTS) + " FROM listing"))
def encode_onehot(spark, sf):
    df = staged_listing(spark, sf, ["row_key", CATEGORY])
    return encode.Encoder("onehot").fit(df, [CATEGORY]).transform(df)


@query(with_listing(f"""
SELECT row_key, {q('m', 6)} AS ocean_proximity_target_encoded
FROM listing LEFT JOIN (SELECT ocean_proximity AS g, avg({TARGET}) AS m FROM listing GROUP BY 1) ON ocean_proximity = g"""))
def encode_target(spark, sf):
    df = staged_listing(spark, sf, ["row_key", CATEGORY, TARGET])
    return rounded(encode.Encoder("target").fit(df, [CATEGORY]).transform(df).drop(TARGET), 6)


@query(with_listing(f"""
SELECT row_key, {q('m', 10)} AS ocean_proximity_frequency_encoded
FROM listing LEFT JOIN (SELECT ocean_proximity AS g, count(*) / (SELECT count(ocean_proximity) FROM listing) AS m
                        FROM listing WHERE ocean_proximity IS NOT NULL GROUP BY 1) ON ocean_proximity = g"""))
def encode_frequency(spark, sf):
    df = staged_listing(spark, sf, ["row_key", CATEGORY])
    return rounded(encode.Encoder("frequency").fit(df, [CATEGORY]).transform(df), 10)


# -- scalers ----------------------------------------------------------------


def _scale_sql(center, spread):
    p = (
        f'p AS (SELECT "column", {center} AS m, CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END AS s'
        f" FROM long GROUP BY 1)"
    )
    def val(c):
        m, s = (f"(SELECT {x} FROM p WHERE \"column\" = '{c}')" for x in "ms")
        return q(f"({c} - {m}) / {s}", 8)

    cols = ", ".join(f"{val(c)} AS {c}" for c in NUMERIC)
    return with_listing(f"SELECT row_key, {cols} FROM listing", long_cte() + ", " + p)


def _scaled(spark, sf, method):
    df = staged_listing(spark, sf, KEYED)
    return rounded(scale.Scaler(method).fit(df, NUMERIC).transform(df), 8)


@query(_scale_sql("avg(v)", "stddev_pop(v)"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query(_scale_sql("quantile_cont(v, 0.5)", "(quantile_cont(v, 0.75) - quantile_cont(v, 0.25))"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query(_scale_sql("min(v)", "(max(v) - min(v))"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query(with_listing("SELECT row_key, 1.0::DOUBLE AS bias, " + ", ".join(
    q(f"({c} - (SELECT avg({c}) FROM listing WHERE fold <> 0)) / (SELECT stddev_pop({c}) FROM listing WHERE fold <> 0)", 8)
    + f" AS {c}" for c in ["total_rooms", "median_income"]) + " FROM listing WHERE fold = 0"))
def scale_train_then_apply(spark, sf):
    """Scaling fitted on the training side and applied to the validation side."""
    from gramlark.operators.folds import side

    cols = ["total_rooms", "median_income"]
    df = staged_listing(spark, sf, ["row_key", *cols], fold=True)
    fitted = scale.Scaler("standard").fit(side(df, 0, "train"), cols)
    out = fitted.transform(side(df, 0, "validation")).drop("fold")
    return rounded(scale.add_bias(out), 8)


# -- clusters ---------------------------------------------------------------


@query(with_listing(f"""
SELECT label AS geo_cluster, count(*) AS count, {q('avg(d)', 8)} AS mean_distance,
       {q(f'avg({TARGET})', 4)} AS mean, {q(f'stddev_samp({TARGET})', 4)} AS std
FROM (SELECT row_key, {TARGET}, arg_min(k, dist) AS label, min(dist) AS d FROM (
        SELECT row_key, {TARGET}, k, sqrt((latitude - cy) * (latitude - cy) + (longitude - cx) * (longitude - cx)) AS dist
        FROM listing, centers) GROUP BY row_key, {TARGET})
GROUP BY 1""", """
centers AS (SELECT (row_number() OVER (ORDER BY ocean_proximity) - 1)::INTEGER AS k, avg(latitude) AS cy, avg(longitude) AS cx
            FROM listing GROUP BY ocean_proximity)"""))
def nearest_centroid(spark, sf):
    """Nearest of the category centroids, with per-cluster target statistics."""
    import numpy as np

    df = staged_listing(spark, sf, ["row_key", "latitude", "longitude", TARGET, CATEGORY])
    rows = df.groupBy(CATEGORY).agg(F.avg("latitude").alias("y"), F.avg("longitude").alias("x"))
    centers = np.array([[r["y"], r["x"]] for r in rows.orderBy(CATEGORY).collect()])
    geo = cluster.GeoClusters(centers=centers)
    assigned = geo.assign(df)
    stats = cluster.cluster_stats(assigned)
    far = assigned.groupBy("geo_cluster").agg(F.avg("geo_cluster_distance").alias("mean_distance"))
    out = stats.join(far, "geo_cluster")
    return rounded(out, {"mean": 4, "std": 4, "mean_distance": 8})


_K, _STARTS, _SEED = 5, 10, 42
_PARTS = "concat_ws('/', s, round(x * 1000000)::BIGINT, round(y * 1000000)::BIGINT)"
_NEW = lambda v: "[" + ", ".join(
    f"coalesce(sum(w * {v}) FILTER (l = {k}) / sum(w) FILTER (l = {k}), any_value(c{v})[{k}])" for k in range(1, _K + 1)) + "]"
_APART = "[" + ", ".join(f"(x - cx[{k}]) * (x - cx[{k}]) + (y - cy[{k}]) * (y - cy[{k}])" for k in range(1, _K + 1)) + "]"
_KMEANS = f"""
pts AS (SELECT latitude AS x, longitude AS y, count(*)::DOUBLE AS w FROM listing WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL),
tol AS (SELECT 1e-4 * (var_pop(latitude) + var_pop(longitude)) / 2 AS tol FROM listing),
seeds AS (SELECT s, x, y, row_number() OVER (PARTITION BY s ORDER BY md5({_PARTS}), x, y) AS r
  FROM pts, range({_SEED}, {_SEED + _STARTS}) t(s)),
moves AS (
  SELECT 0 AS i, s, list(x ORDER BY r) AS cx, list(y ORDER BY r) AS cy, false AS done FROM seeds WHERE r <= {_K} GROUP BY s
  UNION ALL
  SELECT i + 1, s, nx, ny, list_sum(list_transform(nx, lambda v, k: (v - cx[k]) ** 2 + (ny[k] - cy[k]) ** 2)) <= tol
  FROM tol, (SELECT i, s, any_value(cx) AS cx, any_value(cy) AS cy, {_NEW('x')} AS nx, {_NEW('y')} AS ny
    FROM (SELECT *, list_position(d, list_min(d)) AS l FROM (SELECT i, s, cx, cy, x, y, w, {_APART} AS d FROM moves, pts WHERE NOT done AND i < 300))
    GROUP BY i, s)),
ends AS (SELECT s, arg_max(cx, i) AS cx, arg_max(cy, i) AS cy FROM moves GROUP BY s),
best AS (SELECT s, cx, cy FROM (SELECT s, any_value(cx) AS cx, any_value(cy) AS cy, sum(w * list_min({_APART})) AS cost FROM ends, pts GROUP BY s)
  QUALIFY cost <= min(cost) OVER () * (1 + 1e-9) ORDER BY s LIMIT 1)"""


@query(with_listing(f"""
SELECT geo_cluster, count(*) AS "rows", {q('avg(d)', 4)} AS mean_distance, {q(f'avg({TARGET})', 4)} AS cluster_mean_value,
       {q(f'stddev_samp({TARGET})', 4)} AS cluster_std_value
FROM (SELECT {TARGET}, sqrt(list_min(d)) AS d, (list_position(d, list_min(d)) - 1)::INTEGER AS geo_cluster
      FROM (SELECT {TARGET}, {_APART} AS d FROM (SELECT latitude AS x, longitude AS y, {TARGET} FROM listing), best))
GROUP BY 1""", _KMEANS, recursive=True))
def geo_clusters(spark, sf):
    df = staged_listing(spark, sf, ["latitude", "longitude", TARGET])
    out = cluster.GeoClusters(k=_K, seed=_SEED, n_init=_STARTS).fit(df).transform(df)
    per = out.groupBy("geo_cluster").agg(
        F.count("*").alias("rows"), F.avg("geo_cluster_distance").alias("mean_distance"),
        F.first("cluster_mean_value").alias("cluster_mean_value"),
        F.first("cluster_std_value").alias("cluster_std_value"),
    )
    return rounded(per, 4)


@query(with_listing(f"""
SELECT sum(w)::BIGINT AS "rows", {q('sum(w * CASE WHEN n = w THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(w)', 6)} AS silhouette
FROM (SELECT w, any_value(n) FILTER (own) AS n, any_value(m * n / nullif(n - w, 0)) FILTER (own) AS a, min(m) FILTER (NOT own) AS b
  FROM (SELECT x, y, w, g.n, g.l = p.l AS own, x * x + y * y - 2 * (x * g.mx + y * g.my) + g.q AS m FROM labelled p, per g) GROUP BY x, y, w)""",
    _KMEANS + f""",
labelled AS (SELECT x, y, w, list_position(d, list_min(d)) AS l FROM (
  SELECT x - 35 AS x, y + 120 AS y, w, d FROM (SELECT x, y, w, {_APART} AS d FROM pts, best))),
per AS (SELECT l, sum(w) AS n, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, sum(w * (x * x + y * y)) / sum(w) AS q
  FROM labelled GROUP BY l)""", recursive=True))
def cluster_silhouette(spark, sf):
    df = staged_listing(spark, sf, ["latitude", "longitude"])
    value = cluster.silhouette(df, cluster.GeoClusters(k=_K, seed=_SEED, n_init=_STARTS).fit(df))
    return df.agg(F.count("*").alias("rows"), F.round(F.lit(value), 6).alias("silhouette"))


# -- selection --------------------------------------------------------------


@query(with_listing(f"""
SELECT "column", (row_number() OVER (ORDER BY r DESC))::INTEGER AS rank FROM (
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", abs(corr({c}, {TARGET})) AS r FROM listing" for c in NUMERIC)
    + ") ORDER BY r DESC LIMIT 5"))
def select_by_correlation(spark, sf):
    df = staged_listing(spark, sf, NUMERIC + [TARGET])
    names = select.select_features(df, method="correlation", k_best=5)
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(names)], "column string, rank int")


def _mi_sql():
    cols = NUMERIC + [TARGET]
    edges = ", ".join(f"quantile_cont({c}, [{', '.join(f'{i / 10}' for i in range(1, 10))}]) AS e_{c}" for c in cols)
    bins = ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL ELSE len(list_filter(e_{c}, lambda e: e < {c})) END AS {c}" for c in NUMERIC
    )
    extra = f"""
edges AS (SELECT {edges} FROM listing),
binned AS (SELECT len(list_filter(e_{TARGET}, lambda e: e < {TARGET})) AS bin_y, {bins} FROM listing, edges),
cells AS (SELECT "column", v AS bx, bin_y, count(*)::DOUBLE AS n FROM (SELECT * FROM binned UNPIVOT (v FOR "column" IN ({NUM_LIST}))) GROUP BY 1, 2, 3),
parts AS (SELECT "column", n, sum(n) OVER (PARTITION BY "column", bx) AS nx, sum(n) OVER (PARTITION BY "column", bin_y) AS ny,
          sum(n) OVER (PARTITION BY "column") AS total FROM cells)"""
    return with_listing(
        f'SELECT "column", {q("sum(n / total * ln(n * total / (nx * ny)))", 8)} AS mutual_info FROM parts GROUP BY 1', extra
    )


@query(_mi_sql())
def mutual_information(spark, sf):
    df = staged_listing(spark, sf, NUMERIC + [TARGET])
    scores = select.mutual_information(df, NUMERIC)
    return rounded(spark.createDataFrame(list(scores.items()), "column string, mutual_info double"), 8)


def _complete(spark, sf):
    df = staged_listing(spark, sf, NUMERIC + [TARGET])
    return handle_missing(df, "median", indicators=False)


_LEFT = " UNION ALL ".join(
    f"SELECT {k}::INTEGER AS k, unnest(range(1, {k + 1}))::INTEGER AS position, unnest(f) AS f FROM left{len(NUMERIC) - k}" for k in (6, 4, 2)
)


@query(with_listing(f"""SELECT k, position, [{", ".join(f"'{c}'" for c in NUMERIC)}][f] AS "column" FROM ({_LEFT})""",
    ",\n".join([FILLED, ALL_ROWS, moments(NUMERIC), eliminated(NUMERIC, 2)]), recursive=True))
def select_by_elimination(spark, sf):
    gram = gram_by(_complete(spark, sf), NUMERIC, TARGET)[0]
    rows = [(k, i + 1, c) for k in (6, 4, 2) for i, c in enumerate(select.eliminate(gram, k))]
    return spark.createDataFrame(rows, "k int, position int, column string")


@query()
def select_hybrid(spark, sf):
    names = select.select_features(_complete(spark, sf), method="hybrid", k_best=20)
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(names)], "column string, position int")


# -- the whole flow ---------------------------------------------------------


def _flow(**kw):
    return FeatureFlow(**kw)


@query()
def feature_flow(spark, sf):
    """Fit on the training side of fold 0, transform all rows, summarise."""
    from gramlark.operators.profile import describe

    df = staged_listing(spark, sf, NUMERIC + [TARGET, CATEGORY, "row_key"], fold=True)
    flow = _flow().fit(df.where("fold <> 0"))
    out = flow.transform(df)
    return rounded(describe(out, flow.selected + [TARGET]), 4)


@query()
def feature_flow_new_rows(spark, sf):
    """Fit on four folds, transform the fifth with the stored state only."""
    df = staged_listing(spark, sf, NUMERIC + [TARGET, CATEGORY, "row_key"], fold=True)
    flow = _flow(selection=None).fit(df.where("fold <> 4"))
    return rounded(flow.transform(df.where("fold = 4")), 6)
