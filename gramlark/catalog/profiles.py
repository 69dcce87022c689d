"""Profile, quality and correlation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramlark.catalog.base import long_cte, q, query, rounded, staged_listing
from gramlark.operators import profile
from gramlark.operators.correlate import correlation_rows, target_correlations
from gramlark.operators.derive import ratio_features
from gramlark.operators.impute import handle_missing
from gramlark.schema import CATEGORY, NUMERIC, RAW_COLUMNS, TARGET, column_roles, compare_columns
from gramlark.schema import validate
from gramlark.sources.listing import listing, with_listing
from gramlark.plans.reports import exploration_report, preprocessing_requirements

ALL_NUMERIC = NUMERIC + [TARGET]
RAW_LIST = ", ".join(RAW_COLUMNS)


def _nulls_sql(columns):
    return " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)


@query(with_listing("SELECT count(*) AS rows, 10::BIGINT AS columns, 8::BIGINT AS numerical,"
                    " 1::BIGINT AS categorical FROM listing"))
def schema_roles(spark, sf):
    df = validate(listing(spark, sf))
    roles = column_roles(df)
    width = lambda n: F.lit(n).cast("bigint")
    return df.agg(
        F.count("*").alias("rows"),
        width(len(df.columns)).alias("columns"),
        width(len(roles["numerical"])).alias("numerical"),
        width(len(roles["categorical"])).alias("categorical"),
    )


_INFO = " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", "
    f"'{'string' if c == CATEGORY else 'double'}' AS data_type, count(*) AS rows, count({c}) AS non_null FROM listing"
    for i, c in enumerate(RAW_COLUMNS)
)


@query(with_listing(_INFO))
def basic_info(spark, sf):
    return profile.basic_info(listing(spark, sf))


_DESCRIBE = f"""
SELECT "column", count(v) AS count, {q('avg(v)', 4)} AS mean, {q('stddev_samp(v)', 4)} AS std,
       {q('min(v)', 6)} AS min, {q('quantile_cont(v, 0.25)', 6)} AS q25, {q('quantile_cont(v, 0.5)', 6)} AS q50,
       {q('quantile_cont(v, 0.75)', 6)} AS q75, {q('max(v)', 6)} AS max
FROM long GROUP BY 1
"""
_DESCRIBE_DIGITS = {"mean": 4, "std": 4, "min": 6, "q25": 6, "q50": 6, "q75": 6, "max": 6}


@query(with_listing(_DESCRIBE, long_cte(ALL_NUMERIC)))
def describe_numeric(spark, sf):
    return rounded(profile.describe(staged_listing(spark, sf, ALL_NUMERIC)), _DESCRIBE_DIGITS)


@query(with_listing(f"""
SELECT '{CATEGORY}' AS "column", {CATEGORY} AS category, count(*) AS count,
       {q('count(*) / (SELECT count(ocean_proximity) FROM listing)', 10)} AS share
FROM listing WHERE {CATEGORY} IS NOT NULL GROUP BY 2"""))
def category_counts(spark, sf):
    return rounded(profile.value_counts(listing(spark, sf, [CATEGORY])), 10)


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, "
    f"{q(f'count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*)', 8)} AS percent FROM listing"
    for c in RAW_COLUMNS)))
def null_counts(spark, sf):
    return rounded(profile.null_counts(listing(spark, sf)), 8)


@query(with_listing(f"""
SELECT sum(c)::BIGINT AS rows, sum(c - 1)::BIGINT AS duplicates, {q('sum(c - 1) * 100.0::DOUBLE / sum(c)', 8)} AS percent
FROM (SELECT count(*) AS c FROM listing GROUP BY {RAW_LIST})"""))
def duplicate_rows(spark, sf):
    return rounded(profile.duplicate_rows(listing(spark, sf)), 8)


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM listing" for c in RAW_COLUMNS)))
def distinct_counts(spark, sf):
    return profile.distinct_counts(listing(spark, sf))


@query(with_listing(f"""
SELECT '{TARGET}' AS "column", count(*) AS rows, count(*) FILTER ({TARGET} IS NULL) AS missing,
       {q(f'min({TARGET})', 6)} AS min, {q(f'max({TARGET})', 6)} AS max, {q(f'avg({TARGET})', 4)} AS mean,
       {q(f'quantile_cont({TARGET}, 0.5)', 6)} AS median, {q(f'stddev_samp({TARGET})', 4)} AS std,
       {q(f'quantile_cont({TARGET}, 0.25)', 6)} AS q25, {q(f'quantile_cont({TARGET}, 0.75)', 6)} AS q75
FROM listing"""))
def target_profile(spark, sf):
    return rounded(
        profile.target_profile(staged_listing(spark, sf, [TARGET])),
        {"min": 6, "max": 6, "mean": 4, "median": 6, "std": 4, "q25": 6, "q75": 6},
    )


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} = -1) AS infinities FROM listing" for c in ALL_NUMERIC)))
def infinite_counts(spark, sf):
    """All numeric columns, with their gaps marked by infinities."""
    df = listing(spark, sf, ALL_NUMERIC)
    marked = [F.coalesce(F.when(F.col(c) == -1, F.lit(float("-inf"))).otherwise(F.col(c)), F.lit(float("inf"))).alias(c) for c in ALL_NUMERIC]
    return profile.infinite_counts(df.select(*marked))


@query(with_listing(f"""
SELECT 'shape' AS section, 'rows' AS key, rows AS value FROM t
UNION ALL SELECT 'shape', 'columns', 10 FROM t
UNION ALL SELECT 'quality', 'missing_values', nulls FROM t
UNION ALL SELECT 'quality', 'infinite_values', 0 FROM t
UNION ALL SELECT 'quality', 'duplicate_rows', (SELECT sum(c - 1)::DOUBLE FROM (SELECT count(*) AS c FROM listing GROUP BY {RAW_LIST})) FROM t
UNION ALL SELECT 'features', 'numerical', 9 FROM t
UNION ALL SELECT 'features', 'categorical', 1 FROM t
UNION ALL SELECT 'target', 'present', 1 FROM t
UNION ALL SELECT 'target', key, value FROM (SELECT {q(f'count({TARGET})', 4)} AS count, {q(f'avg({TARGET})', 4)} AS mean,
  {q(f'stddev_samp({TARGET})', 4)} AS std, {q(f'min({TARGET})', 4)} AS min, {q(f'quantile_cont({TARGET}, 0.25)', 4)} AS q25,
  {q(f'quantile_cont({TARGET}, 0.5)', 4)} AS q50, {q(f'quantile_cont({TARGET}, 0.75)', 4)} AS q75,
  {q(f'max({TARGET})', 4)} AS max FROM listing) UNPIVOT (value FOR key IN (count, mean, std, min, q25, q50, q75, max))
""", f"t AS (SELECT count(*)::DOUBLE AS rows, ({_nulls_sql(RAW_COLUMNS)})::DOUBLE AS nulls FROM listing)"))
def validate_processed(spark, sf):
    return rounded(profile.validate_processed(staged_listing(spark, sf)), 4)


@query(with_listing(f"""
SELECT count(*) AS raw_rows, 10::BIGINT AS raw_columns, {_nulls_sql(RAW_COLUMNS)} AS raw_nulls,
       count(*) AS processed_rows, 16::BIGINT AS processed_columns, 0::BIGINT AS processed_nulls,
       6::BIGINT AS new_features, 0::BIGINT AS rows_added, {_nulls_sql(RAW_COLUMNS)} AS nulls_removed
FROM listing"""))
def compare_before_after(spark, sf):
    raw = staged_listing(spark, sf)
    return profile.compare_tables(raw, ratio_features(handle_missing(raw, "median")))


@query(with_listing("""
SELECT 'common' AS kind, 10::BIGINT AS columns, count(*) AS rows FROM listing
UNION ALL SELECT 'new', 6, count(*) FROM listing
UNION ALL SELECT 'removed', 0, count(*) FROM listing"""))
def compare_column_sets(spark, sf):
    raw = staged_listing(spark, sf)
    after = ratio_features(handle_missing(raw, "median"))
    sets = compare_columns(raw, after)
    entries = [
        F.struct(F.lit(k).alias("kind"), F.lit(len(v)).cast("bigint").alias("columns"),
                 F.col("rows").alias("rows"))
        for k, v in sets.items()
    ]
    return after.agg(F.count("*").alias("rows")).select(F.inline(F.array(*entries)))


def corr_sql(columns, source="listing", fn="corr"):
    parts = []
    for a in columns:
        for b in columns:
            value = "1.0::DOUBLE" if a == b else f"{fn}({a}, {b})"
            parts.append(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q(value, 8)} AS correlation FROM {source}"
                + (" GROUP BY 1" if a == b else "")
            )
    return " UNION ALL ".join(parts)


@query(with_listing(corr_sql(ALL_NUMERIC)))
def correlation_pearson(spark, sf):
    return rounded(correlation_rows(staged_listing(spark, sf, ALL_NUMERIC)), 8)


_SP = ["housing_median_age", "total_bedrooms", "population", "median_income", TARGET]


def _spearman_pair(a, b):
    if a == b:
        return f"SELECT '{a}' AS column_a, '{b}' AS column_b, 1.0::DOUBLE AS correlation FROM listing GROUP BY 1"
    rank = lambda c: (
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"
    )
    return (
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q('corr(ra, rb)', 8)} AS correlation FROM "
        f"(SELECT {rank(a)} AS ra, {rank(b)} AS rb FROM listing WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


@query(with_listing(" UNION ALL ".join(_spearman_pair(a, b) for a in _SP for b in _SP)))
def correlation_spearman(spark, sf):
    return rounded(correlation_rows(staged_listing(spark, sf, _SP), "spearman"), 8)


_KT = ["housing_median_age", "median_income", "total_rooms"]


def _kendall_pair(a, b):
    if a == b:
        return f"SELECT '{a}' AS column_a, '{b}' AS column_b, 1.0::DOUBLE AS correlation FROM listing GROUP BY 1"
    j = f"(SELECT {a} AS x, {b} AS y, count(*)::DOUBLE AS w FROM listing GROUP BY 1, 2)"
    ties = lambda c: f"(SELECT sum(w * (w - 1) / 2) FROM (SELECT count(*)::DOUBLE AS w FROM listing GROUP BY {c}))"
    pairs = "(SELECT count(*)::DOUBLE * (count(*) - 1) / 2 FROM listing)"
    body = (
        f"(SELECT sum(CASE WHEN (p.x < r.x AND p.y < r.y) THEN p.w * r.w WHEN (p.x < r.x AND p.y > r.y) THEN -p.w * r.w ELSE 0 END)"
        f" FROM {j} p, {j} r) / sqrt(({pairs} - {ties(a)}) * ({pairs} - {ties(b)}))"
    )
    return f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q(body, 8)} AS correlation"


@query(with_listing(" UNION ALL ".join(_kendall_pair(a, b) for a in _KT for b in _KT)))
def correlation_kendall(spark, sf):
    return rounded(correlation_rows(staged_listing(spark, sf, _KT), "kendall"), 8)


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {q(f'abs(corr({c}, {TARGET}))', 8)} AS strength FROM listing" for c in NUMERIC)))
def target_correlation(spark, sf):
    pairs = target_correlations(staged_listing(spark, sf, ALL_NUMERIC), TARGET)
    return rounded(spark.createDataFrame(pairs, "column string, strength double"), 8)


_STATS = {
    "mean": "avg(v)", "std": "stddev_samp(v)", "min": "min(v)", "q25": "quantile_cont(v, 0.25)",
    "q50": "quantile_cont(v, 0.5)", "q75": "quantile_cont(v, 0.75)", "max": "max(v)",
}


@query(with_listing(f"""
SELECT 'columns' AS section, "column" || '.type' AS key, data_type AS value FROM info
UNION ALL SELECT 'columns', "column" || '.non_null', non_null::VARCHAR FROM info
UNION ALL SELECT 'shape', 'table.rows', count(*)::VARCHAR FROM listing
UNION ALL SELECT 'shape', 'table.nulls', ({_nulls_sql(RAW_COLUMNS)})::VARCHAR FROM listing
UNION ALL SELECT 'categories', 'ocean_proximity.' || ocean_proximity || '.count', count(*)::VARCHAR FROM listing
  WHERE ocean_proximity IS NOT NULL GROUP BY 2
""" + "".join(f"""UNION ALL SELECT 'statistics', "column" || '.{k}', printf('%.4f', {e}) FROM long GROUP BY "column"
""" for k, e in _STATS.items()), f"info AS ({_INFO}), {long_cte(ALL_NUMERIC)}"))
def exploration_rows(spark, sf):
    return exploration_report(staged_listing(spark, sf))


_FENCE = "v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1)"


@query(with_listing(f"""
{" UNION ALL ".join(f"SELECT 'missing_values' AS section, '{c}.count' AS key, count(*) FILTER ({c} IS NULL)::VARCHAR AS value FROM listing" for c in RAW_COLUMNS)}
UNION ALL {" UNION ALL ".join(f"SELECT 'missing_values', '{c}.percent', printf('%.2f', count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*)) FROM listing" for c in RAW_COLUMNS)}
UNION ALL {" UNION ALL ".join(f"SELECT 'features', '{c}.kind', '{'categorical' if c == CATEGORY else 'numerical'}'" for c in RAW_COLUMNS)}
UNION ALL SELECT 'outliers', "column" || '.count', count(*) FILTER ({_FENCE})::VARCHAR FROM long JOIN b USING ("column") GROUP BY "column"
UNION ALL SELECT 'outliers', "column" || '.percent', printf('%.2f', count(*) FILTER ({_FENCE}) * 100.0::DOUBLE / (SELECT count(*) FROM listing)) FROM long JOIN b USING ("column") GROUP BY "column"
UNION ALL SELECT 'outliers', "column" || '.lower', printf('%.2f', q1 - 1.5::DOUBLE * (q3 - q1)) FROM b
UNION ALL SELECT 'outliers', "column" || '.upper', printf('%.2f', q3 + 1.5::DOUBLE * (q3 - q1)) FROM b
UNION ALL SELECT 'data_quality', 'table.rows', count(*)::VARCHAR FROM listing
UNION ALL SELECT 'data_quality', 'table.duplicates', sum(c - 1)::VARCHAR FROM (SELECT count(*) AS c FROM listing GROUP BY {RAW_LIST})
""", long_cte() + """,
b AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1)"""))
def preprocessing_requirement_rows(spark, sf):
    return preprocessing_requirements(staged_listing(spark, sf))
