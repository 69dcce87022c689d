"""Overviews, kept choices and kept models."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from gramlark.catalog.base import q, query, rounded, staged_listing
from gramlark.catalog.evaluation import _VAL, _summary
from gramlark.catalog.models import _EPOCH, _reg_sql, saved_models
from gramlark.catalog.storage import _path
from gramlark.operators.overview import overview, write_with_overview
from gramlark.plans.ranking import candidate_rows
from gramlark.schema import CATEGORY, NUMERIC, RAW_COLUMNS, TARGET
from gramlark.sources import registry, versions
from gramlark.sources.listing import listing, with_listing

_MOMENTS = ["mean", "std", "min", "max"]


def _overview_sql() -> str:
    part = lambda c, role: (
        f"SELECT '{c}' AS \"column\", '{role}' AS role, count(*) AS rows, count(*) - count({c}) AS nulls, "
        + (
            f"{q(f'avg({c})', 4)} AS mean, {q(f'stddev_samp({c})', 4)} AS std, {q(f'min({c})', 4)} AS min, {q(f'max({c})', 4)} AS max"
            if role != "categorical"
            else "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max"
        )
        + " FROM listing"
    )
    return with_listing(
        " UNION ALL ".join(
            [part(c, "numerical") for c in NUMERIC] + [part(TARGET, "target"), part(CATEGORY, "categorical")]
        )
    )


def _exact(rows):
    return rounded(rows.where("column <> '*'").select("column", "role", "rows", "nulls", *_MOMENTS), 4)


@query(_overview_sql())
def overview_one_scan(spark, sf):
    """Exact figures of the overview that one scan of the listing gives."""
    return _exact(overview(listing(spark, sf, RAW_COLUMNS)))


@query(_overview_sql())
def overview_while_writing(spark, sf):
    """The same figures, observed while the listing is written."""
    return _exact(write_with_overview(listing(spark, sf, RAW_COLUMNS), _path(spark, "observed")))


_CONFIG = {"description": "one feature, normal equations", "penalty": "none"}
_CHOSEN = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


@query(with_listing(f"""
SELECT rank, model, {q('r2', 8)} AS avg_r2, 'one feature, normal equations' AS description, 'none' AS penalty,
       '2024-05-06 07:08:09' AS selection_date
FROM (SELECT row_number() OVER (ORDER BY r2 DESC, model)::INTEGER AS rank, model, r2 FROM val) WHERE rank <= 3""", _VAL))
def save_candidates(spark, sf):
    """Write the three best models as a version, then one more that breaks off, and read the newest."""
    summary, root = _summary(spark, sf), _path(spark, "candidates")
    configs = {r.model: _CONFIG for r in summary.select("model").distinct().collect()}
    rows = candidate_rows(summary, configs, 3, _CHOSEN)
    versions.write_version(rows.limit(1), root, _CHOSEN)
    versions.write_version(rows, root, _CHOSEN + timedelta(hours=1))
    rows.limit(2).write.parquet(f"{root}/99991231T000000000000-broken")  # no marker: never seen
    kept = versions.read_version(spark, root)
    out = kept.select("rank", "model", "avg_r2", "description", F.col("config")["penalty"].alias("penalty"), "selection_date")
    return rounded(out, {"avg_r2": 8})


@query(_reg_sql(f"""SELECT model, fold, feature, {q('intercept', 3)} AS intercept, {q('w', 6)} AS weight, {q('r2', 8)} AS r2
FROM reg WHERE fold = 3"""))
def registry_saved(spark, sf):
    """Models saved and loaded again; those of one time stamp."""
    path = _path(spark, "models")
    registry.save_models(saved_models(spark, sf), path)
    loaded = registry.load_models(spark, path)
    hits = None
    for name in sorted(r.model for r in loaded.select("model").distinct().collect()):  # one per kind of model
        one = registry.at_time(loaded, name, _EPOCH + timedelta(days=3))
        hits = one if hits is None else hits.unionByName(one)
    weights = registry.coefficient_rows(hits, ["model", "fold", "intercept", "metrics"])
    out = weights.select("model", "fold", "feature", "intercept", "weight", F.col("metrics")["r2"].alias("r2"))
    return rounded(out, {"intercept": 3, "weight": 6, "r2": 8})


@query(with_listing(f"""
SELECT 'raw' AS side, count(*) AS rows, 9::BIGINT AS features, 8::BIGINT AS numerical, 1::BIGINT AS categorical,
  {' + '.join(f'(count(*) - count({c}))' for c in RAW_COLUMNS)} AS nulls, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(RAW_COLUMNS)} FROM listing)) AS duplicates,
  (SELECT {q('avg(n)', 4)} FROM (SELECT (SELECT count(*) FROM listing) - count(*) AS n FROM listing GROUP BY fold)) AS mean_train_rows,
  (SELECT {q('avg(n)', 4)} FROM (SELECT count(*) AS n FROM listing GROUP BY fold)) AS mean_validation_rows FROM listing
UNION ALL
SELECT 'processed', count(*), 10, 9, 1, 0, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM filled)),
  (SELECT {q('avg(n)', 4)} FROM (SELECT (SELECT count(*) FROM listing) - count(*) AS n FROM listing GROUP BY fold)),
  (SELECT {q('avg(n)', 4)} FROM (SELECT count(*) AS n FROM listing GROUP BY fold)) FROM filled
""", f"""filled AS (SELECT {', '.join(c for c in RAW_COLUMNS if c != 'total_bedrooms')},
  coalesce(total_bedrooms, (SELECT avg(total_bedrooms) FROM listing)) AS total_bedrooms,
  (total_bedrooms IS NULL)::INTEGER AS missing FROM listing)"""))
def preprocessing_statistics_full(spark, sf):
    """Rows, feature kinds, nulls, duplicates and mean fold sizes of the raw and of the imputed table."""
    from gramlark.operators.impute import handle_missing
    from gramlark.operators.profile import preprocessing_statistics

    df = staged_listing(spark, sf, RAW_COLUMNS, fold=True)
    processed = handle_missing(df.drop("fold"), "mean")
    return rounded(preprocessing_statistics(df.drop("fold"), processed, df.select("fold")), 4)
