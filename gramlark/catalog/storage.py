"""Scan and sink queries: every one writes tables and reads them back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramlark.catalog.base import q, query, rounded, staged_listing
from gramlark.catalog.evaluation import DIGITS, _ERR, _EXPR
from gramlark.catalog.models import out_of_fold
from gramlark.operators import evaluate, folds, profile
from gramlark.plans.feature_flow import FeatureFlow
from gramlark.schema import CATEGORY, NUMERIC, RAW_COLUMNS, TARGET
from gramlark.session import stage_root
from gramlark.sources import tables
from gramlark.sources.listing import listing, with_listing


def _path(spark, name):
    return f"{stage_root(spark)}/{name}-{uuid4().hex}"


_OVERVIEW = f"""SELECT count(*) AS rows, count(total_bedrooms) AS bedrooms, {q('sum(total_bedrooms) / 1e6', 6)} AS bedroom_sum,
  {q(f'sum({TARGET}) / 1e6', 4)} AS target_sum, count(DISTINCT {CATEGORY}) AS categories FROM listing"""


def _overview(df):
    out = df.agg(
        F.count("*").alias("rows"), F.count("total_bedrooms").alias("bedrooms"),
        (F.sum("total_bedrooms") / 1e6).alias("bedroom_sum"),
        (F.sum(TARGET) / 1e6).alias("target_sum"),
        F.count_distinct(CATEGORY).alias("categories"),
    )
    return rounded(out, {"bedroom_sum": 6, "target_sum": 4})


@query(with_listing(_OVERVIEW))
def scan_csv(spark, sf):
    """Header CSV under the declared schema; empty cells come back as NULL."""
    path = _path(spark, "raw-csv")
    tables.write_processed(listing(spark, sf), path, "csv")
    return _overview(tables.read_raw(spark, path))


@query(with_listing(_OVERVIEW))
def scan_processed(spark, sf):
    path = _path(spark, "processed")
    tables.write_processed(listing(spark, sf), path)
    return _overview(tables.read_processed(spark, path))


@query(with_listing(f"""
SELECT 'validation' AS side, count(*) AS rows, {q(f'avg({TARGET})', 4)} AS mean FROM listing WHERE fold = 3
UNION ALL SELECT 'train', count(*), {q(f'avg({TARGET})', 4)} FROM listing WHERE fold <> 3"""))
def scan_fold(spark, sf):
    """One copy partitioned by fold; a side is a pruned scan."""
    path = _path(spark, "folds")
    tables.write_folds(listing(spark, sf, NUMERIC + [TARGET], fold=True), path)
    parts = [
        tables.read_fold(spark, path, 3, which).agg(
            F.lit(which).alias("side"), F.count("*").alias("rows"), F.avg(TARGET).alias("mean")
        )
        for which in ("validation", "train")
    ]
    return rounded(parts[0].unionByName(parts[1]), 4)


@query(with_listing(f"SELECT fold, count(*) AS rows, {q(f'avg({TARGET})', 4)} AS mean FROM listing GROUP BY 1"))
def scan_all_folds(spark, sf):
    path = _path(spark, "folds")
    tables.write_folds(listing(spark, sf, [TARGET], fold=True), path)
    out = tables.read_folds(spark, path).groupBy("fold").agg(
        F.count("*").alias("rows"), F.avg(TARGET).alias("mean")
    )
    return rounded(out, 4)


@query(with_listing("SELECT fold, count(*) AS rows FROM listing GROUP BY 1"))
def scan_fold_ids(spark, sf):
    """Explicit id files per fold, read back and joined to the rows."""
    df = staged_listing(spark, sf, ["row_key"], fold=True).withColumn("row_id", F.xxhash64("row_key"))
    paths = {}
    for k in range(5):
        paths[k] = _path(spark, f"ids-{k}")
        df.where(F.col("fold") == k).select("row_id").write.option("header", True).csv(paths[k])
    ids = tables.read_fold_ids(spark, paths).distinct()
    joined = tables.attach_fold_ids(df.drop("fold"), ids)
    return joined.groupBy("fold").agg(F.count("*").alias("rows"))


@query(with_listing("""SELECT min(c) AS smallest, max(c) AS largest, count(*) AS folds
FROM (SELECT count(*) AS c FROM listing GROUP BY fold)"""))
def scan_cv_summary(spark, sf):
    path = _path(spark, "cv-summary")
    tables.write_rows(folds.fold_summary(listing(spark, sf, [TARGET], fold=True)), path)
    back = spark.read.parquet(path)
    return back.agg(
        F.min("validation_size").alias("smallest"), F.max("validation_size").alias("largest"),
        F.count("*").alias("folds"),
    )


@query(with_listing(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {q(f'avg({c})', 4)} AS mean FROM listing" for c in NUMERIC)))
def sink_profile(spark, sf):
    path = _path(spark, "profile")
    tables.write_rows(profile.describe(staged_listing(spark, sf, NUMERIC)), path)
    return rounded(spark.read.parquet(path).select("column", "count", "mean"), 4)


@query(with_listing(" UNION ALL ".join(
    f"SELECT 'on_income' AS model, fold, '{m}' AS metric, {q(_EXPR[m], DIGITS[m])} AS value FROM er GROUP BY 2"
    for m in evaluate.BASIC), _ERR))
def sink_metrics(spark, sf):
    path = _path(spark, "metrics")
    df = out_of_fold(spark, sf)
    wide = rounded(evaluate.basic_metrics(df, F.col("y"), F.col("yhat"), ["fold"]), DIGITS)
    long = evaluate.to_long(wide, ["fold"]).withColumn("model", F.lit("on_income"))
    tables.write_rows(long, path)
    return spark.read.parquet(path).select("model", "fold", "metric", "value")


@query()
def flow_state_round_trip(spark, sf):
    """Save a fitted flow, load it, and compare both on all rows."""
    df = staged_listing(spark, sf, RAW_COLUMNS + ["row_key"])
    flow = FeatureFlow(cluster_starts=1, selection="correlation", k_best=8, keys=("row_key",)).fit(df)
    path = _path(spark, "flow")
    flow.save(spark, path)
    again = FeatureFlow.load(spark, path)
    a, b = flow.transform(df), again.transform(df)
    numeric = [f.name for f in a.schema.fields if isinstance(f.dataType, T.DoubleType)]
    sums = lambda d, tag: d.agg(
        F.lit(tag).alias("state"), *[F.round(F.avg(c), 6).alias(c) for c in numeric]
    )
    return sums(a, "fitted").unionByName(sums(b, "loaded"))


@query(with_listing(f"""
SELECT (SELECT count(*) FROM listing) AS rows, 2::BIGINT AS tables, {q('5 * avg(t)', 4)} AS total_train_rows,
       {q('avg(v)', 4)} AS mean_validation_rows FROM (
  SELECT count(*) AS v, (SELECT count(*) FROM listing) - count(*) AS t FROM listing GROUP BY fold)"""))
def preprocessing_statistics(spark, sf):
    """Raw and processed tables and the average fold sizes in one row."""
    raw = listing(spark, sf, [TARGET], fold=True)
    path = _path(spark, "processed")
    tables.write_processed(raw, path)
    summary = folds.fold_summary(tables.read_processed(spark, path))
    out = summary.agg(
        (F.sum("validation_size")).cast("bigint").alias("rows"),
        F.lit(2).cast("bigint").alias("tables"),
        (5 * F.avg("train_size")).alias("total_train_rows"),
        F.avg("validation_size").alias("mean_validation_rows"),
    )
    return rounded(out, 4)
