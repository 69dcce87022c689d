"""Fold assignment and train/validation splits.

A fold is a column, never a copy of the data: the training side of fold ``k``
is ``fold <> k``.  Rows are assigned by a seeded hash of a stable key, so the
assignment does not depend on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.ranks import row_positions
from gramlark.schema import TARGET
from gramlark.sources.listing import hash_bucket


def _seeded(key: str, seed: int | None):
    return F.col(key) if seed is None else F.concat_ws("-", F.lit(str(seed)), F.col(key))


def content_key(df: DataFrame, columns: list[str] | None = None, name: str = "row_key") -> DataFrame:
    """Add a row key made from the row's content, for tables without one.

    Equal rows share a key, and so a fold.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns or df.columns]
    return df.withColumn(name, F.md5(F.concat_ws("\x1f", *parts)))


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int | None = 42) -> DataFrame:
    """Hash folds 0..k-1: sizes agree up to chance, at no shuffle at all."""
    return df.withColumn("fold", hash_bucket(_seeded(key, seed), k))


def assign_balanced_folds(df: DataFrame, key: str, k: int = 5, seed: int | None = 42) -> DataFrame:
    """Folds of equal size; the first ``n mod k`` folds get one row more."""
    shuffled = df.withColumn("_h", F.md5(_seeded(key, seed)))
    placed = row_positions(shuffled, ["_h", key], "_pos")
    return _cut_evenly(placed, k).drop("_h")


def ordered_folds(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """Unshuffled folds: consecutive blocks of the given order."""
    placed = row_positions(df, order, "_pos")
    return _cut_evenly(placed, k)


def _cut_evenly(placed: DataFrame, k: int) -> DataFrame:
    size, extra = divmod(placed.count(), k)
    head = extra * (size + 1)
    pos = F.col("_pos")
    fold = F.when(pos < head, F.floor(pos / F.lit(size + 1)))
    if size:
        fold = fold.otherwise(F.lit(extra) + F.floor((pos - head) / F.lit(size)))
    return placed.withColumn("fold", fold.cast("int")).drop("_pos")


def side(df: DataFrame, fold: int, which: str) -> DataFrame:
    """Training or validation rows of one fold."""
    if which not in ("train", "validation"):
        raise ValueError(f"side must be train or validation, not {which}")
    return df.where(F.col("fold") == fold if which == "validation" else F.col("fold") != fold)


def split_by_ids(df: DataFrame, validation_ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by explicit membership of the key."""
    ids = validation_ids.select(key).distinct()
    return df.join(ids, key, "left_anti"), df.join(ids, key, "left_semi")


def three_way_split(
    df: DataFrame, key: str, seed: int = 42, train: float = 0.70, validation: float = 0.15
) -> DataFrame:
    """Label rows train / validation / test by ranges of the key's hash."""
    share = hash_bucket(_seeded(key, seed), 1_000_000)
    return df.withColumn(
        "split",
        F.when(share < int(train * 1_000_000), "train")
        .when(share < int((train + validation) * 1_000_000), "validation")
        .otherwise("test"),
    )


def fold_summary(df: DataFrame, target: str = TARGET, non_features=("fold", "row_key")) -> DataFrame:
    """Sizes and target mean and deviation of both sides of every fold.

    One aggregate per fold; the training side is the total without the fold.
    """
    features = len([c for c in df.columns if c != target and c not in non_features])
    y = F.col(target)
    per = df.groupBy("fold").agg(
        F.count("*").alias("validation_size"),
        F.count(y).alias("ny"),
        F.avg(y).alias("validation_mean_target"),
        F.stddev_samp(y).alias("validation_std_target"),
        F.var_pop(y).alias("v"),
    )
    rows = per.collect()  # one row per fold
    n_all = sum(r["ny"] for r in rows)
    rows_all = sum(r["validation_size"] for r in rows)
    out = []
    for r in sorted(rows, key=lambda r: (r["fold"] is None, r["fold"])):
        rest = [s for s in rows if s["fold"] != r["fold"] and s["ny"]]
        n = n_all - r["ny"]
        mean = sum(s["ny"] * s["validation_mean_target"] for s in rest) / n if n else None
        m2 = sum(s["ny"] * (s["v"] + (s["validation_mean_target"] - mean) ** 2) for s in rest) if n else 0
        std = (m2 / (n - 1)) ** 0.5 if n > 1 else None
        out.append(
            (
                r["fold"], rows_all - r["validation_size"], r["validation_size"], mean,
                r["validation_mean_target"], std, r["validation_std_target"], features, features,
                100.0 * (rows_all - r["validation_size"]) / rows_all,
                100.0 * r["validation_size"] / rows_all,
            )
        )
    return df.sparkSession.createDataFrame(
        out,
        "fold int, train_size bigint, validation_size bigint, train_mean_target double,"
        " validation_mean_target double, train_std_target double, validation_std_target double,"
        " train_features int, validation_features int, train_percentage double,"
        " validation_percentage double",
    )


def fold_size_stats(summary: DataFrame) -> DataFrame:
    cols = ["train_size", "validation_size"]
    return summary.agg(
        *[f(c).alias(f"{name}_{c}") for c in cols for name, f in
          (("min", F.min), ("max", F.max), ("mean", F.avg))]
    )
