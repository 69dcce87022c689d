"""Fitted models as rows of a table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.operators.linear import LinearModel

MODEL_SCHEMA = (
    "model string, ts timestamp, fold int, coefficients array<double>, intercept double,"
    " feature_names array<string>, hyper map<string,double>, metrics map<string,double>"
)

# Thresholds of the coefficient statistics.
ZERO, SMALL = 1e-10, 1e-3


def model_rows(
    spark: SparkSession,
    models: list[tuple[LinearModel, int | None, dict[str, float], datetime]],
) -> DataFrame:
    rows = [
        (
            m.name, ts, fold, [float(c) for c in m.coef], float(m.intercept), list(m.features),
            {k: float(v) for k, v in m.hyper.items()}, {k: float(v) for k, v in metrics.items()},
        )
        for m, fold, metrics, ts in models
    ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def save_models(models: DataFrame, path: str) -> None:
    models.write.mode("append").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def model_key(model: Column, hyper: Column) -> Column:
    """Key of a fit by its parameters: ``name_a.._lr.._i..``."""
    part = lambda tag, name: F.concat(F.lit(tag), F.coalesce(hyper[name].cast("string"), F.lit("-")))
    return F.concat_ws(
        "_", model, part("a", "alpha"), part("lr", "learning_rate"), part("i", "max_iter")
    )


def latest(models: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Newest row per key."""
    fields = [c for c in models.columns if c not in by]
    return (
        models.groupBy(*by)
        .agg(F.max_by(F.struct(*fields), "ts").alias("r"))
        .select(*by, "r.*")
    )


def at_time(models: DataFrame, model: str, ts) -> DataFrame:
    return models.where((F.col("model") == model) & (F.col("ts") == F.lit(ts)))


def listing_by_age(models: DataFrame) -> DataFrame:
    return models.select("model", "ts", "fold", F.col("metrics")["r2"].alias("r2")).orderBy(F.desc("ts"))


def coefficient_rows(models: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    weights = F.arrays_zip("feature_names", "coefficients")
    return models.select(*by, F.posexplode(weights).alias("position", "w")).select(
        *by, "position", F.col("w.feature_names").alias("feature"), F.col("w.coefficients").alias("weight")
    )


def coefficient_stats(rows: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Spread, norm, quartiles and sparsity of the weights of each model."""
    w = F.col("weight")
    q = F.percentile(w, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    share = lambda limit: F.avg(F.when(F.abs(w) < limit, 100.0).otherwise(0.0))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.min(w).alias("min"), F.max(w).alias("max"),
        F.avg(w).alias("mean"), F.stddev_pop(w).alias("std"), F.sqrt(F.sum(w * w)).alias("l2_norm"),
        q[0].alias("q1"), q[1].alias("q2"), q[2].alias("q3"),
        F.count_if(F.abs(w) < ZERO).alias("zeros"), share(ZERO).alias("zero_percent"),
        F.count_if(F.abs(w) < SMALL).alias("small"), share(SMALL).alias("small_percent"),
    )


def first_and_last(rows: DataFrame, n: int = 10, by: list[str] = ("model",)) -> DataFrame:
    """The first and last n weights of each model, all if there are at most 2n."""
    size = F.count("*").over(W.partitionBy(*by))
    return (
        rows.withColumn("_size", size)
        .where((F.col("position") < n) | (F.col("position") >= F.col("_size") - n))
        .drop("_size")
    )


def final_losses(history: DataFrame) -> DataFrame:
    """Last training and validation loss and the number of epochs per model."""
    return history.groupBy("model").agg(
        F.max_by("loss", "epoch").alias("final_loss"),
        F.max_by("val_loss", "epoch").alias("final_val_loss"),
        F.count("*").alias("epochs"),
    )
