"""Rankings and comparison tables over model metrics (a few rows per model)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.functions.expressions import title_case


def rank_models(summary: DataFrame) -> DataFrame:
    """Models by mean validation r2, best first."""
    val = summary.where(F.col("side") == "validation")
    order = W.orderBy(F.desc("r2"), "model")
    return val.select(
        F.row_number().over(order).alias("rank"), "model",
        F.col("r2").alias("val_r2"), F.col("rmse").alias("val_rmse"), F.col("mae").alias("val_mae"),
    )


def ranking_summary(ranking: DataFrame) -> DataFrame:
    return ranking.agg(
        F.min_by("model", "rank").alias("best_model"),
        F.count("*").alias("total_models"),
        F.min_by("val_r2", "rank").alias("best_r2"),
        F.min_by("val_rmse", "rank").alias("best_rmse"),
        F.avg("val_r2").alias("avg_r2"),
        F.avg("val_rmse").alias("avg_rmse"),
    )


def comparison_table(summary: DataFrame) -> DataFrame:
    """``mean ± deviation`` texts, ranked by the number rather than the text."""
    val = summary.where(F.col("side") == "validation")

    def text(metric, digits):
        return F.format_string(f"%.{digits}f ± %.{digits}f", F.col(metric), F.col(f"{metric}_std"))

    return val.select(
        F.row_number().over(W.orderBy(F.desc("r2"), "model")).alias("rank"),
        title_case(F.col("model")).alias("model"),
        text("r2", 4).alias("r2"),
        text("mse", 2).alias("mse"),
        text("mae", 2).alias("mae"),
        text("rmse", 2).alias("rmse"),
        F.format_string("%.2f%%", F.col("mape")).alias("mape"),
    )


def rank_by_criteria(
    summary: DataFrame, criteria: list[str] = ("r2", "mae", "rmse"), weights: list[float] | None = None
) -> DataFrame:
    """Weighted score: r2 as it is, errors as 1 / (1 + error)."""
    weights = weights or [1.0] * len(criteria)
    score = F.lit(0.0)
    for c, w in zip(criteria, weights):
        part = F.col(c) if c == "r2" else 1 / (1 + F.col(c))
        score = score + part * F.lit(float(w))
    val = summary.where(F.col("side") == "validation").withColumn("score", score)
    return val.select(
        F.row_number().over(W.orderBy(F.desc("score"), "model")).alias("rank"), "model", "score"
    )


def best_models(summary: DataFrame, n: int = 3) -> DataFrame:
    return rank_models(summary).where(F.col("rank") <= n)


def model_bars(summary: DataFrame) -> DataFrame:
    """Chart rows: mean and deviation per model, side and metric."""
    metrics = ["mse", "mae", "r2", "rmse"]
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean"), F.col(f"{m}_std").alias("std"))
        for m in metrics
    ]
    return summary.select(
        title_case(F.col("model")).alias("model"), "side", F.inline(F.array(*entries))
    )


def candidate_rows(summary: DataFrame, configs: dict[str, dict[str, str]], n: int = 3, at=None) -> DataFrame:
    """The n best models with what is needed to fit them again: score, description, parameters, time of choice.

    ``configs`` maps a model to its parameters and a ``description``; it is as
    long as the list of models, not as the data.
    """
    at = F.current_timestamp() if at is None else F.lit(at)
    known = [F.struct(F.lit(m).alias("model"), _config(c).alias("config"), F.lit(c.get("description", "")).alias("description")) for m, c in configs.items()]
    none = F.struct(F.lit("").alias("model"), _config({}).alias("config"), F.lit("").alias("description"))
    found = F.coalesce(F.try_element_at(F.filter(F.array(none, *known), lambda k: k["model"] == F.col("model")), F.lit(-1)), none)
    top = best_models(summary, n).withColumn("known", found)
    return top.select(
        "rank",
        "model",
        F.col("val_r2").alias("avg_r2"),
        F.col("known.description").alias("description"),
        F.col("known.config").alias("config"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("selection_date"),
    )


def _config(parameters: dict[str, str]):
    given = {k: str(v) for k, v in sorted(parameters.items()) if k != "description"}
    pairs = [F.lit(x) for kv in given.items() for x in kv]
    return (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
