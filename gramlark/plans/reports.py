"""Report content as rows ``(section, key, value)`` (value is text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.operators.evaluate import all_metrics, assessment, metrics_summary
from gramlark.operators.outliers import iqr_bounds, outlier_report
from gramlark.operators.profile import (
    basic_info, describe, duplicate_rows, null_counts, total_nulls, value_counts,
)
from gramlark.schema import TARGET, numeric_columns, string_columns

NUMBER = "%.4f"


def _rows(df: DataFrame, section: str, key, values: dict) -> DataFrame:
    """One report row per entry of ``values`` and input row."""
    entries = [
        F.struct(
            F.lit(section).alias("section"),
            F.concat_ws(".", key, F.lit(name)).alias("key"),
            F.when(col.isNotNull(), col.cast("string")).alias("value"),
        )
        for name, col in values.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def exploration_report(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Shape, types, nulls, statistics and categories of a table."""
    fmt = lambda c: F.format_string(NUMBER, F.col(c))
    parts = [
        _rows(basic_info(df), "columns", F.col("column"),
              {"type": F.col("data_type"), "non_null": F.col("non_null")}),
        _rows(total_nulls(df), "shape", F.lit("table"),
              {"rows": F.col("rows"), "nulls": F.col("nulls")}),
        _rows(describe(df), "statistics", F.col("column"),
              {c: fmt(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")}),
    ]
    if string_columns(df):
        parts.append(
            _rows(value_counts(df), "categories", F.concat_ws(".", "column", "category"),
                  {"count": F.col("count")})
        )
    return _union(parts)


def preprocessing_requirements(df: DataFrame, target: str = TARGET, threshold: float = 1.5) -> DataFrame:
    """What a table needs: nulls, types, outliers and quality."""
    columns = numeric_columns(df, exclude=(target,))
    types = df.sparkSession.createDataFrame(
        [(c, "numerical") for c in numeric_columns(df)] + [(c, "categorical") for c in string_columns(df)],
        "column string, kind string",
    )
    two = lambda c: F.format_string("%.2f", F.col(c))
    return _union(
        [
            _rows(null_counts(df), "missing_values", F.col("column"),
                  {"count": F.col("nulls"), "percent": two("percent")}),
            _rows(types, "features", F.col("column"), {"kind": F.col("kind")}),
            _rows(outlier_report(df, iqr_bounds(df, columns, threshold)), "outliers", F.col("column"),
                  {"count": F.col("outliers"), "percent": two("percent"),
                   "lower": two("lower"), "upper": two("upper")}),
            _rows(duplicate_rows(df), "data_quality", F.lit("table"),
                  {"rows": F.col("rows"), "duplicates": F.col("duplicates")}),
        ]
    )


def feature_report(flow, before: DataFrame, after: DataFrame) -> DataFrame:
    """Settings, columns and statistics of a fitted feature flow."""
    spark = before.sparkSession
    facts = [
        ("overview", "original_columns", str(len(before.columns))),
        ("overview", "transformed_columns", str(len(after.columns))),
        ("missing_values", "strategy", flow.impute),
        ("missing_values", "indicators", str(flow.indicators)),
        ("outliers", "method", flow.outlier_method),
        ("outliers", "threshold", str(flow.outlier_threshold)),
        ("selection", "method", str(flow.selection)),
        ("selection", "k_best", str(flow.k_best)),
    ] + [("selected", f"{i:03d}", c) for i, c in enumerate(flow.selected)]
    table = spark.createDataFrame(facts, "section string, key string, value string")
    fmt = lambda c: F.format_string(NUMBER, F.col(c))
    stats = _rows(describe(after, numeric_columns(after)), "statistics", F.col("column"),
                  {c: fmt(c) for c in ("mean", "std", "min", "max")})
    return table.unionByName(stats)


def model_report(df: DataFrame, truth, prediction) -> DataFrame:
    """Formatted metrics and quality bands of one set of predictions."""
    metrics = all_metrics(df, truth, prediction)
    bands = assessment(metrics)
    labels = ["explanatory_power", "accuracy", "needs_features", "needs_accuracy",
              "high_variability", "ready"]
    return _union(
        [
            metrics_summary(metrics).select(
                F.lit("metrics").alias("section"), F.col("metric").alias("key"), "value"
            ),
            bands.select(
                F.inline(F.array(*[
                    F.struct(F.lit("assessment").alias("section"), F.lit(c).alias("key"),
                             F.col(c).cast("string").alias("value"))
                    for c in labels
                ]))
            ),
        ]
    )


def selection_report(ranking: DataFrame) -> DataFrame:
    """Ranked models as report rows."""
    return _rows(ranking, "ranking", F.format_string("%02d", F.col("rank")),
                 {"model": F.col("model"), "val_r2": F.format_string("%.4f", F.col("val_r2")),
                  "val_rmse": F.format_string("%.2f", F.col("val_rmse"))})
