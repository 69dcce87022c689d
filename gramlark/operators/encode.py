"""Encoders for text columns: one-hot, target mean and frequency."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import attach
from gramlark.schema import TARGET, string_columns

METHODS = ("onehot", "target", "frequency")
# a one-hot encoding is one column per category, so the list has to stay small
MAX_ONEHOT = 2_000


def category_list(df: DataFrame, column: str, limit: int = MAX_ONEHOT) -> list[str]:
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(
            f"{column} has over {limit} categories; use target or frequency encoding"
        )
    return sorted(r[0] for r in rows)


def target_means(df: DataFrame, column: str, target: str = TARGET) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.avg(target).alias(f"{column}_target_encoded"))
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("c"))
    total = counts.agg(F.sum("c")).scalar()
    return counts.select(column, (F.col("c") / total).alias(f"{column}_frequency_encoded"))


def onehot_columns(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """0/1 column per category; NULL and unseen values give zeros everywhere."""
    hot = {
        f"{column}_{v}": F.when(F.col(column) == F.lit(v), 1.0).otherwise(0.0) for v in categories
    }
    return df.withColumns(hot).drop(column) if hot else df.drop(column)


@dataclass
class Encoder:
    method: str = "onehot"
    target: str = TARGET
    columns: list[str] = field(default_factory=list)
    categories: dict[str, list[str]] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> "Encoder":
        if self.method not in METHODS:
            raise ValueError(f"unknown method: {self.method}")
        self.columns = columns or string_columns(df)
        for c in self.columns:
            if self.method == "onehot":
                self.categories[c] = category_list(df, c)
            elif self.method == "frequency":
                self.tables[c] = frequencies(df, c)
            elif self.target in df.columns:
                self.tables[c] = target_means(df, c, self.target)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            if c in self.categories:
                df = onehot_columns(df, c, self.categories[c])
            elif c in self.tables:
                df = attach(df, self.tables[c], c).drop(c)
        return df
