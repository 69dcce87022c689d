"""Missing values: indicators and imputation by mean, median, group median or
nearest neighbours.  Numeric columns only; text columns are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import attach, flag
from gramlark.functions.quantiles import exact_quantiles, quantile_map
from gramlark.operators.knn import knn_impute
from gramlark.schema import CATEGORY, numeric_columns
from gramlark.session import as_staged, is_staged, stage

STRATEGIES = ("mean", "median", "grouped_median", "knn")


def columns_with_nulls(df: DataFrame, columns: list[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"n{i}"] > 0]


def add_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_is_missing": flag(F.col(c).isNull()) for c in columns})


def group_medians(df: DataFrame, columns: list[str], group: str) -> DataFrame:
    """One row per non-null group with ``<column>_fill`` medians."""
    q = exact_quantiles(df, columns, [0.5], by=[group])
    return q.groupBy(group).agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"{c}_fill") for c in columns]
    )


@dataclass
class Imputer:
    """Fitted fills.  ``fills`` are global values; ``groups`` per-group medians;
    ``donors`` the rows and columns a nearest-neighbour fill searches."""

    strategy: str = "grouped_median"
    group: str = CATEGORY
    indicators: bool = True
    columns: list[str] = field(default_factory=list)
    fills: dict[str, float] = field(default_factory=dict)
    groups: DataFrame | None = None
    donors: DataFrame | None = None

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> "Imputer":
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {self.strategy}")
        known = columns or numeric_columns(df)
        self.columns = columns_with_nulls(df, known)
        if not self.columns:
            return self
        if self.strategy == "knn":
            self.donors = as_staged(df.select(known), df)
            if not is_staged(df):
                self.donors = stage(self.donors, "donors", lean=True)
        elif self.strategy == "mean":
            row = df.agg(*[F.avg(c).alias(c) for c in self.columns]).first()
            self.fills = {c: row[c] for c in self.columns if row[c] is not None}
        else:
            q = quantile_map(df, self.columns, [0.5])
            self.fills = {c: v[0] for c, v in q.items()}
        if self.strategy == "grouped_median" and self.group in df.columns:
            self.groups = group_medians(df, self.columns, self.group)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill with the stored values, or from the stored donors."""
        if not self.columns:
            return df
        order = df.columns
        out = add_indicators(df, self.columns) if self.indicators else df
        if self.strategy == "knn":
            return knn_impute(as_staged(out, df), self.donors.columns, self.columns, donors=self.donors)
        if self.groups is not None:
            out = attach(out, self.groups, self.group)
        fill = {}
        for c in self.columns:
            candidates = [F.col(c)]
            if self.groups is not None:
                candidates.append(F.col(f"{c}_fill"))
            if c in self.fills:
                candidates.append(F.lit(float(self.fills[c])))
            fill[c] = F.coalesce(*candidates)
        out = out.withColumns(fill)
        extra = [f"{c}_is_missing" for c in self.columns] if self.indicators else []
        return out.select(*order, *extra)


def handle_missing(
    df: DataFrame, strategy: str = "grouped_median", indicators: bool = True, group: str = CATEGORY
) -> DataFrame:
    return Imputer(strategy, group, indicators).fit(df).transform(df)
