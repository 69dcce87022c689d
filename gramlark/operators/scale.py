"""Standard, robust and min-max scaling with literal parameters.

``(value - center) / scale`` per column.  A column without spread has scale 1,
so it becomes 0 everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.quantiles import quantile_map, to_long
from gramlark.schema import TARGET, numeric_columns

METHODS = ("standard", "robust", "minmax")


@dataclass
class Scaler:
    method: str = "standard"
    exclude: tuple[str, ...] = (TARGET,)
    params: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> "Scaler":
        columns = columns or numeric_columns(df, exclude=self.exclude)
        if not columns:
            return self
        method = self.method if self.method in METHODS else "standard"
        if method == "robust":
            q = quantile_map(df, columns, [0.25, 0.5, 0.75])
            self.params = {c: (v[1], (v[2] - v[0]) or 1.0) for c, v in q.items()}
            return self
        a, b = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
        # one row per column and value: wide aggregates compile to very large methods
        rows = to_long(df, columns).groupBy("column").agg(a("v").alias("a"), b("v").alias("b"))
        found = {r["column"]: (r["a"], r["b"]) for r in rows.collect()}
        for c in columns:
            first, second = found.get(c, (None, None))
            if first is None:
                continue
            spread = second if method == "standard" else second - first
            self.params[c] = (first, spread or 1.0)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))
            for c, (m, s) in self.params.items()
            if c in df.columns
        }
        return df.withColumns(scaled) if scaled else df


def add_bias(df: DataFrame, name: str = "bias") -> DataFrame:
    return df.select(F.lit(1.0).alias(name), *df.columns)
