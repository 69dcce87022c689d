"""Box-Cox power transforms of positive columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# exponents are whole hundredths; each pass looks at the best one so far and the steps around it
LOW, HIGH, STEPS = -200, 300, (50, 10, 1)


def box_cox(value: Column, exponent: float) -> Column:
    return F.ln(value) if exponent == 0.0 else (F.pow(value, F.lit(exponent)) - 1.0) / F.lit(exponent)


def box_cox_inverse(value: Column, exponent: float) -> Column:
    """The value that ``box_cox`` was made from; NULL where there is none."""
    if exponent == 0.0:
        return F.exp(value)
    base = value * F.lit(exponent) + 1.0
    return F.when(base > 0.0, F.pow(base, F.lit(1.0 / exponent)))


@dataclass
class PowerTransform:
    exponents: dict[str, float]
    scores: dict[str, float]  # profile log-likelihood per row, up to a constant of the column

    def transform(self, df: DataFrame) -> DataFrame:
        """The columns transformed in place; a value at or below zero becomes NULL."""
        made = {c: box_cox(F.when(F.col(c) > 0.0, F.col(c)), e) for c, e in self.exponents.items()}
        return df.withColumns(made)

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: box_cox_inverse(F.col(c), e) for c, e in self.exponents.items()})

    def rows(self, spark: SparkSession) -> DataFrame:
        out = [(c, e, self.scores[c]) for c, e in self.exponents.items()]
        return spark.createDataFrame(out, "column string, exponent double, score double")


def fit_box_cox(df: DataFrame, columns: list[str]) -> PowerTransform:
    """The exponent between -2 and 3, to hundredths, under which each column is most nearly normal.

    The likelihood has one peak, so it is bracketed: every pass is one aggregate
    with all exponents of all columns.  Values are taken relative to their
    geometric mean, which leaves the variance alone to compare.  NULL is left
    out; a value at or below zero is an error, as are columns without two
    different values.
    """
    aggs = [F.struct(F.min(c), F.max(c), F.avg(F.ln(F.col(c)))).alias(f"c{i}") for i, c in enumerate(columns)]
    first = df.agg(*aggs).first()
    centre = {}
    for c, (low, high, mean) in zip(columns, first):
        if low is None or low == high:
            raise ValueError(f"{c} has fewer than two different values")
        if low <= 0.0:
            raise ValueError(f"{c} has values at or below zero")
        centre[c] = mean
    best, scores = {}, {}
    for step in STEPS:
        tried = {}
        for c in columns:
            around = best.get(c)
            lo, hi = (LOW, HIGH) if around is None else (max(LOW, around - last), min(HIGH, around + last))
            tried[c] = list(range(lo, hi + 1, step))
        aggs = []
        for i, c in enumerate(columns):
            log = F.ln(F.col(c)) - F.lit(centre[c])
            made = [log if k == 0 else F.exp(log * F.lit(k / 100)) / F.lit(k / 100) for k in tried[c]]
            aggs.append(F.array(*[F.var_pop(m) for m in made]).alias(f"c{i}"))
        for c, variances in zip(columns, df.agg(*aggs).first()):
            score = [-0.5 * math.log(v) for v in variances]
            place = max(range(len(score)), key=score.__getitem__)
            best[c], scores[c] = tried[c][place], score[place]
        last = step
    return PowerTransform({c: best[c] / 100 for c in columns}, scores)
