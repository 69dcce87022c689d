"""Outlier bounds, flags, clipping and removal."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.expressions import clip, flag
from gramlark.functions.quantiles import quantile_map
from gramlark.operators.forest import IsolationScorer
from gramlark.schema import TARGET, numeric_columns
from gramlark.session import is_staged, stage

METHODS = ("iqr", "zscore", "isolation_forest")
ACTIONS = ("clip", "mark", "remove")


@dataclass
class Bounds:
    """Detection limits and clip limits of one column."""

    lo: float
    hi: float
    clip_lo: float
    clip_hi: float


def iqr_bounds(df: DataFrame, columns: list[str], threshold: float = 1.5) -> dict[str, Bounds]:
    out = {}
    for c, (q1, q3) in quantile_map(df, columns, [0.25, 0.75]).items():
        lo, hi = q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)
        out[c] = Bounds(lo, hi, lo, hi)
    return out


def zscore_bounds(df: DataFrame, columns: list[str], threshold: float = 1.5) -> dict[str, Bounds]:
    """Detection by the population deviation, clipping by the sample deviation."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [
            F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"p{i}"), F.stddev_samp(c).alias(f"s{i}")
        ]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        m, p, s = row[f"m{i}"], row[f"p{i}"], row[f"s{i}"]
        if m is None or s is None:
            continue
        if p == 0:
            # every score is undefined: nothing is an outlier
            out[c] = Bounds(float("-inf"), float("inf"), float("-inf"), float("inf"))
        else:
            out[c] = Bounds(m - threshold * p, m + threshold * p, m - threshold * s, m + threshold * s)
    return out


def outlier_bounds(df, columns, method="iqr", threshold=1.5) -> dict[str, Bounds]:
    if method == "iqr":
        return iqr_bounds(df, columns, threshold)
    if method == "zscore":
        return zscore_bounds(df, columns, threshold)
    raise ValueError(f"no bounds for method {method}")


def outside(column: str, b: Bounds):
    c = F.col(column)
    return F.coalesce((c < F.lit(b.lo)) | (c > F.lit(b.hi)), F.lit(False))


def outlier_report(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Count, percentage and limits of the outliers per column."""
    cols = list(bounds)
    one = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(outside(c, bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"o{i}").alias("outliers"),
            F.try_divide(F.col(f"o{i}") * 100.0, F.col("rows")).alias("percent"),
            F.lit(bounds[c].lo).alias("lower"),
            F.lit(bounds[c].hi).alias("upper"),
        )
        for i, c in enumerate(cols)
    ]
    return one.select(F.inline(F.array(*entries)))


def clip_outliers(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    return df.withColumns(
        {c: clip(F.col(c).cast("double"), b.clip_lo, b.clip_hi) for c, b in bounds.items()}
    )


def mark_outliers(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    return df.withColumns({f"{c}_is_outlier": flag(outside(c, b)) for c, b in bounds.items()})


def remove_outliers(
    df: DataFrame, columns: list[str], method: str = "iqr", threshold: float = 1.5
) -> DataFrame:
    """Drop outliers column by column; later columns see the rows that are left.

    The limits of a column depend on the rows kept so far, so there is one
    aggregate job per column.  The input is staged once and every step is a
    filter with known limits on top of it.
    """
    kept = df if is_staged(df) else stage(df, "remove-outliers")
    for c in columns:
        if method == "isolation_forest":
            kept = IsolationScorer.fit(kept, c).remove(kept)
            continue
        b = outlier_bounds(kept, [c], method, threshold)
        if c in b:
            kept = kept.where(~outside(c, b[c]))
    return kept


def handle_outliers(
    df: DataFrame,
    method: str = "iqr",
    action: str = "clip",
    threshold: float = 1.5,
    columns: list[str] | None = None,
    target: str = TARGET,
) -> DataFrame:
    """Detect outliers and clip, mark or remove them.

    Isolation forests know no clip limits, so ``clip`` leaves their columns
    alone.  ``mark`` adds a flag column only where something was found.
    """
    if method not in METHODS or action not in ACTIONS:
        raise ValueError(f"unknown method or action: {method}, {action}")
    columns = columns or numeric_columns(df, exclude=(target,))
    if action == "remove":
        return remove_outliers(df, columns, method, threshold)
    if method == "isolation_forest":
        if action == "clip":
            warnings.warn("isolation_forest has no limits to clip to", stacklevel=2)
            return df
        for c in columns:
            scorer = IsolationScorer.fit(df, c)
            if not scorer.with_score(df.select(c)).where(F.col("_score") > scorer.cut).isEmpty():
                df = scorer.mark(df)
        return df
    bounds = outlier_bounds(df, columns, method, threshold)
    if action == "clip":
        return clip_outliers(df, bounds)
    found = {
        r["column"] for r in outlier_report(df, bounds).where("outliers > 0").collect()
    } if bounds else set()
    return mark_outliers(df, {c: b for c, b in bounds.items() if c in found})
