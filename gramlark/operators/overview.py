"""A table's overview in one scan, or in the scan that writes it.

Counts, moments and mergeable sketches are all plain aggregates, so they share
one pass: sketches of distinct values and of quantiles have a fixed size and are
merged like sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gramlark.operators.profile import unpivot_row
from gramlark.schema import TARGET, column_roles, numeric_columns

PARTS = ["nulls", "distinct", "infinite", "mean", "std", "min", "max", "q25", "q50", "q75"]


def overview_aggregates(df: DataFrame) -> list[Column]:
    """One aggregate per figure, named ``figure_column number``; ``rows`` and ``distinct_rows`` are the table's."""
    out = [F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.xxhash64(*df.columns), 14).alias("distinct_rows")]
    numeric = set(numeric_columns(df))
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        out += [F.count_if(v.isNull()).alias(f"nulls_{i}")]
        if c in numeric:
            x = v.cast("double")
            finite = F.when(F.abs(x) < float("inf"), x)
            out += [
                F.hll_sketch_agg(F.xxhash64(v), 14).alias(f"distinct_{i}"),
                F.count_if(F.abs(x) == float("inf")).alias(f"infinite_{i}"),
                F.avg(x).alias(f"mean_{i}"),
                F.stddev_samp(x).alias(f"std_{i}"),
                F.min(x).alias(f"min_{i}"),
                F.max(x).alias(f"max_{i}"),
                F.kll_sketch_agg_double(finite, F.lit(400)).alias(f"quantiles_{i}"),
            ]
        else:
            out += [F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), 14).alias(f"distinct_{i}")]
    return out


def overview_rows(aggregated: DataFrame, df: DataFrame, target: str = TARGET) -> DataFrame:
    """``(column, type, role, rows, ...)`` from the one row of ``overview_aggregates``, and a row ``*`` for the table.

    ``distinct`` and ``q25`` to ``q75`` are read from sketches (about 1 % and half
    a percent of rank off); ``infinite`` and what follows are null for columns that
    aren't numbers.  The table's row counts duplicates in ``nulls``' place: later
    copies of equal rows, estimated.
    """
    numeric, roles = set(numeric_columns(df)), column_roles(df, target)
    role = {c: name for name, columns in roles.items() for c in columns}
    stats, extra = {}, []
    for i, f in enumerate(df.schema.fields):
        for p in PARTS:
            source = F.col(f"{p}_{i}") if p in ("nulls",) or f.name in numeric else F.lit(None).cast("double")
            if p == "distinct":
                estimate = F.hll_sketch_estimate(f"distinct_{i}")
                # a sketch counts a null's hash too
                source = estimate - (F.col(f"nulls_{i}") > 0).cast("int") if f.name in numeric else estimate
            if p.startswith("q") and f.name in numeric:
                some = F.col("rows") > F.col(f"nulls_{i}") + F.col(f"infinite_{i}")
                source = F.when(some, F.kll_sketch_get_quantile_double(f"quantiles_{i}", F.lit(int(p[1:]) / 100)))
            extra.append(source.cast("double" if p not in ("nulls", "distinct", "infinite") else "long").alias(f"{p}{i}"))
        extra += [F.lit(f.dataType.simpleString()).alias(f"type{i}"), F.lit(role.get(f.name, "other")).alias(f"role{i}")]
        stats[f.name] = {"type": f"type{i}", "role": f"role{i}", "rows": "rows"} | {p: f"{p}{i}" for p in PARTS}
    whole = F.hll_sketch_estimate("distinct_rows")
    extra += [F.lit("table").alias("kind"), (F.col("rows") - F.least("rows", whole)).alias("copies"), whole.alias("whole")]
    extra += [F.lit(None).cast("long").alias("no_long"), F.lit(None).cast("double").alias("no_double")]
    stats["*"] = {"type": "kind", "role": "kind", "rows": "rows", "nulls": "copies", "distinct": "whole", "infinite": "no_long"}
    stats["*"] |= {p: "no_double" for p in PARTS[3:]}
    return unpivot_row(aggregated.select("rows", *extra), stats)


def overview(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The overview of ``df`` in one scan."""
    return overview_rows(df.agg(*overview_aggregates(df)), df, target)


def write_with_overview(df: DataFrame, path: str, target: str = TARGET) -> DataFrame:
    """Write ``df`` to ``path`` and get its overview from that same pass."""
    seen = Observation("overview")
    df.observe(seen, *overview_aggregates(df)).write.parquet(path)
    got = seen.get
    fields = df.agg(*overview_aggregates(df)).schema  # the plan only, nothing runs
    one = df.sparkSession.createDataFrame([tuple(got[f.name] for f in fields)], fields)
    return overview_rows(one, df, target)
