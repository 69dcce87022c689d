"""Column-expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.session import stage

LOOKUP_ROWS = 10_000


def flag(predicate: Column) -> Column:
    """0/1 integer; an unknown predicate counts as false."""
    return F.when(predicate, 1).otherwise(0)


def clip(value: Column, lo: float, hi: float) -> Column:
    """Value limited to [lo, hi]; NULL stays NULL."""
    return (
        F.when(value < F.lit(float(lo)), F.lit(float(lo)))
        .when(value > F.lit(float(hi)), F.lit(float(hi)))
        .otherwise(value)
    )


def title_case(name: Column) -> Column:
    """``ridge_regression`` -> ``Ridge Regression``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def hashed_bucket(key: Column, buckets: Column) -> Column:
    """Bucket number 0..buckets-1 for spreading rows over salted groups."""
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def attach(df: DataFrame, table: DataFrame, on: list[str] | str) -> DataFrame:
    """Left-join a per-key table, which is computed and written once.

    The table is broadcast only after counting that it has at most
    ``LOOKUP_ROWS`` rows; a larger one is joined by a shuffle.
    """
    table = stage(table, "lookup")
    rows = table.limit(LOOKUP_ROWS + 1).collect()
    if len(rows) <= LOOKUP_ROWS:
        small = df.sparkSession.createDataFrame(rows, table.schema)
        return df.join(F.broadcast(small), on, "left")
    return df.join(table, on, "left")


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.withColumns(new) if new else df
