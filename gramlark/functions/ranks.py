"""Global positions and ranks without a single-task sort.

A global window function would pull every row into one task.  Here rows are
range-partitioned, the partition number is written down with them (so later
passes agree on it whatever happens to executors), partition sizes are turned
into offsets, and only then is counted inside each partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.session import stage

# up to this many distinct values a plain window is cheaper than range partitions
SMALL_VALUES = 100_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_offsets(staged: DataFrame, by: list[str], measures: dict) -> DataFrame:
    """Join per-(group, part) running totals of ``measures`` onto the rows."""
    totals = staged.groupBy(*by, "part").agg(*[m.alias(k) for k, m in measures.items()])
    before = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in measures]
    )
    if not by:
        # one row per partition of the range shuffle
        offsets = F.broadcast(offsets)
    return staged.join(offsets, [*by, "part"])


def row_positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based position of every row in the total order given by ``order``."""
    staged = stage(
        df.repartitionByRange(_partitions(df), *order).withColumn("part", F.spark_partition_id()),
        "positions",
    )
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return (
        _with_offsets(staged, [], {"_off": F.count("*")})
        .withColumn(name, (F.col("_off") + inside - 1).cast("bigint"))
        .drop("part", "_off")
    )


def value_ranks(df: DataFrame, value: str = "v", by: list[str] = ()) -> DataFrame:
    """Distinct values of each group with their counts and ranks.

    Columns: ``by...``, value, ``cnt``, ``before`` (rows with a smaller value),
    ``dense`` (0-based rank among distinct values) and ``avg_rank`` (1-based
    rank with ties averaged).  NULL values are left out.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("cnt"))
    counts = stage(counts, "value-counts")
    if counts.count() <= SMALL_VALUES:
        order = W.partitionBy(*by).orderBy(value)
        prior = order.rowsBetween(W.unboundedPreceding, -1)
        return _finish(counts.withColumns({"_rows": F.lit(0), "_vals": F.lit(0)}), by, value, order, prior)
    staged = stage(
        counts.repartitionByRange(_partitions(df), *by, value).withColumn(
            "part", F.spark_partition_id()
        ),
        "value-ranks",
    )
    order = W.partitionBy(*by, "part").orderBy(value)
    prior = order.rowsBetween(W.unboundedPreceding, -1)
    ranked = _with_offsets(staged, by, {"_rows": F.sum("cnt"), "_vals": F.count("*")})
    return _finish(ranked, by, value, order, prior)


def _finish(ranked, by, value, order, prior) -> DataFrame:
    smaller = F.coalesce(F.sum("cnt").over(prior), F.lit(0))
    return (
        ranked.withColumn("before", (F.col("_rows") + smaller).cast("bigint"))
        .withColumn("dense", (F.col("_vals") + F.row_number().over(order) - 1).cast("bigint"))
        .withColumn("avg_rank", F.col("before") + (F.col("cnt") + 1) / F.lit(2.0))
        .select(*by, value, "cnt", "before", "dense", "avg_rank")
    )
