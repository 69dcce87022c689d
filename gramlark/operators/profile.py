"""Table profiles: describe, null, duplicate, distinct and infinity counts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.quantiles import exact_quantiles
from gramlark.schema import TARGET, numeric_columns, string_columns


def unpivot_row(row_df: DataFrame, stats: dict[str, dict[str, str]], key: str = "column") -> DataFrame:
    """Turn a one-row aggregate into one row per key.

    ``stats`` maps each key to ``{output column: aggregate column}``.
    """
    entries = [
        F.struct(F.lit(k).alias(key), *[F.col(src).alias(out) for out, src in cols.items()])
        for k, cols in stats.items()
    ]
    return row_df.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per numeric column."""
    columns = columns or numeric_columns(df)
    aggs, stats = [], {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        parts = {
            "count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v),
            "min": F.min(v), "max": F.max(v),
        }
        aggs += [a.alias(f"{k}_{i}") for k, a in parts.items()]
        stats[c] = {k: f"{k}_{i}" for k in parts}
    basic = unpivot_row(df.agg(*aggs), stats)
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"),
    )
    return basic.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per category of each text column, with the share of non-null rows."""
    columns = columns or string_columns(df)
    counts = (
        df.select(columns)
        .unpivot([], columns, "column", "category")
        .where("category IS NOT NULL")
        .groupBy("column", "category")
        .agg(F.count("*").alias("count"))
    )
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    return counts.join(totals, "column").select(
        "column", "category", "count", (F.col("count") / F.col("total")).alias("share")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULL rows and their percentage per column."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    stats = {c: {"nulls": f"n_{i}", "rows": "rows"} for i, c in enumerate(df.columns)}
    out = unpivot_row(df.agg(F.count("*").alias("rows"), *aggs), stats)
    percent = F.coalesce(F.try_divide(F.col("nulls") * 100.0, F.col("rows")), F.lit(0.0))
    return out.select("column", "nulls", percent.alias("percent"))


def total_nulls(df: DataFrame) -> DataFrame:
    cells = [flag_sum(c) for c in df.columns]
    return df.agg(F.count("*").alias("rows"), sum(cells[1:], cells[0]).alias("nulls"))


def flag_sum(column: str):
    return F.count_if(F.col(column).isNull())


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Later copies of equal rows: count and percentage."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("c"))
    out = copies.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicates"),
    )
    return out.withColumn(
        "percent", F.coalesce(F.try_divide(F.col("duplicates") * 100.0, F.col("rows")), F.lit(0.0))
    )


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [count(F.col(c)).alias(f"d_{i}") for i, c in enumerate(df.columns)]
    return unpivot_row(
        df.agg(*aggs), {c: {"distinct_values": f"d_{i}"} for i, c in enumerate(df.columns)}
    )


def infinite_counts(df: DataFrame) -> DataFrame:
    columns = numeric_columns(df)
    aggs = [
        F.count_if(F.abs(F.col(c).cast("double")) == F.lit(math.inf)).alias(f"i_{i}")
        for i, c in enumerate(columns)
    ]
    return unpivot_row(df.agg(*aggs), {c: {"infinities": f"i_{i}"} for i, c in enumerate(columns)})


def basic_info(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, non-null values."""
    aggs = [F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("rows"),
            F.col(f"n_{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return one.select(F.inline(F.array(*entries)))


def target_profile(df: DataFrame, target: str = TARGET) -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"no column {target}")
    d = describe(df.select(target))
    missing = df.agg(
        F.lit(target).alias("column"), F.count("*").alias("rows"), flag_sum(target).alias("missing")
    )
    return missing.join(d, "column").select(
        "column", "rows", "missing", "min", "max", "mean",
        F.col("q50").alias("median"), "std", "q25", "q75",
    )


def validate_processed(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows ``(section, key, value)`` on shape, quality and target."""
    numeric, text = numeric_columns(df), string_columns(df)
    inf = sum(
        (F.count_if(F.abs(F.col(c).cast("double")) == F.lit(math.inf)) for c in numeric[1:]),
        F.count_if(F.abs(F.col(numeric[0]).cast("double")) == F.lit(math.inf)),
    ) if numeric else F.lit(0)
    nulls = sum((flag_sum(c) for c in df.columns[1:]), flag_sum(df.columns[0]))
    one = df.agg(F.count("*").alias("rows"), nulls.alias("nulls"), inf.alias("infinities"))
    shape = one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("section"), F.lit(k).alias("key"), v.cast("double").alias("value"))
                    for s, k, v in [
                        ("shape", "rows", F.col("rows")),
                        ("shape", "columns", F.lit(len(df.columns))),
                        ("quality", "missing_values", F.col("nulls")),
                        ("quality", "infinite_values", F.col("infinities")),
                        ("features", "numerical", F.lit(len(numeric))),
                        ("features", "categorical", F.lit(len(text))),
                        ("target", "present", F.lit(int(target in df.columns))),
                    ]
                ]
            )
        )
    )
    dup = duplicate_rows(df).select(
        F.lit("quality").alias("section"),
        F.lit("duplicate_rows").alias("key"),
        F.col("duplicates").cast("double").alias("value"),
    )
    out = shape.unionByName(dup)
    if target in df.columns:
        out = out.unionByName(_target_rows(df, target))
    return out


def _target_rows(df: DataFrame, target: str) -> DataFrame:
    d = describe(df.select(target))
    keys = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return d.select([F.col(k).cast("double").alias(k) for k in keys]).unpivot(
        [], keys, "key", "value"
    ).select(F.lit("target").alias("section"), "key", "value")


def compare_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns and NULLs of two tables side by side."""
    def one(df, tag):
        nulls = sum((flag_sum(c) for c in df.columns[1:]), flag_sum(df.columns[0]))
        width = F.lit(len(df.columns)).cast("bigint")
        return df.agg(
            F.lit(tag).alias("tag"), F.count("*").alias("rows"), width.alias("columns"),
            nulls.alias("nulls"),
        )

    parts = [(t, m) for t in ("raw", "processed") for m in ("rows", "columns", "nulls")]
    both = (
        one(before, "raw")
        .unionByName(one(after, "processed"))
        .agg(*[F.max(F.when(F.col("tag") == t, F.col(m))).alias(f"{t}_{m}") for t, m in parts])
    )
    return both.select(
        "*",
        (F.col("processed_columns") - F.col("raw_columns")).alias("new_features"),
        (F.col("processed_rows") - F.col("raw_rows")).alias("rows_added"),
        (F.col("raw_nulls") - F.col("processed_nulls")).alias("nulls_removed"),
    )


def preprocessing_statistics(raw: DataFrame, processed: DataFrame, folds: DataFrame, target: str = TARGET) -> DataFrame:
    """One row per table: rows, features by kind, nulls, later copies of equal rows, and the folds' mean sizes."""
    out = None
    for side, df in (("raw", raw), ("processed", processed)):
        numerical = numeric_columns(df, exclude=(target,))
        categorical = string_columns(df, exclude=(target,))
        copies = df.groupBy(*df.columns).agg(F.count("*").alias("n_"))
        sums = sum((F.when(F.col(c).isNull(), F.col("n_")).otherwise(0) for c in df.columns), F.lit(0))
        one = copies.agg(
            F.lit(side).alias("side"),
            F.coalesce(F.sum("n_"), F.lit(0)).alias("rows"),
            F.lit(len(numerical) + len(categorical)).cast("long").alias("features"),
            F.lit(len(numerical)).cast("long").alias("numerical"),
            F.lit(len(categorical)).cast("long").alias("categorical"),
            F.coalesce(F.sum(sums), F.lit(0)).alias("nulls"),
            F.coalesce(F.sum(F.col("n_") - 1), F.lit(0)).alias("duplicates"),
        )
        out = one if out is None else out.unionByName(one)
    sizes = folds.groupBy("fold").agg(F.count("*").alias("n"))
    mean = sizes.agg(
        (F.sum("n") - F.avg("n")).alias("mean_train_rows"), F.avg("n").alias("mean_validation_rows")
    )
    one = lambda d: d.withColumn("one_", F.lit(1))
    return one(out).join(one(mean), "one_").drop("one_")
