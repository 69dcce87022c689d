"""The numbers under the charts: every point is an aggregate over all rows."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.functions.quantiles import exact_quantiles, quantile_map
from gramlark.operators.correlate import correlation_rows, target_correlations
from gramlark.operators.outliers import iqr_bounds
from gramlark.schema import TARGET, numeric_columns
from gramlark.sources.listing import hash_bucket

TARGET_BINS, FEATURE_BINS = 50, 30


def _ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{t}{i}")
          for i, c in enumerate(columns) for t, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None:
            # a constant column gets a bin range of one around it
            out[c] = (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
    return out


def bin_index(value, lo: float, hi: float, bins: int):
    """0-based equal-width bin; the upper end belongs to the last bin."""
    raw = F.floor((value - F.lit(lo)) / F.lit((hi - lo) / bins))
    inside = F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0))
    # least() and greatest() skip NULL, which must not count as a bin
    return F.when(value.isNotNull(), inside).cast("int")


def histogram(
    df: DataFrame, columns: list[str], bins: int = FEATURE_BINS,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Counts and densities per column and non-empty bin."""
    ranges = ranges or _ranges(df, columns)
    columns = [c for c in columns if c in ranges]
    slots = [bin_index(F.col(c).cast("double"), *ranges[c], bins).alias(c) for c in columns]
    counts = (
        df.select(slots).unpivot([], columns, "column", "bin").where("bin IS NOT NULL")
        .groupBy("column", "bin").agg(F.count("*").alias("count"))
    )
    edges = df.sparkSession.createDataFrame(
        [(c, lo, (hi - lo) / bins) for c, (lo, hi) in ranges.items() if c in columns],
        "column string, lo double, width double",
    )
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    # one row per column
    return counts.join(F.broadcast(edges), "column").join(totals, "column").select(
        "column", "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right"),
        "count",
        (F.col("count") / (F.col("total") * F.col("width"))).alias("density"),
    )


def kde(df: DataFrame, column: str, grid: int = 200, bins: int = 2048) -> DataFrame:
    """Gaussian density on a grid, from binned counts (Scott's bandwidth)."""
    spark = df.sparkSession
    stats = df.agg(
        F.count(column).alias("n"), F.stddev_samp(column).alias("s"),
        F.min(column).alias("lo"), F.max(column).alias("hi"),
    ).first()
    if not stats["n"] or not stats["s"]:
        return spark.createDataFrame([], "x double, density double")
    width = (stats["hi"] - stats["lo"]) / bins
    h = stats["s"] * stats["n"] ** (-0.2)
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(bin_index(F.col(column), stats["lo"], stats["hi"], bins).alias("b"))
        .agg(F.count("*").alias("c"))
        .select((F.lit(stats["lo"]) + (F.col("b") + 0.5) * F.lit(width)).alias("center"), "c")
    )
    lo, hi = stats["lo"] - 3 * h, stats["hi"] + 3 * h
    points = F.transform(
        F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: F.lit(lo) + i * F.lit((hi - lo) / (grid - 1))
    )
    u = (F.col("x") - F.col("center")) / F.lit(h)
    norm = 1.0 / (stats["n"] * h * math.sqrt(2 * math.pi))
    # at most bins x grid rows, whatever the table's size
    return (
        counts.withColumn("x", F.explode(points))
        .groupBy("x").agg((F.sum(F.col("c") * F.exp(-0.5 * u * u)) * norm).alias("density"))
    )


def box_stats(df: DataFrame, columns: list[str], threshold: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (data inside the fences) and flier counts."""
    q = quantile_map(df, columns, [0.25, 0.5, 0.75])
    bounds = iqr_bounds(df, list(q), threshold)
    aggs = []
    for i, c in enumerate(q):
        v, b = F.col(c), bounds[c]
        inside = F.when((v >= F.lit(b.lo)) & (v <= F.lit(b.hi)), v)
        aggs += [
            F.min(inside).alias(f"lo{i}"), F.max(inside).alias(f"hi{i}"),
            F.count_if((v < F.lit(b.lo)) | (v > F.lit(b.hi))).alias(f"f{i}"),
        ]
    one = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(v[0]).alias("q1"), F.lit(v[1]).alias("median"),
            F.lit(v[2]).alias("q3"), F.col(f"lo{i}").cast("double").alias("whisker_low"),
            F.col(f"hi{i}").cast("double").alias("whisker_high"), F.col(f"f{i}").alias("fliers"),
        )
        for i, (c, v) in enumerate(q.items())
    ]
    return one.select(F.inline(F.array(*entries)))


def qq_points(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Normal quantiles against the data's quantiles at an even grid."""
    probs = [(i + 0.5) / points for i in range(points)]
    values = quantile_map(df, [column], probs).get(column, [])
    normal = NormalDist()
    rows = [(p, normal.inv_cdf(p), float(v)) for p, v in zip(probs, values)]
    return df.sparkSession.createDataFrame(rows, "prob double, theoretical double, ordered double")


def correlation_triangle(df: DataFrame, method: str = "pearson", columns=None) -> DataFrame:
    """Lower triangle of the correlation matrix, without the diagonal."""
    columns = columns or numeric_columns(df)
    position = {c: i for i, c in enumerate(columns)}
    pos = F.create_map(*[F.lit(x) for c in columns for x in (c, position[c])])
    rows = correlation_rows(df, method, columns)
    return rows.where(pos[F.col("column_a")] > pos[F.col("column_b")])


def top_features(df: DataFrame, target: str = TARGET, n: int = 15) -> DataFrame:
    """Columns by absolute correlation with the target."""
    pairs = target_correlations(df, target)[:n]
    rows = [(i + 1, c, v) for i, (c, v) in enumerate(pairs)]
    return df.sparkSession.createDataFrame(rows, "rank int, column string, strength double")


def top_correlation_block(df: DataFrame, target: str = TARGET, n: int = 15) -> DataFrame:
    """Correlations among the columns most related to the target."""
    names = [c for c, _ in target_correlations(df, target)[:n]]
    return correlation_triangle(df.select(*names, target), columns=names + [target])


def missing_map(df: DataFrame, key: str, buckets: int = 50) -> DataFrame:
    """Share of missing cells per column and hash bucket of the row key."""
    columns = [c for c in df.columns if c != key]
    bucket = hash_bucket(F.col(key), buckets).alias("bucket")
    shares = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    return df.groupBy(bucket).agg(*shares).unpivot(["bucket"], columns, "column", "missing_share")


def regression_lines(df: DataFrame, target: str = TARGET, n: int = 6) -> DataFrame:
    """Slope, intercept and correlation of the target on each top feature."""
    pairs = target_correlations(df, target)[:n]
    y = F.col(target)
    one = df.agg(
        *[f(y, F.col(c)).alias(f"{t}{i}") for i, (c, _) in enumerate(pairs)
          for t, f in (("s", F.regr_slope), ("b", F.regr_intercept))]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"s{i}").alias("slope"), F.col(f"b{i}").alias("intercept"),
            F.lit(r).cast("double").alias("strength"),
        )
        for i, (c, r) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*entries)))


def geo_grid(
    df: DataFrame, value: str = TARGET, cell: float = 0.5, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Mean value and row count per cell of a coordinate grid."""
    for c in (lat, lon, value):
        if c not in df.columns:
            raise ValueError(f"no column {c}")
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("int")
    return (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(at(lat).alias("lat_cell"), at(lon).alias("lon_cell"))
        .agg(F.count("*").alias("rows"), F.avg(value).alias("mean_value"))
    )


def binned_pairs(df: DataFrame, x, y, bins: int = 40) -> DataFrame:
    """Two-dimensional counts of two expressions, instead of a scatter of rows."""
    pairs = df.select(x.cast("double").alias("x"), y.cast("double").alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL"
    )
    r = _ranges(pairs, ["x", "y"])
    if not r:
        return pairs.groupBy(F.lit(0).alias("x_bin"), F.lit(0).alias("y_bin")).count()
    return pairs.groupBy(
        bin_index(F.col("x"), *r["x"], bins).alias("x_bin"),
        bin_index(F.col("y"), *r["y"], bins).alias("y_bin"),
    ).agg(F.count("*").alias("count"), F.avg("x").alias("x_mean"), F.avg("y").alias("y_mean"))


def display_sample(df: DataFrame, key: str, n: int = 200, seed: int = 42) -> DataFrame:
    """A repeatable random sample of at most n rows, for display."""
    return df.orderBy(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key))), key).limit(n)


def before_after_histogram(
    before: DataFrame, after: DataFrame, columns: list[str], bins: int = FEATURE_BINS
) -> DataFrame:
    """Histograms of both tables under one set of edges per column."""
    a, b = _ranges(before, columns), _ranges(after, columns)
    shared = {c: (min(a[c][0], b[c][0]), max(a[c][1], b[c][1])) for c in columns if c in a and c in b}
    one = histogram(before, columns, bins, shared).select(F.lit("before").alias("version"), "*")
    return one.unionByName(
        histogram(after, columns, bins, shared).select(F.lit("after").alias("version"), "*")
    )


def before_after_importance(before, after, target: str = TARGET, n: int = 10) -> DataFrame:
    one = top_features(before, target, n).select(F.lit("before").alias("version"), "*")
    return one.unionByName(top_features(after, target, n).select(F.lit("after").alias("version"), "*"))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    return exact_quantiles(df, columns, [0.5]).select("column", F.col("q")[0].alias("median"))
