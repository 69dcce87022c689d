"""Exact quantiles that never gather an unbounded group in one task.

Small groups use the built-in exact ``percentile``: its value map is bounded by
the group's row count, which is known beforehand.  For larger groups the wanted
order statistics are found by narrowing brackets.  Each pass splits every open
bracket into equal-width bins and takes count, minimum and maximum per bin, an
aggregate that is combined before the shuffle.  The bin holding the wanted rank
becomes the next bracket, so the answer is exact and the driver only ever sees
bin counts.  Whole columns are binned in Arrow batches; columns split by a group
key are binned by a join with the table of brackets.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramlark.session import is_staged, stage

SMALL_GROUP_ROWS = 100_000
BINS = 1024
FINAL_ROWS = 50_000
BROADCAST_BRACKETS = 100_000


@dataclass
class _Bracket:
    group: tuple
    column: str
    lo: float
    hi: float
    below: int
    inside: int
    ranks: list[int] = field(default_factory=list)


def to_long(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Rows ``(by..., column, v)`` for the non-null values of ``columns``."""
    by = list(by)
    typed = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = typed.unpivot(by, list(columns), "column", "v")
    keep = F.col("v").isNotNull() & ~F.isnan("v")
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return long.where(keep)


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: list[str] = (),
    small_group_rows: int = SMALL_GROUP_ROWS,
    bins: int = BINS,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """Rows ``(by..., column, q)`` with ``q`` the array of linear-interpolated
    quantiles in the order of ``probs``.

    Nulls (and NaN) in the values are skipped and rows with a null group key
    are dropped.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    narrow = df.select(*by, *columns)
    long = to_long(narrow, columns, by)
    keys = by + ["column"]
    sizes = _grouped_sizes(long, keys) if by else _column_sizes(narrow, columns)
    big = sizes.where(F.col("n") > small_group_rows).collect()

    small = long
    if big:
        # at most rows/small_group_rows groups can be this large
        hot = df.sparkSession.createDataFrame(
            [tuple(r[k] for k in keys) for r in big], sizes.select(keys).schema
        )
        small = long.join(_maybe_broadcast(hot, len(big)), keys, "left_anti")
    if big and not by:
        left = [c for c in columns if c not in {r["column"] for r in big}]
        small = to_long(narrow.select(left), left) if left else None
    schema = _result_schema(long, keys)
    result = None
    if small is not None:
        result = small.groupBy(keys).agg(
            F.percentile("v", F.array(*map(F.lit, probs))).alias("q")
        )
    if not big:
        return result

    source = df if is_staged(df) else stage(narrow, "quantile-input")
    if by:
        again = to_long(source, columns, by)
        count_bins = lambda open_, n_bins: _joined_bins(again, by, open_, n_bins)
    else:
        count_bins = lambda open_, n_bins: _batch_bins(source, open_, n_bins)
    values = _narrow(count_bins, by, big, probs, bins, final_rows)
    rows = []
    for r in big:
        g = tuple(r[b] for b in by)
        stats = values[(g, r["column"])]
        q = [_interpolate(stats, p, r["n"]) for p in probs]
        rows.append((*g, r["column"], q))
    found = df.sparkSession.createDataFrame(rows, schema)
    return found if result is None else result.unionByName(found)


def _result_schema(long: DataFrame, keys: list[str]) -> T.StructType:
    return long.select(keys).schema.add("q", T.ArrayType(T.DoubleType()))


def _grouped_sizes(long: DataFrame, keys: list[str]) -> DataFrame:
    finite = F.when(F.abs("v") < F.lit(math.inf), F.col("v"))
    return long.groupBy(keys).agg(
        F.count("v").alias("n"),
        F.count_if(F.col("v") == F.lit(-math.inf)).alias("n_neg"),
        F.count(finite).alias("n_fin"),
        F.min(finite).alias("lo"),
        F.max(finite).alias("hi"),
    )


def _doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select([F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def _values(batch: pa.RecordBatch, i: int) -> np.ndarray:
    v = batch.column(i).to_numpy(zero_copy_only=False).astype(float, copy=False)
    return v[~np.isnan(v)]


def _column_sizes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and finite range per column; columns without values are left out."""
    names = list(columns)

    def work(batches):
        n, neg, fin = (np.zeros(len(names), np.int64) for _ in range(3))
        lo, hi = np.full(len(names), np.inf), np.full(len(names), -np.inf)
        for batch in batches:
            for i in range(len(names)):
                v = _values(batch, i)
                f = v[np.isfinite(v)]
                n[i] += len(v)
                neg[i] += int((v == -np.inf).sum())
                fin[i] += len(f)
                if len(f):
                    lo[i], hi[i] = min(lo[i], f.min()), max(hi[i], f.max())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names), pa.array(n), pa.array(neg), pa.array(fin),
                pa.array([None if x == np.inf else x for x in lo], pa.float64()),
                pa.array([None if x == -np.inf else x for x in hi], pa.float64()),
            ],
            names=["column", "n", "n_neg", "n_fin", "lo", "hi"],
        )

    parts = _doubles(df, names).mapInArrow(
        work, "column string, n bigint, n_neg bigint, n_fin bigint, lo double, hi double"
    )
    return parts.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("n_neg").alias("n_neg"), F.sum("n_fin").alias("n_fin"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )


def quantile_map(
    df: DataFrame, columns: list[str], probs: list[float], **kwargs
) -> dict[str, list[float]]:
    """Driver-side ``{column: [quantiles]}``; columns without values are absent."""
    rows = exact_quantiles(df, columns, probs, **kwargs).collect()
    return {r["column"]: list(r["q"]) for r in rows}


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_BRACKETS else df


def _ranks(p: float, n: int) -> tuple[int, int]:
    h = (n - 1) * p
    return int(math.floor(h)), int(math.ceil(h))


def _interpolate(stats: dict[int, float], p: float, n: int) -> float:
    h = (n - 1) * p
    lo, hi = _ranks(p, n)
    a, b = stats[lo], stats[hi]
    # equal neighbours must give exactly their value: it is compared with data later
    if a == b:
        return a
    if math.isinf(a) or math.isinf(b):
        return a if math.isinf(a) else b
    if math.isinf(b - a):
        return a * (hi - h) + b * (h - lo)
    return a + (b - a) * (h - lo)


def _narrow(count_bins, by, sizes, probs, bins, final_rows):
    """``{(group, column): {rank: value}}`` for every rank the probabilities touch."""
    found: dict = defaultdict(dict)
    open_: list[_Bracket] = []
    for r in sizes:
        g, c = tuple(r[b] for b in by), r["column"]
        ranks = sorted({k for p in probs for k in _ranks(p, r["n"])})
        for k in ranks:
            if k < r["n_neg"]:
                found[(g, c)][k] = -math.inf
            elif k >= r["n_neg"] + r["n_fin"]:
                found[(g, c)][k] = math.inf
        inner = [k for k in ranks if k not in found[(g, c)]]
        if inner:
            _place(found, open_, _Bracket(g, c, r["lo"], r["hi"], r["n_neg"], r["n_fin"], inner))
    while open_:
        few = sum(b.inside for b in open_) <= final_rows
        # few enough rows: every distinct value is its own bin
        per = defaultdict(list)
        for r in count_bins(open_, 0 if few else max(16, min(bins, 4_000_000 // len(open_)))):
            per[r["bid"]].append((r["lo"], r["hi"], r["n"]))
        following: list[_Bracket] = []
        for bid, b in enumerate(open_):
            below, ranks = b.below, list(b.ranks)
            for lo, hi, n in sorted(per[bid]):
                here = [k for k in ranks if below <= k < below + n]
                if here:
                    _place(found, following, _Bracket(b.group, b.column, lo, hi, below, n, here))
                below += n
        open_ = following
    return found


def _place(found, queue, bracket: _Bracket) -> None:
    if bracket.lo == bracket.hi:
        for k in bracket.ranks:
            found[(bracket.group, bracket.column)][k] = bracket.lo
    else:
        queue.append(bracket)


def _joined_bins(long: DataFrame, by: list[str], brackets: list[_Bracket], n_bins: int):
    """Count, minimum and maximum per bracket and bin of grouped values."""
    inside = _in_brackets(long, by, brackets)
    if n_bins:
        # ranges beyond the largest double are halved before subtracting
        half = F.when(F.col("hi") - F.col("lo") < F.lit(math.inf), 1.0).otherwise(0.5)
        low = F.col("lo") * half
        share = (F.col("v") * half - low) / (F.col("hi") * half - low)
        slot = F.least(F.floor(share * n_bins), F.lit(n_bins - 1))
    else:
        slot = F.col("v")
    return (
        inside.groupBy("bid", slot.alias("slot"))
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )


def _batch_bins(df: DataFrame, brackets: list[_Bracket], n_bins: int):
    """Count, minimum and maximum per bracket and bin of whole columns."""
    columns = sorted({b.column for b in brackets})
    spans = []
    for c in columns:
        # brackets of one column never overlap
        own = sorted((b.lo, b.hi, i) for i, b in enumerate(brackets) if b.column == c)
        spans.append(tuple(np.array(x) for x in zip(*own)))

    def work(batches):
        acc = [None] * len(spans)
        for batch in batches:
            for j, (lows, highs, _) in enumerate(spans):
                # ranges beyond the largest double are halved before subtracting
                with np.errstate(over="ignore"):
                    half = np.where(np.isinf(highs - lows), 0.5, 1.0)
                v = _values(batch, j)
                at = np.searchsorted(lows, v, side="right") - 1
                ok = (at >= 0) & (v <= highs[at])
                v, at = v[ok], at[ok]
                if not len(v):
                    continue
                if not n_bins:
                    values, counts = np.unique(v, return_counts=True)
                    if acc[j] is not None:
                        values, at_ = np.unique(np.append(acc[j][0], values), return_inverse=True)
                        counts = np.bincount(at_, np.append(acc[j][1], counts)).astype(np.int64)
                    acc[j] = (values, counts)
                    continue
                low = lows[at] * half[at]
                share = (v * half[at] - low) / (highs[at] * half[at] - low)
                slot = np.minimum(np.floor(share * n_bins), n_bins - 1).astype(np.int64) + at * n_bins
                if acc[j] is None:
                    size = len(lows) * n_bins
                    acc[j] = (np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf))
                n, lo, hi = acc[j]
                np.add.at(n, slot, 1)
                np.minimum.at(lo, slot, v)
                np.maximum.at(hi, slot, v)
        for j, (lows, _, bids) in enumerate(spans):
            if acc[j] is None:
                continue
            if n_bins:
                n, lo, hi = acc[j]
                slot = np.flatnonzero(n)
                bid, n, lo, hi = bids[slot // n_bins], n[slot], lo[slot], hi[slot]
            else:
                lo, n = acc[j]
                hi, slot = lo, np.zeros(len(lo), np.int64)
                bid = bids[np.searchsorted(lows, lo, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bid, pa.int32()), pa.array(slot, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(lo, pa.float64()), pa.array(hi, pa.float64()),
                ],
                names=["bid", "slot", "n", "lo", "hi"],
            )

    parts = _doubles(df, columns).mapInArrow(
        work, "bid int, slot bigint, n bigint, lo double, hi double"
    )
    keys = ["bid", "slot"] if n_bins else ["bid", "lo"]
    aggs = [F.sum("n").alias("n"), F.max("hi").alias("hi")]
    if n_bins:
        aggs.append(F.min("lo").alias("lo"))
    return parts.groupBy(*keys).agg(*aggs).collect()


def _in_brackets(long: DataFrame, by: list[str], brackets: list[_Bracket]) -> DataFrame:
    key_schema = long.select(*by, "column").schema
    schema = key_schema.add("bid", "integer").add("lo", "double").add("hi", "double")
    table = long.sparkSession.createDataFrame(
        [(*b.group, b.column, i, b.lo, b.hi) for i, b in enumerate(brackets)], schema
    )
    joined = long.join(_maybe_broadcast(table, len(brackets)), by + ["column"])
    return joined.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
