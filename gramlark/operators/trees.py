"""Regression trees grown level by level: random forests and gradient boosting.

Columns are binned once at exact quantiles and written down in blocks, a batch of
rows in one binary value per field.  A level of all trees of a forest is one pass: each task sums weight
and target per tree, node, bin and feature that the node may split on, and Spark
adds these histograms up.  They hold the sums of both sides of every split, so the
last level needs no pass.  The driver sees only the sums, whose size follows from
trees, depth and bins, never from the rows.
Targets are whole numbers of small steps, so sums are exact and the same trees
come out at any layout of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.functions.quantiles import quantile_map
from gramlark.session import release, stage

STEPS = 1 << 24  # steps of the target's largest distance from its mean
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Tree:
    """A complete binary tree in arrays: children of node i are 2i + 1 (up to and with ``cut``, and nulls) and 2i + 2.

    ``feature`` is -1 at leaves.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row at level ``depth``; below a leaf rows go left."""
        feature = np.maximum(self.feature, 0)
        cut = np.where(self.feature < 0, np.iinfo("int64").max, self.cut)
        flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        at = np.zeros(len(bins), "int64")
        for _ in range(depth):
            at = 2 * at + 1 + (flat.take(start + feature.take(at)) > cut.take(at))
        return at

    def handed_down(self) -> np.ndarray:
        """The nodes' values, those of leaves also below them."""
        value = self.value.copy()
        for i in range(len(value) // 2):
            if self.feature[i] < 0:
                value[2 * i + 1] = value[i]
        return value


@dataclass(frozen=True)
class Ensemble:
    """Trees over binned columns; a prediction is ``base`` plus ``rate`` times the sum of the leaves."""

    columns: list[str]
    edges: dict[str, list[float]]
    trees: list[Tree]
    base: float
    rate: float

    def predict(self) -> Column:
        """The prediction as a column; batches of rows walk all trees, for nested conditions are too long to be compiled."""
        cuts = [np.array(self.edges[c], "float64") for c in self.columns]
        leaves, base, rate = [(t, t.handed_down(), (len(t.value) + 1).bit_length() - 2) for t in self.trees], self.base, self.rate

        @F.arrow_udf("double")
        def predicted(*columns: pa.Array) -> pa.Array:
            x = _bins(columns, cuts)
            out = np.zeros(len(x))
            for tree, value, depth in leaves:
                out += value.take(tree.nodes(x, depth))
            return pa.array(base + rate * out)

        return predicted(*[F.col(c).cast("double") for c in self.columns])


def _bins(columns, cuts: list[np.ndarray]) -> np.ndarray:
    """``[row, feature]``: 0 for nulls, else one more than the edges below the value."""
    out = np.zeros((len(columns[0]), len(cuts)), "int32")
    for k, cut in enumerate(cuts):
        v = columns[k].to_numpy(zero_copy_only=False).astype("float64", copy=False)
        out[:, k] = np.where(np.isnan(v), 0, 1 + np.searchsorted(cut, v, side="left"))
    return out


def quantile_edges(df: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """Distinct inner quantiles per column; a column without values has none."""
    found = quantile_map(df, columns, [k / bins for k in range(1, bins)])
    return {c: sorted(set(found.get(c) or [])) for c in columns}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def draws(hashes: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's bootstrap takes each row: Poisson of mean 1, from the row's hash."""
    salt = np.uint64(((tree + 1) * 0x9E3779B97F4A7C15 + seed) % 2**64)
    u = (_mixed(hashes.astype("int64").view("u8") + salt) >> np.uint64(11)) / 2.0**53
    cdf = np.cumsum(np.exp(-1.0) / np.concatenate([[1.0], np.cumprod(np.arange(1.0, 13.0))]))
    out = np.zeros(len(u), "int64")
    for c in cdf:  # the steps at or below u; few rows meet the later ones
        above = u >= c
        if not above.any():
            break
        out += above
    return out


def _offered(n: int, share: float, tree: int, node: int, seed: int) -> np.ndarray:
    """The features a node may split on, drawn by the node's name."""
    many = max(1, round(n * share))
    h = _mixed(np.arange(n, dtype="u8") + np.uint64((node * 65_537 + tree * 0x9E3779B97F4A7C15 + seed) % 2**64))
    return np.sort(np.argsort(h, kind="stable")[:many])


def best_split(weight: np.ndarray, total: np.ndarray, least: int) -> tuple[int, int] | None:
    """(row, bin) of the split that lowers the squared error most; ties to the first row, then the lowest bin.

    ``weight`` and ``total`` are sums per [feature offered, bin]; both sides keep at
    least ``least`` weight.
    """
    n, s = weight[0].sum(), float(total[0].sum())
    best, found = s * s / n * (1 + 1e-12) if n else 0.0, None
    for f in range(len(weight)):
        left, lt = weight[f].cumsum()[:-1], total[f].cumsum()[:-1].astype("float64")
        right, rt = n - left, s - lt
        ok = (left >= least) & (right >= least)
        if ok.any():
            gain = np.where(ok, lt**2 / np.maximum(left, 1) + rt**2 / np.maximum(right, 1), -1.0)
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = gain[at], (f, at)
    return found


def _kind(bins: int) -> str:
    return "u1" if bins < 256 else "<u4"


def _packed(binned: DataFrame, bins: int, hashes: bool) -> DataFrame:
    """``(x, y[, h])`` written down, a batch of rows in one block."""
    kept = ["y", "h"] if hashes else ["y"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(_kind(bins))
                yield _block([x, *(c.to_numpy() for c in batch.columns[1:])], ["x", *kept])

    schema = ", ".join(f"{c} binary" for c in ["x", *kept])
    return stage(binned.select("bins", *kept).mapInArrow(pack, schema), "binned")


def _block(arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names=names)


def _blocks(batches: Iterator[pa.RecordBatch], bins: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``[row, feature]`` bins, targets and, if kept, hashes of every block."""
    for batch in batches:
        for x, y, *h in zip(*batch.columns):
            y, *h = (np.frombuffer(v.as_buffer(), "i8") for v in (y, *h))
            yield np.frombuffer(x.as_buffer(), _kind(bins)).reshape(len(y), -1), y, *h


def grow(binned: DataFrame, trees: int, depth: int, bins: int, least: int, bootstrap: bool, share: float, seed: int) -> list[Tree]:
    """Trees of at most ``depth`` levels on ``binned(bins array, y long, h long)``; one pass per level for all of them."""
    first = binned.first()
    n_features = len(first["bins"]) if first else 0
    packed = _packed(binned, bins, bootstrap) if n_features else None
    return _grow(packed, n_features, trees, depth, bins, least, bootstrap, share, seed)


def _grow(
    packed: DataFrame | None, n_features: int, trees: int, depth: int, bins: int, least: int, bootstrap: bool, share: float, seed: int
) -> list[Tree]:
    size = 2 ** (depth + 1) - 1
    out = [Tree(np.full(size, -1), np.zeros(size, "int64"), np.zeros(size)) for _ in range(trees)]
    if not n_features:
        return out
    width = bins + 1
    for level in range(max(1, depth)):
        grown, many = out, 2**level
        offered = np.array([[_offered(n_features, share, t, many - 1 + k, seed) for k in range(many)] for t in range(trees)])
        slots = offered.shape[2]
        # nodes below a leaf are not told
        told = np.array([[not level or tree.feature[(many - 2 + k) // 2] >= 0 for k in range(many)] for tree in out])
        if not told.any():
            break

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.zeros((trees, 2, slots, many * width), "int64")
            for all_x, all_y, *hashes in _blocks(batches, bins):
                x, y, w = all_x, all_y.astype("float64"), None
                for t, tree in enumerate(grown):
                    if bootstrap:
                        drawn = draws(hashes[0], t, seed)
                        use = np.flatnonzero(drawn)
                        w = drawn.take(use).astype("float64")
                        x, y = all_x.take(use, axis=0), all_y.take(use) * w
                    node = tree.nodes(x, level) - (many - 1)
                    flat, start = x.ravel(), np.arange(len(x)) * n_features
                    for k in range(slots):
                        own = x[:, k] if slots == n_features else flat.take(start + offered[t, :, k].take(node))
                        at = node * width + own
                        # sums of a batch are below 2^53, so exact
                        cells[t, 0, k] += np.bincount(at, w, many * width).astype("int64")
                        cells[t, 1, k] += np.bincount(at, y, many * width).astype("int64")
            per = np.moveaxis(cells.reshape(trees, 2, slots, many, width), 3, 1)
            t, node = np.nonzero(told & (per[:, :, 0, 0].sum(axis=2) > 0))
            if len(t):
                flat = [per[a, b].ravel() for a, b in zip(t, node)]
                parts = [pa.array(t, pa.int32()), pa.array(node, pa.int32()), pa.array(flat, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(parts, names=["t", "node", "cells"])

        parts = packed.mapInArrow(sums, "t int, node int, cells array<long>").repartition("t", "node")
        parts = parts.select("t", "node", F.posexplode("cells").alias("place", "v")).groupBy("t", "node", "place")
        added = parts.agg(F.sum("v").alias("v")).groupBy("t", "node")
        added = added.agg(F.sort_array(F.collect_list(F.struct("place", "v")))["v"].alias("cells"))  # bounded: 2 x features x bins
        for r in added.collect():  # one row per tree and node
            weight, total = np.array(r.cells, "int64").reshape(2, slots, width)
            tree, node = out[r.t], many - 1 + r.node
            if not level:
                tree.value[node] = total[0].sum() / weight[0].sum()
            split = best_split(weight, total, least) if level < depth else None
            if split:
                k, cut = split
                tree.feature[node], tree.cut[node] = offered[r.t, r.node, k], cut
                for child, side in ((2 * node + 1, slice(0, cut + 1)), (2 * node + 2, slice(cut + 1, None))):
                    n = weight[k, side].sum()
                    tree.value[child] = total[k, side].sum() / n if n else 0.0
    return out


def _prepared(df: DataFrame, columns: list[str], target: str, key: str, bins: int, edges=None) -> tuple[DataFrame, dict, float, float]:
    """``(bins, y, h)``, the edges, and the target's mean and step."""
    rows = df.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    edges = edges or quantile_edges(rows, columns, bins)
    mean, low, high = rows.agg(F.avg(target), F.min(target), F.max(target)).first()
    mean = float(mean or 0.0)
    step = (max(float(high) - mean, mean - float(low)) if high is not None else 0.0) / STEPS or 1.0
    y = F.round((F.col(target).cast("double") - F.lit(mean)) / F.lit(step)).cast("long")
    cuts = [np.array(edges[c], "float64") for c in columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _bins(batch.columns[2:], cuts)
            ends = pa.array(np.arange(len(x) + 1, dtype="i4") * len(cuts))
            parts = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())), *batch.columns[:2]]
            yield pa.RecordBatch.from_arrays(parts, names=["bins", "y", "h"])

    typed = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]
    binned = rows.select(y.alias("y"), F.xxhash64(key).alias("h"), *typed)
    return binned.mapInArrow(place, "bins array<int>, y long, h long"), edges, mean, step


def _scaled(trees: list[Tree], step: float) -> list[Tree]:
    return [Tree(t.feature, t.cut, t.value * step) for t in trees]


def random_forest(
    df: DataFrame,
    columns: list[str],
    target: str,
    key: str,
    trees: int = 20,
    depth: int = 5,
    bins: int = 32,
    least: int = 1,
    share: float = 1 / 3,
    seed: int = 42,
) -> Ensemble:
    """Mean of trees on bootstraps of the rows; every node sees its own draw of the features.

    Bootstraps follow from ``key``'s hash, so rows with one key are drawn
    together.  Rows without a target are left out; null features go left.
    """
    binned, edges, mean, step = _prepared(df, columns, target, key, bins)
    grown = grow(binned, trees, depth, bins, least, True, share, seed)
    return Ensemble(columns, edges, _scaled(grown, step), mean, 1.0 / trees)


def boosted_trees(
    df: DataFrame,
    columns: list[str],
    target: str,
    key: str,
    rounds: int = 20,
    depth: int = 3,
    bins: int = 32,
    least: int = 1,
    rate: float = 0.1,
) -> Ensemble:
    """Each tree is fitted to what the ones before leave; residuals are written down between rounds, and the ones before deleted."""
    binned, edges, mean, step = _prepared(df, columns, target, key, bins)
    packed = _packed(binned, bins, False)
    out: list[Tree] = []
    for k in range(rounds):
        tree = _grow(packed, len(columns), 1, depth, bins, least, False, 1.0, 0)[0]
        out.append(tree)
        if k + 1 < rounds:
            fitted = np.rint(rate * tree.handed_down()).astype("int64")

            def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for x, y in _blocks(batches, bins):
                    yield _block([x, y - fitted.take(tree.nodes(x, depth))], ["x", "y"])

            done, packed = packed, stage(packed.mapInArrow(left, "x binary, y binary"), "residuals")
            release(done)
    return Ensemble(columns, edges, _scaled(out, step), mean, rate)


def splits(model: Ensemble) -> list[tuple]:
    """``(tree, node, feature, threshold, value)`` of every node in use; leaves have no feature."""
    out = []
    for t, tree in enumerate(model.trees):
        todo = [0]
        while todo:
            node = todo.pop()
            f = int(tree.feature[node])
            name = model.columns[f] if f >= 0 else None
            edge = model.edges[name][int(tree.cut[node]) - 1] if name and tree.cut[node] else None
            out.append((t, node, name, edge, float(tree.value[node])))
            todo += [2 * node + 1, 2 * node + 2] if f >= 0 else []
    return sorted(out, key=lambda r: r[:2])
