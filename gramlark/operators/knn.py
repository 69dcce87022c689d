"""Exact k-nearest-neighbour imputation by a partitioned search in two rounds.

Distance between two rows: ``sqrt(p / shared * sum of squared differences)``
over the ``shared`` columns both rows have, out of ``p`` columns.

For each column to fill, the rows that have it (donors) are dealt to the leaves of
trees that halve space along its widest column; donors of one frequent kind of gaps
have a tree of their own, all others share one.  A leaf holds about ``LEAF_ROWS``
donors; one that holds more (equal rows can't be halved) is split into cells by
hash.  Where trees halve is taken from a share of the donors, which decides only how
even the leaves are: every donor is in a cell, and a leaf's limits are those of all
its donors.

1. Rows with a gap look for neighbours in the cell they fall into.  This bounds
   the distance of their k-th neighbour.
2. Each row then visits the other cells whose limits come within that bound.  A row
   with none is done.

A leaf's distance to a row, over the columns the row has, is at most that of any of
its donors, as a donor's own gaps widen the limits without end and ``p / shared``
grows with fewer shared columns.  So the result is exact.  Within a cell donors are
halved likewise into boxes of ``BOX_ROWS``, and visitors of one kind of gaps into
groups.  A group compares itself with the nearest boxes first and then only with
boxes that are not farther than its k-th neighbours.

Donors travel in blocks, by column and packed; rows without a gap don't travel.  A
cell emits at most k candidates per visiting row; pairs of rows are never emitted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramlark.functions.expressions import hashed_bucket
from gramlark.session import is_staged, release, stage

# donors of a leaf: a 64th of all, but not fewer or more than these
SLICE_ROWS, LEAF_ROWS = 2_000, 30_000
LEAF_SAMPLE = 32
CELL_ROWS = 50_000
VISITOR_ROWS = 20_000
CHUNK_CELLS = 4_000_000
CHUNK_PAIRS = 500_000
ROUNDING = 1e-12
BOX_ROWS, GROUP_ROWS = 128, 64
PACK_ROWS, BLOCK_ROWS = 1_000_000, 4_096
FAN = 16


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of rows of ``q`` to rows of ``x``, both ``[rows, columns]``
    with a leading batch axis allowed; infinite if no column is shared."""
    diff = q - x
    shared = (~np.isnan(diff)).sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.sqrt(np.nansum(diff * diff, axis=-1) * (q.shape[-1] / shared))
    return np.where(shared > 0, d, np.inf)


def _nearest(q: np.ndarray, x: np.ndarray, values: np.ndarray, k: int, limit: np.ndarray | None = None):
    """Row of ``q``, distance and value of its k nearest rows of ``x`` with a value.

    NaN are missing cells.  Of equally near donors those with the smaller values
    come first, so the result does not depend on the order of the rows.  Matrix
    products give all distances up to a rounding bound; the exact distances of
    all donors that may be among the k nearest decide.  Donors beyond a row's
    ``limit`` may be left out.
    """
    donors = np.flatnonzero(~np.isnan(values))
    if len(donors) == 0:
        return np.empty(0, int), np.empty(0), np.empty(0)
    xd, held = (x, values) if len(donors) == len(x) else (x[donors], values[donors])
    kth = min(k, len(donors)) - 1
    has = ~np.isnan(q).all(axis=0)
    if has.any() and not np.isnan(q[:, has]).any() and not np.isnan(xd[:, has]).any():
        row, col = _candidates(q[:, has], xd[:, has], kth, None if limit is None else limit**2 * (has.sum() / q.shape[1]))
    else:
        row, col = _candidates_with_gaps(q, xd, kth)
    exact = np.empty(len(row))
    for s in range(0, len(row), CHUNK_PAIRS):
        part = slice(s, s + CHUNK_PAIRS)
        exact[part] = _distances(q[row[part]], xd[col[part]])
    order = np.lexsort((held[col], exact, row))
    row, exact, value = row[order], exact[order], held[col[order]]
    first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[first], exact[first], value[first]


def _candidates(q: np.ndarray, x: np.ndarray, kth: int, limit: np.ndarray | None):
    """Pairs (row of ``q``, row of ``x``) that may be among the nearest, of rows without gaps.

    Up to a row's own size, which is the same for all its pairs, the squared distances
    are one matrix product; they need no sorting where ``limit`` bounds them already.
    """
    center = x.mean(axis=0)
    x0, q0 = x - center, q - center
    sizes, own = (x0 * x0).sum(axis=1), (q0 * q0).sum(axis=1)
    d2 = (-2.0 * q0) @ x0.T
    d2 += sizes
    slack = 2 * ROUNDING * (own + sizes.max())
    if limit is not None and np.isfinite(limit).all():
        reach = limit * (1 + 1e-9) - own + slack
    else:
        reach = np.partition(d2, kth, axis=1)[:, kth] + 2 * slack
    return np.nonzero(d2 <= reach[:, None])


def _candidates_with_gaps(q: np.ndarray, x: np.ndarray, kth: int):
    with np.errstate(all="ignore"):
        center = np.nan_to_num(np.nanmean(x, axis=0))
    px, pq = ~np.isnan(x), ~np.isnan(q)
    x0, q0 = np.where(px, x - center, 0.0), np.where(pq, q - center, 0.0)
    fx, fq = px.astype(float), pq.astype(float)
    shared = fq @ fx.T
    size = (q0 * q0) @ fx.T + fq @ (x0 * x0).T
    with np.errstate(divide="ignore", invalid="ignore"):
        d2 = np.where(shared > 0, (size - 2.0 * (q0 @ x0.T)) / shared, np.inf)
        slack = np.where(shared > 0, ROUNDING * size / shared, 0.0)
    reach = np.partition(d2 + slack, kth, axis=1)[:, kth]
    return np.nonzero((d2 - slack <= reach[:, None]) & (shared > 0))


def _halved(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``x`` (no NaN) in parts of at most ``most``, halved along the widest column."""
    todo, out = [(np.arange(len(x)), np.ascontiguousarray(x.T))], []
    while todo:
        rows, own = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        widest = int((own.max(axis=1) - own.min(axis=1)).argmax())
        order = np.argpartition(own[widest], len(rows) // 2)
        for half in (order[: len(rows) // 2], order[len(rows) // 2 :]):
            todo.append((rows[half], own[:, half]))
    return [r for r in out if len(r)]


def _boxed_nearest(q: np.ndarray, x: np.ndarray, values: np.ndarray, k: int, limit: np.ndarray | None = None):
    """``_nearest``, but groups of rows of ``q`` skip boxes of donors that are too far,
    and donors beyond a row's ``limit`` are left out.

    A box's distance to a group, over the columns the group has, is at most that of
    any two of their rows: a donor's own gaps widen its box without limit, and
    distances over fewer shared columns are scaled up.
    """
    held = np.flatnonzero(~np.isnan(values))
    x, values = x[held], values[held]
    if len(held) <= 2 * BOX_ROWS:
        step = max(1, CHUNK_CELLS // max(len(held), 1))
        found = [_nearest(q[s : s + step], x, values, k) for s in range(0, len(q), step)]
        rows = [r + s for (r, _, _), s in zip(found, range(0, len(q), step))]
        return _limited(*(np.concatenate(c) for c in (rows, [f[1] for f in found], [f[2] for f in found])), limit)
    boxes = _halved(np.nan_to_num(x), BOX_ROWS)
    sizes = np.array([len(b) for b in boxes])
    starts = sizes.cumsum() - sizes
    flat = np.concatenate(boxes)
    x, values = x[flat], values[flat]
    # a box with a gap in a column has no limits there
    gap = np.isnan(x)
    low = np.minimum.reduceat(np.where(gap, -np.inf, x), starts)
    high = np.maximum.reduceat(np.where(gap, np.inf, x), starts)
    kinds, kind = np.unique(np.isnan(q), axis=0, return_inverse=True)
    kind, out = kind.ravel(), []
    for g, gaps in enumerate(kinds):
        has, members = np.flatnonzero(~gaps), np.flatnonzero(kind == g)
        if len(has) == 0:  # no donor is at a known distance
            continue
        for part in _halved(q[members][:, has], GROUP_ROWS):
            rows = members[part]
            own = q[np.ix_(rows, has)]
            apart = np.fmax(np.fmax(low[:, has] - own.max(axis=0), own.min(axis=0) - high[:, has]), 0.0)
            # never more than any two of their rows are apart: all columns over the most that can be shared
            bound = np.sqrt((apart * apart).sum(axis=1) * (q.shape[1] / len(has)))
            order = np.argsort(bound, kind="stable")
            most = np.full(len(rows), np.inf) if limit is None else limit[rows]
            ends, done, reach = sizes[order].cumsum(), 0, most
            many = int(np.searchsorted(ends, max(4 * BOX_ROWS, 4 * k))) + 1
            best = (np.empty(0, int), np.empty(0), np.empty(0))
            # boxes in order of their bounds, twice as many each time, until the next one is out of reach
            while done < len(order) and bound[order[done]] * (1 - 1e-9) <= reach.max():
                within = int(np.searchsorted(bound[order] * (1 - 1e-9), reach.max(), side="right"))
                own_boxes = order[done : min(done + many, within)]
                take = _runs(starts[own_boxes], sizes[own_boxes])
                new = _nearest(q[rows], x[take], values[take], k, reach)
                best = _merged(best, new, k)
                done, many = min(done + many, within), min(2 * many, max(1, CHUNK_CELLS // (GROUP_ROWS * BOX_ROWS)))
                found = np.bincount(best[0], minlength=len(rows))
                full, last, reach = found >= k, found.cumsum() - 1, most.copy()
                reach[full] = np.minimum(reach[full], best[1][last[full]])
            out.append((rows[best[0]], best[1], best[2]))
    if not out:
        return np.empty(0, int), np.empty(0), np.empty(0)
    row, dist, value = (np.concatenate(c) for c in zip(*out))
    order = np.lexsort((value, dist, row))
    return _limited(row[order], dist[order], value[order], limit)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The whole numbers of all runs, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (sizes.cumsum() - sizes), sizes)


def _limited(row, dist, value, limit):
    if limit is None:
        return row, dist, value
    near = dist <= limit[row]
    return row[near], dist[near], value[near]


def _merged(a, b, k: int):
    """The k nearest per row of both, ties to the smaller value."""
    row, dist, value = (np.concatenate(c) for c in zip(a, b))
    order = np.lexsort((value, dist, row))
    row, dist, value = row[order], dist[order], value[order]
    first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[first], dist[first], value[first]


def knn_impute(
    df: DataFrame,
    columns: list[str],
    fill: list[str],
    k: int = 5,
    cell_rows: int = CELL_ROWS,
    visitor_rows: int = VISITOR_ROWS,
    donors: DataFrame | None = None,
) -> DataFrame:
    """Fill NULLs of ``fill`` with the mean of the k nearest donors' values.

    ``donors`` are the rows to search, those of ``df`` by default.  A value
    without any donor at a known distance gets the mean of the donors' column.
    """
    order = df.columns
    rows = df if is_staged(df) else stage(df, "knn-rows", lean=True)
    some_null = " OR ".join(f"`{c}` IS NULL" for c in fill)
    if rows.where(some_null).isEmpty():
        return df
    pool = rows
    if donors is not None:
        pool = donors if is_staged(donors) else stage(donors.select(*columns), "knn-donors", lean=True)
    counts = pool.agg(
        F.count("*").alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(fill)],
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(fill)],
    ).first()
    if counts["n"] == 0:
        return df
    means = {c: F.lit(counts[f"m{i}"]).cast("double") for i, c in enumerate(fill)}
    ids = F.monotonically_increasing_id()
    gaps = stage(rows.where(some_null).withColumn("_id", ids), "knn-gaps", lean=True)
    typed = [F.col(c).cast("double").alias(c) for c in columns]
    known = F.expr(" OR ".join(f"`{c}` IS NOT NULL" for c in columns))
    filled = gaps
    for i, c in enumerate(fill):
        visitors = gaps.where(F.col(c).isNull() & known).select("_id", *typed)
        found = _search(
            pool.select(typed).where(F.col(c).isNotNull() & ~F.isnan(c)),
            visitors, columns.index(c), counts[f"c{i}"], k, cell_rows, visitor_rows,
        )
        filled = filled.join(found.withColumnRenamed("_value", f"{c}_knn"), "_id", "left")
    filled = filled.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_knn"), means[c]) for c in fill})
    whole = rows.where(f"NOT ({some_null})").withColumns({c: F.coalesce(F.col(c), means[c]) for c in fill})
    return whole.select(order).unionByName(filled.select(order))


def _search(donors, visitors, target: int, n: int, k: int, cell_rows: int, visitor_rows: int) -> DataFrame:
    """Mean of column ``target`` over the k nearest donors per visitor that has any, as (_id, _value)."""
    columns = donors.columns
    layout = _layout(donors, target, n)
    blocks = stage(
        donors.mapInArrow(
            _packer(layout, max(1, min(BLOCK_ROWS, cell_rows // 4))),
            "_leaf int, _rows int, _low array<double>, _high array<double>, _data binary",
        ).withColumn("_block", F.monotonically_increasing_id()),
        "knn-blocks", lean=True,
    )
    leaves = blocks.groupBy("_leaf").agg(
        F.sum("_rows").alias("rows"),
        *[F.min(F.col("_low")[i]).alias(f"l{i}") for i in range(len(columns))],
        *[F.max(F.col("_high")[i]).alias(f"h{i}") for i in range(len(columns))],
    ).collect()  # one per leaf
    if not leaves:
        return visitors.sparkSession.createDataFrame([], "_id long, _value double")
    layout.limit(leaves, cell_rows)
    spans = donors.sparkSession.createDataFrame(
        [(r["_leaf"], int(layout.starts[r["_leaf"]]), int(layout.cells[r["_leaf"]])) for r in leaves],
        "_leaf int, _start int, _cells int",
    )
    cells = blocks.join(F.broadcast(spans), "_leaf").select(
        (F.col("_start") + hashed_bucket(F.col("_block"), F.col("_cells"))).alias("_cell"), "_rows", "_data"
    )
    row = F.array(*columns)
    home = visitors.select(
        layout.home_udf()("_id", *columns).alias("_cell"), "_id", F.lit(float("inf")).alias("_reach"), row.alias("_row")
    )
    first = stage(_visit(cells, home, target, k, visitor_rows, layout), "knn-first", lean=True)
    open_rows = first.where(F.size("_cells") > 0)
    visits = open_rows.select(F.explode("_cells").alias("_cell"), "_id", "_reach", "_row")
    second = _visit(cells, visits, target, k, visitor_rows, None)
    near = "_id", F.explode("_near").alias("_n")
    both = open_rows.select(*near).unionByName(second.select(*near)).select("_id", "_n.*")
    best = _top(both, k).groupBy("_id").agg(F.avg("_value").alias("_value"))
    done = first.where((F.size("_cells") == 0) & (F.size("_near") > 0)).select(
        "_id", F.expr("aggregate(_near, 0D, (s, n) -> s + n._value) / size(_near)").alias("_value")
    )
    values = stage(done.unionByName(best), "knn-values", lean=True)
    release(first)
    release(blocks)
    return values


def _layout(donors: DataFrame, target: int, n: int) -> "_Layout":
    """Trees over the donors: one for each kind of gaps that fills leaves, one for all other donors."""
    most = max(SLICE_ROWS, min(LEAF_ROWS, n // 64))
    free = [c for i, c in enumerate(donors.columns) if i != target]
    layout = _Layout(target)
    if not free:
        layout.grow(None, np.zeros((0, len(donors.columns))))
        return layout
    gaps = F.concat(*[F.when(F.col(c).isNull() | F.isnan(c), "1").otherwise("0") for c in free])
    kinds = donors.groupBy(gaps.alias("gaps")).count().where(F.col("count") >= most)
    kinds = [r["gaps"] for r in kinds.orderBy(F.desc("count"), "gaps").collect()]  # at most n / most
    share = min(1.0, LEAF_SAMPLE / most)
    picked = donors.sample(share, 17).toPandas().to_numpy(float) if n > most else np.zeros((0, len(donors.columns)))
    kind = _kinds(picked, target)
    for name in kinds:
        layout.grow(name, picked[kind == name])
    layout.grow(None, picked[~np.isin(kind, kinds)])
    return layout


def _kinds(x: np.ndarray, target: int) -> np.ndarray:
    """A text of 0 and 1 per row: which columns but the target are missing."""
    missing = np.delete(np.isnan(x), target, axis=1)
    if not len(x) or not missing.any():
        return np.full(len(x), "0" * missing.shape[1])
    some, which = np.unique(missing, axis=0, return_inverse=True)
    return np.array(["".join("01"[int(v)] for v in s) for s in some])[which.ravel()]


class _Layout:
    """Leaves of trees over the donors, in an order where neighbours are near, and their limits."""

    def __init__(self, target: int):
        self.target, self.roots, self.leaves = target, {}, 0
        self.column, self.cut, self.left, self.right = [], [], [], []  # a leaf has its number as left

    def grow(self, kind: str | None, points: np.ndarray) -> None:
        """A tree for donors of a kind of gaps, or for those of no other tree."""
        points = np.nan_to_num(points)
        points[:, self.target] = 0.0  # the visitors don't have it
        self.roots[kind] = self._node()
        todo = [(self.roots[kind], np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            own = points[rows]
            wide = own.max(axis=0) - own.min(axis=0) if len(rows) > LEAF_SAMPLE else np.zeros(1)
            c = int(wide.argmax())
            if wide[c] == 0:
                self.left[node], self.leaves = self.leaves, self.leaves + 1
                continue
            v = own[:, c]
            cut = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
            cut = v[v < cut].max() if cut == v.max() else cut
            self.column[node], self.cut[node] = c, float(cut)
            self.left[node], self.right[node] = self._node(), self._node()
            todo += [(self.right[node], rows[v > cut]), (self.left[node], rows[v <= cut])]

    def _node(self) -> int:
        for values, v in ((self.column, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
            values.append(v)
        return len(self.column) - 1

    def fall(self, x: np.ndarray, node: np.ndarray, coin: np.ndarray | None = None) -> np.ndarray:
        """The leaf below ``node`` per row; ``coin`` has bits that decide where the row has a gap."""
        column, cut, left, right = (np.array(v) for v in (self.column, self.cut, self.left, self.right))
        node, rows, depth = node.copy(), np.arange(len(x)), 0
        while True:
            rows = rows[column[node[rows]] >= 0]
            if not len(rows):
                return left[node].astype("int32")
            at = node[rows]
            v = x[rows, column[at]]
            low = v <= cut[at]
            if coin is not None:
                low = np.where(np.isnan(v), (coin[rows] >> (depth % 60)) & 1 == 0, low)
            node[rows] = np.where(low, left[at], right[at])
            depth += 1

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each donor."""
        kind = _kinds(x, self.target)
        node = np.full(len(x), self.roots[None])
        for name in np.unique(kind):
            node[kind == name] = self.roots.get(str(name), self.roots[None])
        return self.fall(np.nan_to_num(x), node)

    def limit(self, leaves, cell_rows: int) -> None:
        """Take the limits and cells of the leaves that have donors, and limits of runs of leaves."""
        p = (len(leaves[0]) - 2) // 2
        low, high = np.full((self.leaves, p), np.inf), np.full((self.leaves, p), -np.inf)
        self.cells = np.zeros(self.leaves, int)
        for r in leaves:
            at = r["_leaf"]
            low[at], high[at] = r[2 : 2 + p], r[2 + p :]
            self.cells[at] = 1 + r["rows"] // cell_rows
        self.starts = self.cells.cumsum() - self.cells
        self.levels = [(low, high)]
        while len(low) > FAN:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))

    def home_udf(self):
        layout = self

        @F.pandas_udf("int")
        def home(ids: pd.Series, *row: pd.Series) -> pd.Series:
            q = np.column_stack([c.to_numpy(float) for c in row])
            return pd.Series(layout.home(q, _mixed(ids.to_numpy())))

        return home

    def home(self, q: np.ndarray, coin: np.ndarray) -> np.ndarray:
        """The cell where a row looks first: of the tree with the most donors."""
        root = next(iter(self.roots.values()))
        leaf = self.fall(q, np.full(len(q), root), coin)
        leaf = np.where(self.cells[leaf] > 0, leaf, self.cells.argmax())
        return (self.starts[leaf] + (coin & 0x3FFFFFFF) % self.cells[leaf]).astype("int32")

    def reached(self, q: np.ndarray, reach: np.ndarray):
        """Pairs (row, cell) of all cells that may have donors within ``reach``, row by row."""
        out, step = [], max(1, CHUNK_PAIRS // max(self.leaves, 1))
        has = (~np.isnan(q)).sum(axis=1)
        for s in range(0, len(q), step):
            top = len(self.levels[-1][0])
            row = np.repeat(np.arange(s, min(s + step, len(q))), top)
            node = np.tile(np.arange(top), len(row) // top)
            for i, (low, high) in reversed(list(enumerate(self.levels))):
                apart = np.fmax(np.fmax(low[node] - q[row], q[row] - high[node]), 0.0)
                bound = np.sqrt((apart * apart).sum(axis=1) * (q.shape[1] / has[row]))
                near = bound * (1 - 1e-9) <= reach[row]
                row, node = row[near], node[near]
                if i:
                    row = np.repeat(row, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    real = node < len(self.levels[i - 1][0])
                    row, node = row[real], node[real]
            out.append((np.repeat(row, self.cells[node]), _runs(self.starts[node], self.cells[node])))
        return tuple(np.concatenate(c) for c in zip(*out))


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Whole numbers of 62 evenly spread bits, one per id."""
    with np.errstate(over="ignore"):
        h = ids.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(2)).astype("int64")


def _packer(layout: _Layout, block_rows: int):
    """Deal donors of many batches to leaves, and pack those of a leaf into blocks."""

    def pack(batches):
        held, many = [], 0
        for batch in batches:
            held.append(np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]))
            many += len(held[-1])
            if many >= PACK_ROWS:
                yield from blocks(np.concatenate(held))
                held, many = [], 0
        if many:
            yield from blocks(np.concatenate(held))

    def blocks(x):
        leaf = layout.leaf_of(x)
        order = np.argsort(leaf, kind="stable")
        x, leaf = x[order], leaf[order]
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        ends = np.r_[starts[1:], len(leaf)]
        codec = pa.Codec("zstd", compression_level=1)
        out = []
        for s, e in zip(starts, ends):
            for b in range(s, e, block_rows):
                own = x[b : min(b + block_rows, e)]
                gap = np.isnan(own)
                low = np.where(gap, -np.inf, own).min(axis=0)
                high = np.where(gap, np.inf, own).max(axis=0)
                # bytes of equal weight lie together
                split = np.ascontiguousarray(own.T).view(np.uint8).reshape(own.shape[1], len(own), 8)
                data = codec.compress(split.transpose(0, 2, 1).tobytes(), asbytes=True)
                out.append((int(leaf[b]), len(own), low.tolist(), high.tolist(), data))
        for s in range(0, len(out), 1_000):
            part = list(zip(*out[s : s + 1_000]))
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(part, kinds)], ["_leaf", "_rows", "_low", "_high", "_data"]
            )

    return pack


def _unpacked(rows: np.ndarray, data, p: int) -> np.ndarray:
    codec, parts = pa.Codec("zstd"), []
    for n, d in zip(rows, data):
        split = np.frombuffer(codec.decompress(d, int(n) * p * 8), np.uint8).reshape(p, 8, int(n))
        parts.append(np.ascontiguousarray(split.transpose(0, 2, 1)).view(float)[:, :, 0])
    return np.ascontiguousarray(np.concatenate(parts, axis=1).T)


def _visit(cells, visits, target: int, k: int, visitor_rows: int, layout: _Layout | None) -> DataFrame:
    """Nearest donors within reach per visiting row in every cell it visits.

    With a ``layout``, also the distance of the k-th of them, the row and the other
    cells that are not farther; rows that find nothing and need no other cell are left out.
    """
    # visitors of a cell are split, so one popular cell is not one task
    loads = visits.groupBy("_cell").agg(F.count("*").alias("_load"))
    # one row per cell, and donors are not shuffled twice
    loads = F.broadcast(loads.select("_cell", (1 + F.floor(F.col("_load") / visitor_rows)).cast("int").alias("_parts")))
    guests = visits.join(loads, "_cell").withColumn("_part", hashed_bucket(F.col("_id"), F.col("_parts")))
    hosts = cells.join(loads, "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    # fresh names on the donor side keep the two sides of the cogroup apart
    hosts = hosts.select(
        F.col("_cell").alias("_host"), F.col("_part").alias("_hpart"), F.col("_rows").alias("_hrows"), "_data"
    )
    def cell_search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left["_id"].to_numpy()
        limit = left["_reach"].to_numpy()
        q = pc.list_flatten(left["_row"]).to_numpy().astype(float).reshape(len(ids), -1)
        row, dist, value = np.empty(0, int), np.empty(0), np.empty(0)
        if right.num_rows:
            x = _unpacked(right["_hrows"].to_numpy(), right["_data"].to_pylist(), q.shape[1])
            row, dist, value = _boxed_nearest(q, x, x[:, target], k, limit)
        many = np.bincount(row, minlength=len(ids))
        last = many.cumsum()
        out = {"_id": ids, "_near": _listed(many, pa.StructArray.from_arrays([pa.array(dist), pa.array(value)], ["_dist", "_value"]))}
        keep = many > 0
        if layout is not None:
            reach = np.full(len(ids), np.inf)
            full = many >= k
            reach[full] = dist[last[full] - 1]
            at, cell = layout.reached(q, reach)
            other = cell != left["_cell"][0].as_py()
            at, cell = at[other], cell[other]
            needs = np.bincount(at, minlength=len(ids))
            out |= {"_reach": reach, "_cells": _listed(needs, pa.array(cell, pa.int32()))}
            # the row itself goes on only if it visits more cells
            out["_row"] = _listed(np.where(needs > 0, q.shape[1], 0), pa.array(q[needs > 0].ravel()))
            keep = keep | (needs > 0)
        return pa.table(out).filter(pa.array(keep))

    schema = "_id long, _near array<struct<_dist: double, _value: double>>"
    if layout is not None:
        schema += ", _reach double, _cells array<int>, _row array<double>"
    return (
        guests.select("_cell", "_part", "_id", "_reach", "_row").groupBy("_cell", "_part")
        .cogroup(hosts.groupBy("_host", "_hpart"))
        .applyInArrow(cell_search, schema)
    )


def _listed(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, sizes.cumsum()], pa.int32()), values)


def _top(candidates: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("_id").orderBy("_dist", "_value")
    return candidates.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
