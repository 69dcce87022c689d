"""Density-based outliers: clusters of crowded points, and noise apart from them.

Space is cut into cells so small that all points of a cell are neighbours.  A
cell holding enough rows makes all its points core without a single distance;
only points of sparse cells, fewer than ``min_rows`` a cell, are compared with
the cells around them.  Whether two crowded cells touch is found by splitting
both and keeping only pairs of parts whose bounding boxes leave it open, so the
work follows the boundary between cells and not the square of their points.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.functions.graphs import connected
from gramlark.session import stage


def _cell(x: Column, side: float) -> Column:
    return F.floor(x / F.lit(side))


def _reach(dims: int) -> list[tuple[int, ...]]:
    """Offsets of the cells that may hold a neighbour of a point in a cell of side eps / sqrt(dims)."""
    far = math.ceil(math.sqrt(dims))
    # the nearest points of two cells lie |o| - 1 sides apart in a dimension
    near = lambda o: sum(max(0, abs(v) - 1) ** 2 for v in o) <= dims
    return [o for o in itertools.product(range(-far, far + 1), repeat=dims) if near(o)]


def _cells_around(cells: Column, dims: int) -> Column:
    """An array of all cells in reach of a cell (an array of numbers)."""
    offsets = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in _reach(dims)])
    return F.transform(offsets, lambda o: F.zip_with(cells, o, lambda a, b: a + b))


def _squared(a: str, b: str, dims: int) -> Column:
    parts = [(F.col(f"{a}{i}") - F.col(f"{b}{i}")) * (F.col(f"{a}{i}") - F.col(f"{b}{i}")) for i in range(dims)]
    return sum(parts[1:], parts[0])


def _touching(core: DataFrame, dims: int, side: float, eps: float) -> DataFrame:
    """Pairs ``(a, b)`` of cells of which some core points are at most ``eps`` apart.

    Level by level the cells are halved in every dimension.  Pairs of parts whose
    bounding boxes are farther apart than ``eps`` are dropped, pairs that lie
    within ``eps`` as a whole link their cells, the others are split.  A box
    around a single point leaves nothing open, so this ends.
    """
    linked, level, pairs = None, 0, None
    core = core.select("cell", *[f"x{i}" for i in range(dims)])
    while True:
        part = F.array(*[_cell(F.col(f"x{i}"), side / 2**level) for i in range(dims)])
        up = F.array(*[_cell(F.col(f"x{i}"), side / 2 ** max(0, level - 1)) for i in range(dims)])
        ends = [f(f"x{i}").alias(f"{n}{i}") for i in range(dims) for f, n in ((F.min, "l"), (F.max, "h"))]
        boxes = stage(core.groupBy("cell", up.alias("up"), part.alias("part")).agg(*ends), "boxes")
        fields = ["cell", "up", "part"] + [f"{n}{i}" for i in range(dims) for n in "lh"]
        a, b = (boxes.select([F.col(c).alias(f"{s}_{c}") for c in fields]) for s in "ab")
        if level == 0:
            a = a.select("*", F.explode(_cells_around(F.col("a_cell"), dims)).alias("b_cell"))
            open_ = a.join(b, "b_cell").where("a_cell < b_cell")
        else:
            open_ = pairs.join(a, ["a_cell", "a_up"]).join(b, ["b_cell", "b_up"])
        gap, span = F.lit(0.0), F.lit(0.0)
        for i in range(dims):
            al, ah, bl, bh = (F.col(f"{s}_{n}{i}") for s in "ab" for n in "lh")
            least = F.greatest(al - bh, bl - ah, F.lit(0.0))
            most = F.greatest(ah - bl, bh - al)
            gap, span = gap + least * least, span + most * most
        near = gap <= F.lit(eps * eps)
        open_ = open_.where(near).select(
            "a_cell", "b_cell", F.col("a_part").alias("a_up"), F.col("b_part").alias("b_up"), (span <= F.lit(eps * eps)).alias("sure")
        )
        open_ = stage(open_, "boxpairs")
        found = open_.where("sure").select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b")).distinct()
        linked = found if linked is None else linked.union(found)
        done = found.select(F.col("a").alias("a_cell"), F.col("b").alias("b_cell"))
        pairs = stage(open_.where("NOT sure").drop("sure").join(done, ["a_cell", "b_cell"], "left_anti"), "boxpairs")
        if pairs.isEmpty():
            return linked
        left = pairs.select(F.explode(F.array("a_cell", "b_cell")).alias("cell")).distinct()
        core, level = core.join(left, "cell", "left_semi"), level + 1


def density_clusters(df: DataFrame, columns: list[str], key: str, eps: float, min_rows: int) -> DataFrame:
    """``(key, cluster, is_core, is_noise)`` of every row that has all ``columns``.

    A row is core if at least ``min_rows`` rows, itself included, lie at most
    ``eps`` away (Euclidean).  Core rows within ``eps`` are of one cluster, named
    by the smallest ``key`` of its core rows; other rows within ``eps`` of core rows
    get the smallest of their clusters; the rest is noise with a null cluster.
    Rows with a null or non-finite value are left out.  Rows at the same place
    are one weighted point throughout.
    """
    dims, side = len(columns), eps / math.sqrt(len(columns)) * (1 - 1e-12)
    xs = [f"x{i}" for i in range(dims)]
    rows = df.select(F.col(key).alias("key"), *[(F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(columns, xs)])
    for x in xs:
        rows = rows.where(F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    points = rows.groupBy(*xs).agg(F.min("key").alias("point"), F.count("*").alias("weight"))
    points = stage(points.select("*", F.array(*[_cell(F.col(x), side) for x in xs]).alias("cell")), "points")
    cells = points.groupBy("cell").agg(F.sum("weight").alias("rows"))
    points = points.join(cells, "cell")
    sparse = points.where(F.col("rows") < min_rows).select("point", "cell", *xs, "weight")
    asks = sparse.select(F.col("point").alias("ask"), *[F.col(x).alias(f"q{i}") for i, x in enumerate(xs)], F.explode(_cells_around(F.col("cell"), dims)).alias("cell"))
    pairs = asks.join(points.select("cell", "point", "weight", *xs), "cell")
    pairs = stage(pairs.where(_squared("q", "x", dims) <= F.lit(eps * eps)).select("ask", "point", "weight"), "near")
    core_asks = pairs.groupBy("ask").agg(F.sum("weight").alias("n")).where(F.col("n") >= min_rows).select(F.col("ask").alias("point"))
    core = points.where(F.col("rows") >= min_rows).unionByName(points.join(core_asks, "point", "left_semi").select(points.columns))
    core = stage(core.select("point", "cell", *xs), "core")
    touching = _touching(core, dims, side, eps).select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    alone = core.select(F.col("cell").cast("string").alias("a")).distinct().select("a", F.col("a").alias("b"))
    groups = connected(touching.union(alone))
    named = core.select("point", F.col("cell").cast("string").alias("node")).join(groups, "node")
    names = named.groupBy("component").agg(F.min("point").alias("cluster"))
    named = stage(named.join(names, "component").select("point", "cluster"), "clusters")
    border = pairs.join(named, "point").groupBy(F.col("ask").alias("point")).agg(F.min("cluster").alias("cluster"))
    border = border.join(named, "point", "left_anti").select("point", "cluster", F.lit(False).alias("is_core"))
    labels = named.select("point", "cluster", F.lit(True).alias("is_core")).unionByName(border)
    out = points.select("point", *xs).join(labels, "point", "left")
    placed = rows.join(out, xs)
    return placed.select(
        F.col("key").alias(key), "cluster", F.coalesce("is_core", F.lit(False)).alias("is_core"), F.col("cluster").isNull().alias("is_noise")
    )
