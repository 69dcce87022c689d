"""Geographic clusters: k-means over coordinates, distances, cluster statistics.

Equal coordinates are counted first and clustered once with their count as a
weight, which gives the same centres and shrinks the data the iterations read.
Points are written down in blocks, so that a pass costs its arithmetic.  All starts
move together: a pass over the points gives the sums of every cluster
of every start that still moves, so ten starts need the passes of the slowest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.schema import TARGET
from gramlark.session import release, stage

COORDINATES = ["latitude", "longitude"]


def weighted_points(
    df: DataFrame, columns: list[str] = COORDINATES, restage: bool = False
) -> DataFrame:
    """Distinct complete points with their row counts, assembled for ``ml``."""
    complete = df.select(*columns).na.drop()
    counts = complete.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))
    if restage:
        counts = stage(counts, "points")
    return VectorAssembler(inputCols=columns, outputCol="x").transform(counts)


def nearest_center(columns: list[str], centers: np.ndarray):
    """(label, distance) expressions; the first of equally near centres wins."""
    distances = []
    for center in centers:
        parts = [F.pow(F.col(c) - F.lit(float(v)), F.lit(2.0)) for c, v in zip(columns, center)]
        distances.append(F.sqrt(sum(parts[1:], parts[0])))
    best = F.array_min(F.array(*distances))
    label = (F.array_position(F.array(*distances), best) - 1).cast("int")
    return label, best


def first_centers(points: DataFrame, columns: list[str], k: int, starts: int, seed: int) -> list[np.ndarray]:
    """Per start the ``k`` points with the smallest hash of the start and the point's millionths.

    Only hashes below a bound that about 64 points of a start meet are fetched;
    the bound is raised until every start has its points.
    """
    count = points.count()
    if not count:
        raise ValueError("no complete points to cluster")
    k, wanted = min(k, count), 16 * k
    parts = [F.round(F.col(c) * 1_000_000).cast("bigint").cast("string") for c in columns]
    each = points.withColumn("start", F.explode(F.sequence(F.lit(seed), F.lit(seed + starts - 1))))
    each = each.withColumn("h", F.md5(F.concat_ws("/", F.col("start").cast("string"), *parts)))
    while True:
        bound = min(1.0, wanted / count)
        near = each if bound == 1.0 else each.where(F.col("h") < f"{int(bound * 2**64):016x}")
        rows: dict[int, list] = {seed + i: [] for i in range(starts)}
        for r in near.select("start", "h", *columns).collect():
            rows[r.start].append(tuple(r)[1:])
        if bound == 1.0 or min(map(len, rows.values())) >= k:
            return [np.array([r[1:] for r in sorted(found)[:k]]) for found in rows.values()]
        wanted *= 16


def _blocks(points: DataFrame, columns: list[str]) -> DataFrame:
    """Coordinates and weights written down, a batch of points in one value, for the passes that follow."""

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                cells = np.stack([c.to_numpy(zero_copy_only=False).astype("float64", copy=False) for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array([cells.tobytes()], pa.binary())], names=["cells"])

    return stage(points.select(*columns, "weight").mapInArrow(pack, "cells binary"), "point-blocks")


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the centre nearest to each of the points ``x[column]``; the first of equally near ones."""
    near, best = np.zeros(x.shape[1], "int64"), np.full(x.shape[1], np.inf)
    for k, center in enumerate(centers):
        d = sum((v - c) ** 2 for v, c in zip(x, center))
        near[d < best] = k
        np.minimum(best, d, out=best)
    return near, best


def _move(blocks: DataFrame, columns: list[str], centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per start ``[cluster, (rows, sums of the columns, squared distances)]`` under its centres, in one pass."""

    def fold(batches):
        sums = {s: np.zeros((len(c), len(columns) + 2)) for s, c in centers.items()}
        for batch in batches:
            for block in batch.column(0):
                *x, w = np.frombuffer(block.as_buffer(), "float64").reshape(len(columns) + 1, -1)
                x, weighted = np.stack(x), [v * w for v in x]
                for s, c in centers.items():
                    near, d = _nearest(x, c)
                    sums[s] += np.column_stack([np.bincount(near, v, len(c)) for v in (w, *weighted, d * w)])
        rows = [(s, m.ravel().tolist()) for s, m in sums.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.int32()), pa.array([m for _, m in rows], pa.list_(pa.float64()))], names=["s", "cells"]
        )

    cells = blocks.mapInArrow(fold, "s int, cells array<double>")
    out = {s: np.zeros((len(c), len(columns) + 2)) for s, c in centers.items()}
    for r in cells.select("s", F.posexplode("cells").alias("at", "v")).groupBy("s", "at").agg(F.sum("v").alias("v")).collect():
        out[r.s].flat[r["at"]] = r.v
    return out


@dataclass
class GeoClusters:
    """k-means from ``n_init`` starts, the one with the smallest squared distances is kept.

    A start ends when its centres move, in squares, by no more than ``tol`` of
    the coordinates' mean variance.  A cluster without points keeps its centre.
    """

    k: int = 5
    seed: int = 42
    n_init: int = 10
    max_iter: int = 300
    tol: float = 1e-4
    target: str = TARGET
    columns: list[str] = field(default_factory=lambda: list(COORDINATES))
    centers: np.ndarray | None = None
    stats: dict[int, tuple] = field(default_factory=dict)
    cost: float = float("inf")

    def fit(self, df: DataFrame) -> "GeoClusters":
        points = weighted_points(df, self.columns, restage=True)
        spread = points.agg(*[
            (F.sum(F.expr(f"weight * `{c}` * `{c}`")) / F.sum("weight") - (F.sum(F.expr(f"weight * `{c}`")) / F.sum("weight")) ** 2).alias(f"v{i}")
            for i, c in enumerate(self.columns)
        ]).first()
        starts = first_centers(points, self.columns, self.k, max(1, self.n_init), self.seed)
        limit = self.tol * max(0.0, float(np.mean([v or 0.0 for v in spread])))
        centers, moving = dict(enumerate(starts)), set(range(len(starts)))
        blocks = _blocks(points, self.columns)
        for _ in range(self.max_iter):
            for s, m in _move(blocks, self.columns, {s: centers[s] for s in sorted(moving)}).items():
                rows = m[:, [0]]
                new = np.where(rows > 0, m[:, 1:-1] / np.maximum(rows, 1e-300), centers[s])
                if ((new - centers[s]) ** 2).sum() <= limit:
                    moving.discard(s)
                centers[s] = new
            if not moving:
                break
        costs = {s: float(m[:, -1].sum()) for s, m in _move(blocks, self.columns, centers).items()}
        release(blocks)
        # starts that end in the same clusters differ by rounding only: the first of them
        best = min(s for s in costs if costs[s] <= min(costs.values()) * (1 + 1e-9))
        self.centers, self.cost = centers[best], costs[best]
        if self.target in df.columns:
            self.stats = {
                r["geo_cluster"]: (r["mean"], r["std"], r["count"])
                for r in cluster_stats(self.assign(df), self.target).collect()  # k rows
            }
        return self

    def assign(self, df: DataFrame) -> DataFrame:
        label, distance = nearest_center(self.columns, self.centers)
        return df.withColumns({"geo_cluster": label, "geo_cluster_distance": distance})

    def transform(self, df: DataFrame) -> DataFrame:
        """Label, distance and, if fitted with a target, the cluster's statistics."""
        out = self.assign(df)
        if not self.stats:
            return out
        rows = [(k, *map(_num, v)) for k, v in sorted(self.stats.items())]
        table = df.sparkSession.createDataFrame(
            rows,
            "geo_cluster int, cluster_mean_value double, cluster_std_value double, count double",
        )
        # k rows; a cluster without training rows keeps its rows with NULL statistics
        joined = out.join(F.broadcast(table), "geo_cluster", "left")
        return joined.select(*out.columns, "cluster_mean_value", "cluster_std_value", "count")


def _num(v):
    return None if v is None else float(v)


def cluster_stats(assigned: DataFrame, target: str = TARGET) -> DataFrame:
    return assigned.groupBy("geo_cluster").agg(
        F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.count(target).alias("count")
    )


def silhouette(df: DataFrame, clusters: GeoClusters) -> float:
    """Mean silhouette under squared Euclidean distance, over all rows."""
    points = clusters.assign(weighted_points(df, clusters.columns))
    return ClusteringEvaluator(
        featuresCol="x", predictionCol="geo_cluster", metricName="silhouette",
        distanceMeasure="squaredEuclidean", weightCol="weight",
    ).evaluate(points)
