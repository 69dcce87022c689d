"""Approximate nearest neighbours over learned, balanced partitions.

A neighbour graph of a bounded sample is cut into parts of equal size with few
edges between them; a small classifier learns from each sampled row the parts of
its neighbours.  It files every row under its likeliest part and routes a query
to as many of its likeliest parts as the sample needed for the wanted recall;
what is found there is ranked by exact inner products.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gramlark.llm.vectors import by_number, matrix, sample, usable


@dataclass(frozen=True)
class Router:
    """One hidden layer; ``probes`` is the number of parts a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def route(self, x: np.ndarray, many: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :many]


def nearest_rows(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k largest inner products of each query row with ``x``, its own left out."""
    out = np.empty((len(queries), min(k, max(0, len(x) - 1))), "int64")
    for at in range(0, len(queries), 512):
        rows = queries[at : at + 512]
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        if out.shape[1]:
            out[at : at + 512] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(near: np.ndarray, start: np.ndarray, parts: int, rounds: int = 8, slack: float = 0.05) -> np.ndarray:
    """Parts of at most (1 + slack) of the mean size, by moving rows to their neighbours' parts.

    ``start`` holds a preference value per row and part for the first filling.
    """
    n = len(near)
    room = math.ceil(n / parts * (1 + slack))
    part, size = np.full(n, -1), np.zeros(parts, "int64")
    wish = np.argsort(-start, axis=1)
    for i in np.argsort(-start.max(axis=1), kind="stable"):
        for p in wish[i]:
            if size[p] < room:
                part[i], size[p] = p, size[p] + 1
                break
    both = [list(r) for r in near]
    for i, row in enumerate(near):
        for j in row:
            both[j].append(i)
    for _ in range(rounds):
        moved = 0
        for i in range(n):
            votes = np.bincount(part[both[i]], minlength=parts)
            for p in np.argsort(-votes, kind="stable")[:3]:
                if votes[p] <= votes[part[i]]:
                    break
                if size[p] < room:
                    size[part[i]] -= 1
                    part[i], size[p], moved = p, size[p] + 1, moved + 1
                    break
        if not moved:
            break
    return part


def train(x: np.ndarray, parts: int, k: int = 20, recall: float = 0.97, hidden: int = 96, epochs: int = 25) -> Router:
    """Router of a sample; ``probes`` is the fewest parts that reach ``recall`` on it."""
    rng = np.random.default_rng(11)
    n, d = x.shape
    parts = max(1, min(parts, n // 4 or 1))
    near = nearest_rows(x, np.arange(n), min(k, 10))
    seeds = x[rng.choice(n, parts, replace=False)]
    part = balanced_parts(near, x @ seeds.T, parts)
    goal = np.zeros((n, parts))
    goal[np.arange(n), part] += 1
    for j in range(near.shape[1]):
        goal[np.arange(n), part[near[:, j]]] += 1
    goal /= goal.sum(1, keepdims=True)
    weights = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, 0.1, (hidden, parts)), np.zeros(parts)]
    scale = 1 / (x.std() + 1e-12)
    m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            rows = order[at : at + 128]
            xb = x[rows] * scale
            h = np.maximum(xb @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            dz = (p - goal[rows]) / len(rows)
            dh = (dz @ weights[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((xb.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] = weights[i] - 2e-3 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    router = Router(weights[0] * scale, weights[1], weights[2], weights[3], parts)
    queries = rng.choice(n, min(n, 500), replace=False)
    truth = nearest_rows(x, queries, k)
    if not truth.size:
        return router
    filed = router.route(x, 1)[:, 0]
    visited = router.route(x[queries], parts)
    place = np.argsort(visited, axis=1)  # of each part in the query's order
    need = np.take_along_axis(place, filed[truth], axis=1)
    share = np.array([(need < c).mean() for c in range(1, parts + 1)])
    probes = int(np.argmax(share >= recall)) + 1
    return Router(router.w1, router.b1, router.w2, router.b2, probes)


def search(
    base: DataFrame,
    is_query,
    k: int = 20,
    sample_rows: int = 4_096,
    parts: int = 16,
    recall: float = 0.97,
    block: int = 65_536,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row where ``is_query``.

    The router is trained on at most ``sample_rows`` rows; every row is filed and
    can be found.  Rows of a part meet its visitors in blocks of about ``block``
    rows a side, each returning at most k rows a query; more rows make more blocks.  Rows that
    share a query's ``vec_id`` are its own and no candidates.  Unusable vectors
    take no part.
    """
    rows = base.where(usable()).where("vec_id IS NOT NULL")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"), is_query.alias("q"))
    x = sample(rows, sample_rows, "vec_id", "e")
    spark = base.sparkSession
    result = "query_id long, vec_id long, score double"
    if len(x) < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = train(x, parts, k, recall)
    model = spark.sparkContext.broadcast(router)  # bounded by `parts` and the vectors' width

    @F.pandas_udf("array<int>")
    def parts_of(e: pd.Series, q: pd.Series) -> pd.Series:
        found = model.value.route(matrix(e), model.value.probes)
        return pd.Series([list(f) if asks else [f[0]] for f, asks in zip(found.astype("int32"), q)])

    filed = rows.select("vec_id", "e", "q", parts_of("e", "q").alias("parts"))
    sizes = filed.select("q", F.posexplode("parts").alias("at", "part")).groupBy("part").agg(
        F.count_if(F.col("at") == 0).alias("rows"), F.count_if("q").alias("asks")
    )
    n_rows, n_asks = [1] * router.parts, [1] * router.parts
    for r in sizes.collect():
        n_rows[r.part], n_asks[r.part] = math.ceil((r.rows or 1) / block) or 1, math.ceil((r.asks or 1) / block) or 1
    own = filed.select("vec_id", "e", F.col("parts")[0].alias("part"))
    own = own.withColumn("slot", F.pmod(F.xxhash64("vec_id"), by_number(n_rows, "part")).cast("int"))
    own = own.withColumn("turn", F.explode(F.sequence(F.lit(0), by_number(n_asks, "part") - 1)))
    asks = filed.where("q").select("vec_id", "e", F.explode("parts").alias("part"))
    asks = asks.withColumn("turn", F.pmod(F.xxhash64("vec_id"), by_number(n_asks, "part")).cast("int"))
    asks = asks.withColumn("slot", F.explode(F.sequence(F.lit(0), by_number(n_rows, "part") - 1)))

    def nearest(b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, "int64")], [np.zeros(0, "int64")], [np.zeros(0)]
        if len(a) and len(b):
            ids, y, ask = b.vec_id.to_numpy(), matrix(b.e), a.vec_id.to_numpy()
            xs = matrix(a.e)
            for at in range(0, len(xs), 64):
                scores = xs[at : at + 64] @ y.T
                for i, s in enumerate(scores, at):
                    s[ids == ask[i]] = -np.inf
                    cut = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                    near = np.flatnonzero((s >= cut - 1e-9 * abs(cut)) & (s > -np.inf)) if np.isfinite(cut) else np.flatnonzero(s > -np.inf)
                    exact = (y[near] * xs[i]).sum(axis=1)  # equal vectors get equal sums here
                    best = np.lexsort((ids[near], -exact))[:k]
                    out[0].append(np.full(len(best), ask[i]))
                    out[1].append(ids[near[best]])
                    out[2].append(exact[best])
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, out))))

    keys = ["part", "slot", "turn"]
    found = own.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(nearest, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
