"""Near-duplicate vectors by product quantisation over coarse inverted lists.

Equal vectors are one class.  A class is filed in the list of its nearest coarse
centre with subspace codes of its residual; a query looks its distances up in
tables, drops what even the code's known error can't bring within reach, and
takes exact cosines of the rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import components
from gramlark.llm.vectors import by_number, kmeans, matrix, sample, usable
from gramlark.session import stage


@dataclass(frozen=True)
class Codebook:
    centres: np.ndarray
    words: list[np.ndarray]  # one table of code words per subspace
    cuts: list[int]
    probes: int

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared, to the coarse centres, less each row's own norm."""
        return (self.centres**2).sum(1) - 2 * x @ self.centres.T

    def lists(self, x: np.ndarray) -> np.ndarray:
        """Lists to probe, nearest first."""
        return np.argsort(self.distances(x), axis=1, kind="stable")[:, : self.probes]

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each residual from what its codes stand for."""
        codes, error = np.empty((len(residual), len(self.words)), "u1"), np.zeros(len(residual))
        for k, w in enumerate(self.words):
            r = residual[:, self.cuts[k] : self.cuts[k + 1]]
            d = (w**2).sum(1) - 2 * r @ w.T
            codes[:, k] = d.argmin(1)
            error += ((r - w[codes[:, k]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def table(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of each row's subvectors to every code word: (rows, subspaces, words)."""
        out = np.full((len(residual), len(self.words), 256), np.inf, "float32")
        for k, w in enumerate(self.words):
            r = residual[:, self.cuts[k] : self.cuts[k + 1]]
            out[:, k, : len(w)] = (r**2).sum(1)[:, None] - 2 * r @ w.T + (w**2).sum(1)
        return out


def train(x: np.ndarray, lists: int, cosine: float, subspaces: int = 8, miss: float = 0.001) -> Codebook:
    """Codebook of a sample of unit vectors.

    ``probes`` is the fewest lists at which pairs made at exactly the wanted
    cosine, in random directions from sampled rows, are missed at most ``miss``
    of the time, when either side of a pair may find the other.
    """
    rng = np.random.default_rng(5)
    n, d = x.shape
    centres = kmeans(x, lists)
    near = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
    residual = x - centres[near]
    cuts = [round(d * k / min(subspaces, d)) for k in range(min(subspaces, d) + 1)]
    words = [kmeans(residual[:, a:b], 256, rounds=6) for a, b in zip(cuts, cuts[1:])]
    a = x[rng.choice(n, 4_000)]
    u = rng.normal(size=a.shape)
    u -= (u * a).sum(1, keepdims=True) * a
    b = cosine * a + (1 - cosine**2) ** 0.5 * u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
    da, db = ((centres**2).sum(1) - 2 * v @ centres.T for v in (a, b))
    place = lambda own, other: (own < own[np.arange(len(own)), other.argmin(1)][:, None]).sum(1)
    need = np.minimum(place(da, db), place(db, da))
    probes = int(np.quantile(need, 1 - miss, method="higher")) + 1
    return Codebook(centres, words, cuts, min(probes, len(centres)))


def _links(item: pd.DataFrame, query: pd.DataFrame, book: Codebook, cosine: float) -> pd.DataFrame:
    """Links of a block of one list with a block of its visitors, as counts and local roots per class."""
    none = pd.DataFrame({"id": np.zeros(0, "int64"), "links": np.zeros(0, "int64"), "root": np.zeros(0, "int64")})
    if not len(item) or not len(query):
        return none
    y, x = matrix(item.e), matrix(query.e)
    uy = y / np.linalg.norm(y, axis=1, keepdims=True)
    ux = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = book.centres[item.list.iloc[0]]
    codes = np.stack([np.frombuffer(c, "u1") for c in item.codes])
    reach = ((2 - 2 * cosine) ** 0.5 + item.error.to_numpy() + 1e-4) ** 2
    ids, iq = item.id.to_numpy("int64"), query.id.to_numpy("int64")
    n_item, n_query = item.n.to_numpy("int64"), query.n.to_numpy("int64")
    visits = np.zeros((len(item), len(book.centres)), bool)
    for i, p in enumerate(item.lists):
        visits[i, p] = True
    away = query.lists.map(lambda p: p[0]).to_numpy("int64")  # the visitors' own lists
    every = np.unique(np.concatenate([ids, iq]))
    at_item, at_query = np.searchsorted(every, ids), np.searchsorted(every, iq)
    count, root = np.zeros(len(every), "int64"), np.arange(len(every))
    for at in range(0, len(x), 256):
        table = book.table(ux[at : at + 256] - centre)
        d = np.zeros((table.shape[0], len(item)), "float32")
        for k in range(codes.shape[1]):
            d += table[:, k, codes[:, k]]
        q, i = np.nonzero(d <= reach)
        q += at
        keep = iq[q] != ids[i]
        # a pair that the other side finds too counts where the smaller id asks
        keep &= ~visits[i, away[q]] | (iq[q] < ids[i])
        q, i = q[keep], i[keep]
        near = np.concatenate([np.einsum("ij,ij->i", ux[q[s : s + 65_536]], uy[i[s : s + 65_536]]) for s in range(0, len(q), 65_536)] or [np.zeros(0)])
        q, i = q[near >= cosine], i[near >= cosine]
        np.add.at(count, at_query[q], n_item[i])
        np.add.at(count, at_item[i], n_query[q])
        a, b = at_query[q], at_item[i]
        while True:
            low = np.minimum(root[a], root[b])
            if not ((root[a] != low) | (root[b] != low)).any():
                break
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root = root[root]
    linked = count > 0
    return pd.DataFrame({"id": every[linked], "links": count[linked], "root": every[root[linked]]})


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.9,
    sample_rows: int = 8_192,
    rows_per_list: int = 1_000,
    max_lists: int = 1_024,
    block: int = 4_096,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Links join rows of cosine at least ``cosine``.  The codebook is trained on at
    most ``sample_rows`` classes; every class is filed and asks.  A list meets
    its visitors in blocks of at most about ``block`` rows a side, and a block
    returns one row per class in it (link count, local root), never pairs.  Rows
    with a null ``vec_id`` or an unusable vector link with nothing.
    """
    spark = vectors.sparkSession
    good = vectors.where(usable()).where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), "embedding")
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    # rows may repeat a vec_id with another vector, so ids of classes are made unique by place
    classes = stage(classes.select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("low"), "n", "embedding"), "classes")
    x = sample(classes, sample_rows, "low")
    every = vectors.select(F.col("vec_id").cast("long"), "embedding")
    if not len(x):
        out = every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    total = classes.count()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    book = train(x, min(max_lists, max(4, math.ceil(total / rows_per_list))), cosine)
    model = spark.sparkContext.broadcast(book)  # bounded by max_lists and the vectors' width

    @F.pandas_udf("struct<lists:array<int>,codes:binary,error:double>")
    def filed(e: pd.Series) -> pd.DataFrame:
        v = matrix(e)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        lists = model.value.lists(v)
        codes, error = model.value.encode(v - model.value.centres[lists[:, 0]])
        return pd.DataFrame({"lists": list(lists.astype("int32")), "codes": [c.tobytes() for c in codes], "error": error})

    coded = classes.select("id", "n", F.col("embedding").alias("e"), filed("embedding").alias("f")).select("id", "n", "e", "f.*")
    coded = stage(coded, "codes")
    sizes = coded.select(F.posexplode("lists").alias("at", "list")).groupBy("list").agg(
        F.count_if(F.col("at") == 0).alias("rows"), F.count("*").alias("asks")
    )
    n_rows, n_asks = [1] * len(book.centres), [1] * len(book.centres)
    for r in sizes.collect():
        n_rows[r.list], n_asks[r.list] = max(1, math.ceil(r.rows / block)), max(1, math.ceil(r.asks / block))
    item = coded.select("id", "n", "e", "lists", "codes", "error", F.col("lists")[0].alias("list"))
    item = item.withColumn("slot", F.pmod(F.xxhash64("id"), by_number(n_rows, "list")).cast("int"))
    item = item.withColumn("turn", F.explode(F.sequence(F.lit(0), by_number(n_asks, "list") - 1)))
    asks = coded.select("id", "n", "e", F.slice("lists", 1, 1).alias("lists"), F.explode("lists").alias("list"))
    asks = asks.withColumn("turn", F.pmod(F.xxhash64("id"), by_number(n_asks, "list")).cast("int"))
    asks = asks.withColumn("slot", F.explode(F.sequence(F.lit(0), by_number(n_rows, "list") - 1)))
    keys = ["list", "slot", "turn"]
    each = lambda a, b: _links(a, b, model.value, cosine)
    found = item.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(each, "id long, links long, root long")
    found = stage(found, "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    named = classes.join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    named = stage(
        named.select("embedding", "low", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("c")),
        "named",
    )
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    named = stage(named.join(lows, "c").select("embedding", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id"), "named")
    out = every.where(usable() & F.col("vec_id").isNotNull()).join(named, "embedding").select("vec_id", "n_links", "component_id")
    rest = every.where(~(usable() & F.col("vec_id").isNotNull()))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
