"""Quality by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import column_map, sigmoid

SYMBOLS = b"#$%&*|<>{}[]=/\\@~^_+"
WORD_END = re.compile(r"[^\W_]$")


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all 0 for an empty or null one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n, m = len(raw), len(words)
    if not m:
        return [0.0] * WIDTH
    c = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    share = c / n
    some = share[share > 0]
    letters = max(1, int(c[65:91].sum() + c[97:123].sum() + c[128:].sum()))
    size = np.fromiter(map(len, words), "int64", m)
    count = Counter(words)
    top = count.most_common(3)
    pairs = Counter(zip(words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in text.split("\n") if x.strip()]
    length = np.fromiter(map(len, lines), "int64", len(lines))
    first = sum(w[0].isupper() for w in words)
    upper = sum(w.isupper() for w in words)
    stop = sum(w[-1] in ".?!" for w in words)
    plain = sum(w.isalpha() for w in words)
    odd = sum(not w[-1].isalnum() and w[-1] not in ".,;:?!" for w in words)
    twice = sum(w[-2:] == "!!" for w in words)
    return [
        np.log1p(n),
        np.log1p(m),
        size.mean(),
        size.std(),
        np.log1p(size.max()),
        c[65:91].sum() / letters,
        share[48:58].sum(),
        share[9:14].sum() + share[32],
        share[list(SYMBOLS)].sum(),
        share[33],
        share[44],
        share[46],
        share[124],
        share[128:].sum(),
        -(some * np.log(some)).sum(),
        len(count) / m,
        len(count) / m**0.7,
        top[0][1] / m,
        sum(v for _, v in top) / m,
        sum(a == b for a, b in zip(words, words[1:])) / m,
        (pairs.most_common(1)[0][1] if pairs else 0) / m,
        len(pairs) / m,
        triples / m,
        first / m,
        upper / m,
        stop / m,
        plain / m,
        odd / m,
        twice / m,
        len(lines),
        length.mean(),
        length.std() / length.mean(),
        len(set(lines)) / len(lines),
        sum(v for v in count.values() if v == 1) / m,
        share[10] * 100,
        max(length) / n,
    ]


WIDTH = 36


@dataclass(frozen=True)
class Forest:
    """Complete trees laid out level by level: node i has children 2i+1 and 2i+2.

    ``feature`` and ``cut`` have a row of inner nodes per tree, ``leaf`` a row of
    leaf values; a row goes right where its feature is above the cut.
    """

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), "int64")
            while inner and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += v[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x)) if len(x) else np.zeros(0)


def boost(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 120,
    depth: int = 4,
    rate: float = 0.1,
    bins: int = 64,
    penalty: float = 1.0,
    least: float = 3.0,
) -> Forest:
    """Newton boosting of the logistic loss on histograms of at most ``bins`` quantile bins.

    ``least`` is the smallest sum of second derivatives of a child.
    """
    n, d = x.shape if len(x) else (0, WIDTH)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if n == 0 or len(set(y.tolist())) < 2:
        return Forest(base, np.zeros((0, inner), "int64"), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(d)]
    cell = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    flat = cell + np.arange(d) * bins
    feature, cut, leaf = [], [], []
    f = np.full(n, base)
    for _ in range(trees):
        p = sigmoid(f)
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, "int64")
        tf, tc = np.zeros(inner, "int64"), np.full(inner, np.inf)
        for level in range(depth):
            width, start = 2**level, 2**level - 1
            at = ((node - start)[:, None] * (d * bins) + flat).ravel()
            hist = [np.bincount(at, np.repeat(v, d), width * d * bins).reshape(width, d, bins) for v in (g, h)]
            left_g, left_h = (np.cumsum(v, axis=2) for v in hist)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - all_g**2 / (all_h + penalty)
            gain[(left_h < least) | (right_h < least)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for k, b in enumerate(best):
                j, c = divmod(int(b), bins)
                if gain[k, j, c] > 1e-6 and c < len(edges[j]):
                    tf[start + k], tc[start + k] = j, edges[j][c]
            node = 2 * node + 1 + (x[np.arange(n), tf[node]] > tc[node])
        bucket = node - inner
        sums = [np.bincount(bucket, v, inner + 1) for v in (g, h)]
        value = rate * sums[0] / (sums[1] + penalty)
        f += value[bucket]
        feature.append(tf), cut.append(tc), leaf.append(value)
    return Forest(base, np.array(feature), np.array(cut), np.array(leaf))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = 20_000, where=None) -> Forest:
    """Fit on at most ``max_rows`` labelled documents, chosen by hash of ``doc_id``.

    ``where`` restricts the label rows (to keep some held out).  Null labels are
    no labels; of repeated ones the largest counts.  Only the chosen ids are
    broadcast.
    """
    marks = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
    if where is not None:
        marks = marks.where(where)
    marks = marks.groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")

    def make():
        return lambda texts: pd.DataFrame({"x": [statistics(t) for t in texts]})

    rows = chosen.select("doc_id", "y", column_map(chosen, "text", "x array<double>", make)["x"].alias("x")).toPandas()
    rows["key"] = [tuple(x) for x in rows.x]
    rows = rows.sort_values(["doc_id", "key"], kind="stable")
    x = np.array(rows.x.tolist(), "float64").reshape(len(rows), -1)
    return boost(x, rows.y.to_numpy("float64"))


def predict(docs: DataFrame, forest: Forest, column: str = "text"):
    """Struct column with ``score``, from 0 to 1, of every text (null: empty)."""
    model = docs.sparkSession.sparkContext.broadcast(forest)  # a few thousand numbers

    def make():
        fitted = model.value

        def each(texts: pd.Series) -> pd.DataFrame:
            x = np.array([statistics(t) for t in texts], "float64").reshape(len(texts), -1)
            return pd.DataFrame({"score": fitted.score(x)})

        return each

    return column_map(docs, column, "score double", make)
