"""Toxicity by a chain of linear classifiers.

Categories are predicted in a fixed order.  The model of a category sees sparse
word features and the probabilities of all earlier categories; in training
those are out-of-fold predictions, so a later model learns from the errors that
earlier ones make on unseen rows, not from their fit to their own.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import column_map, sigmoid

WORD = re.compile(r"[^\W\d_]+")
PREFIX = 4
FOLDS = 5
PERMUTATIONS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)

# Weak labels of the first two categories.  The annotations only
# say "toxic"; a toxic text holding one of these words trains its category too.
WEAK_CATEGORIES = {
    "insult": ["clown", "fool", "idiot", "loser", "moron", "scum", "trash"],
    "contempt": ["disgusting", "pathetic", "stupid", "useless", "worthless"],
}


def word_hashes(text: str | None) -> set[int]:
    """Hashes of the distinct lower-cased words and of their first letters."""
    words = set(WORD.findall((text or "").lower()))
    words |= {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words}


def _sketch(text: str) -> list[int]:
    """Smallest value of four hashes over three-word shingles."""
    w = text.split()
    h = np.array([zlib.crc32(" ".join(s).encode("utf-8", "surrogatepass")) for s in zip(w, w[1:], w[2:])] or [zlib.crc32(text.encode("utf-8", "surrogatepass"))], "u8")
    return [int(((h * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min()) for m in PERMUTATIONS]


@dataclass(frozen=True)
class Chain:
    """Fitted chain: ``index`` maps a word hash to a column; a row of weights per category."""

    categories: list[str]
    index: dict[int, int]
    weights: list[np.ndarray]
    bias: list[float]
    thresholds: list[float]

    def probabilities(self, columns: list[int]) -> list[float]:
        """Of one text with these columns present, category after category."""
        k, out = len(self.index), []
        for w, b in zip(self.weights, self.bias):
            out.append(float(sigmoid(np.asarray(w[columns].sum() + w[k:] @ np.asarray(out) + b))))
        return out

    def score(self, text: str | None) -> list[float]:
        get = self.index.get
        return self.probabilities(sorted(c for h in word_hashes(text) if (c := get(h)) is not None))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, labelled: list[str], weak: dict[str, list[str]]) -> pd.DataFrame:
    """Features and labels of at most ``rows`` annotated documents, chosen by hash of ``doc_id``.

    Only the chosen ids are broadcast; texts are turned to word hashes in tasks.
    Rows whose label is null are not annotated; of repeated annotations the
    largest counts.
    """
    marks = labels.where(" AND ".join(f"{c} IS NOT NULL" for c in labelled) + " AND doc_id IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in labelled])
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")

    def make():
        def each(texts: pd.Series) -> pd.DataFrame:
            words = [word_hashes(t) for t in texts]
            out = {
                "words": [np.fromiter(w, "<u4", len(w)).tobytes() for w in words],
                "sketch": [_sketch(t or "") for t in texts],
            }
            for name, listed in weak.items():
                wanted = {zlib.crc32(w.encode()) for w in listed}
                out[name] = [int(bool(wanted & w)) for w in words]
            return pd.DataFrame(out)

        return each

    schema = "words binary, sketch array<long>" + "".join(f", {c} int" for c in weak)
    got = chosen.select("doc_id", *labelled, column_map(chosen, "text", schema, make).alias("out"))
    return got.select("doc_id", *labelled, "out.*").toPandas().sort_values("doc_id", kind="stable")


def _first_of_copies(pdf: pd.DataFrame) -> pd.DataFrame:
    """Drop rows that share a sketch value with an earlier one: a group of copies counts once."""
    seen, keep = set(), []
    for s in pdf.sketch:
        own = set(enumerate(s))
        keep.append(not (own & seen))
        seen |= own
    return pdf[np.array(keep, bool)].reset_index(drop=True)


def _select(words: list[np.ndarray], y: np.ndarray, most: int, least: int) -> list[int]:
    """Hashes whose presence differs most between the classes, in standard errors."""
    n1, n0 = y.sum(), (1 - y).sum()
    if not n1 or not n0:
        return []
    every = np.concatenate(words) if words else np.zeros(0, "u4")
    mark = np.repeat(y, [len(w) for w in words])
    hashes, inverse = np.unique(every, return_inverse=True)
    a = np.bincount(inverse, mark, len(hashes))
    both = np.bincount(inverse, minlength=len(hashes))
    p = both / (n1 + n0)
    z = (a / n1 - (both - a) / n0) / np.sqrt(np.clip(p * (1 - p), 1e-9, None) * (1 / n1 + 1 / n0))
    z[both < least] = 0
    top = np.argsort(-np.abs(z), kind="stable")[:most]
    return [int(hashes[i]) for i in top if abs(z[i]) > 4.0]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 200) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient; the last weight is the bias.

    Columns are scaled to unit length first, so that rare words converge as fast
    as the bias; the penalty stays that of the unscaled weights.
    """
    x = np.hstack([x, np.ones((len(y), 1), "float32")])
    size = np.maximum(np.linalg.norm(x, axis=0), 1e-6).astype("float32")
    x /= size
    y = y.astype("float32")
    ridge = (penalty / size**2).astype("float32")
    ridge[-1] = 0
    v = np.ones(x.shape[1], "float32")
    for _ in range(12):  # largest curvature by power iteration
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) or 1.0
    step = np.float32(1.0 / (0.25 * np.linalg.norm(x @ v) ** 2 + ridge.max()))
    w = look = np.zeros(x.shape[1], "float32")
    for t in range(rounds):
        new = look - step * (x.T @ (sigmoid(x @ look) - y) + ridge * look)
        look = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return (w / size).astype("float64")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str] | None = None,
    target: str = "toxic",
    weak: dict[str, list[str]] | None = None,
    max_rows: int = 10_000,
    features: int = 256,
    least_documents: int = 4,
) -> Chain:
    """Fit the chain on at most ``max_rows`` annotated documents.

    ``categories`` are label columns in chain order (default: the weak
    categories, then ``target``).  Without annotated rows of both classes a
    category always gets its share in the training rows (0.0 if there are none).
    """
    weak = WEAK_CATEGORIES if weak is None else weak
    labelled = [target] if categories is None else [c for c in categories if c not in weak]
    order = [*weak, target] if categories is None else categories
    pdf = _first_of_copies(training_rows(docs, labels, max_rows, labelled, weak))
    for c in weak:
        pdf[c] = pdf[c] * pdf[target]
    words, chosen = [np.frombuffer(w, "<u4") for w in pdf.words], []
    for c in order:
        chosen += _select(words, pdf[c].to_numpy("float64"), features, least_documents)
    index = {h: k for k, h in enumerate(dict.fromkeys(chosen))}
    x = np.zeros((len(pdf), len(index)), "float32")
    for i, w in enumerate(words):
        x[i, [index[h] for h in w.tolist() if h in index]] = 1
    fold = np.array([zlib.crc32(str(d).encode()) % FOLDS for d in pdf.doc_id], "int64")
    weights, bias, thresholds = [], [], []
    for c in order:
        y = pdf[c].to_numpy("float64")
        if len(set(y)) < 2:
            share = float(y.mean()) if len(y) else 0.0
            weights.append(np.zeros(x.shape[1]))
            bias.append(float(np.log((share + 1e-9) / (1 - share + 1e-9))))
            thresholds.append(0.5)
            out = np.full(len(y), share)
        else:
            out = np.zeros(len(y))
            for k in range(FOLDS):
                inside = fold != k
                if inside.any() and (~inside).any():
                    w = _logistic(x[inside], y[inside])
                    out[~inside] = sigmoid(x[~inside] @ w[:-1] + w[-1])
            w = _logistic(x, y)
            weights.append(w[:-1])
            bias.append(float(w[-1]))
            thresholds.append(_threshold(out, y))
        x = np.hstack([x, out[:, None].astype("float32")])
    return Chain(order, index, weights, bias, thresholds)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Cut of out-of-fold probabilities with the best F1; the middle of the gap it lies in."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    last = np.r_[np.diff(p[order]) < 0, True]  # a cut can't part equal values
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(y) else 0.0
    return float((p[order][k] + below) / 2)


def predict(docs: DataFrame, chain: Chain, column: str = "text"):
    """Struct column ``p_<category>`` and ``toxic`` (last category above its cut) for ``docs``.

    A null or empty text has no features, so it gets the chain's base rates.
    """
    model = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by `features` per category

    def make():
        fitted = model.value

        def each(texts: pd.Series) -> pd.DataFrame:
            p = np.array([fitted.score(t) for t in texts]).reshape(len(texts), -1)
            out = pd.DataFrame({f"p_{c}": p[:, k] for k, c in enumerate(fitted.categories)})
            out["toxic"] = p[:, -1] > fitted.thresholds[-1]
            return out

        return each

    schema = ", ".join(f"p_{c} double" for c in chain.categories) + ", toxic boolean"
    return column_map(docs, column, schema, make)
