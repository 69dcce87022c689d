"""Hard negatives: wrong-label vectors that score nearly as high as an anchor's true neighbours.

Every vector is rotated and kept as one sign bit per dimension, together with
its alignment: the inner product with its own unit code vector.  What lies
beside that code vector is coded in the same way, ``CODES`` times in all.  What a
vector and an anchor share along the codes comes from popcounts; what is left is
at most the product of both remainders' lengths (Cauchy-Schwarz).  That gives an
interval which surely holds the score, so rows whose interval can't matter are
dropped and only the others are scored, in integers: the result is exact.  One
code leaves six tenths of a vector's length, which drops hardly any row of
vectors without structure; five leave less than a tenth.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gramlark.session import stage

SCALE = 256.0
LIMIT = 1 << 27  # larger components are held at this, so that scores fit a long
CODES = 5  # one-bit codes of a vector, each of what the ones before leave, turned anew
PLANES = 7  # bits per dimension of a rotated anchor


def integers(values: pd.Series, width: int) -> np.ndarray:
    """``floor(256 * x)`` of every component; shorter vectors end in zeros."""
    out = np.zeros((len(values), width), "int64")
    for i, v in enumerate(values):
        out[i, : len(v)] = np.clip(np.floor(SCALE * np.asarray(v, "float64")), -LIMIT, LIMIT)
    return out


def rotation(width: int, seed: int = 31) -> np.ndarray:
    """Orthonormal rows that turn ``width`` components into a multiple of 64."""
    size = max(64, -(-width // 64) * 64)
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0][:width]


def encode(v: np.ndarray, turn: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign codes ``[row, code, word]`` of 64 bits a word, alignment with each code vector, and length of the rest."""
    y = v @ turn
    size = turn.shape[1]
    again = rotation(size)
    bits = np.empty((len(v), codes, size // 64), "<u8")
    align = np.empty((len(v), codes))
    for k in range(codes):
        up = y > 0
        bits[:, k] = np.packbits(up, axis=1, bitorder="little").view("<u8")
        align[:, k] = np.abs(y).sum(1) / math.sqrt(size)
        y = (y - np.where(up, 1, -1) * (align[:, k] / math.sqrt(size))[:, None]) @ again
    return bits, align, np.sqrt((y**2).sum(1))


def intervals(
    code: np.ndarray, align: np.ndarray, rest: np.ndarray, anchors: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner product of every anchor (rows) with every coded vector (columns)."""
    y, again, root = anchors @ turn, rotation(turn.shape[1]), math.sqrt(turn.shape[1])
    length = np.sqrt((anchors.astype("float64") ** 2).sum(axis=1, keepdims=True))
    middle, half = np.zeros((len(anchors), len(code))), np.zeros((len(anchors), len(code)))
    along, off = np.zeros(()), np.zeros(())
    for k in range(align.shape[1]):
        low = y.min(axis=1, keepdims=True)
        step = np.maximum(y.max(axis=1, keepdims=True) - low, 1e-12) / (2**PLANES - 1)
        level = np.rint((y - low) / step).astype("u1")
        near = low + step * level
        planes = np.packbits((level[:, None, :] >> np.arange(PLANES)[:, None]) & 1, axis=2, bitorder="little").view("<u8")
        picked = np.zeros(middle.shape, "int32")
        for j in range(PLANES):
            for w in range(code.shape[2]):
                picked += np.bitwise_count(planes[:, j, w, None] & code[:, k, w]).astype("int32") << j
        ones = np.bitwise_count(code[:, k]).sum(axis=1, dtype="int64")
        along = (2 * (low * ones + step * picked) - near.sum(axis=1, keepdims=True)) / root
        off = np.abs(y - near).sum(axis=1, keepdims=True) / root  # what the planes leave out, at most
        middle += align[:, k] * along
        half += align[:, k] * off
        if k + 1 < align.shape[1]:
            y = y @ again
    beside = np.sqrt(np.maximum(length**2 - np.maximum(np.abs(along) - off, 0) ** 2, 0))
    half += rest * beside
    half += 1e-9 * length * (align.sum(axis=1) + rest) + 1e-6  # rounding of the sums above
    return middle - half, middle + half


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; ties to the smaller id, then to the smaller row number."""
    if len(scores) > k:
        pool = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return pool[np.lexsort((rows[pool], ids[pool], -scores[pool]))[:k]]
    return np.lexsort((rows, ids, -scores))


class Block:
    """The coded vectors of one block, by label."""

    def __init__(self, pdf: pd.DataFrame, width: int):
        pdf = pdf.sort_values("label", kind="stable")
        self.row, self.id = pdf["row"].to_numpy("int64"), pdf["vec_id"].to_numpy("int64")
        self.label = pdf["label"].to_numpy("int64")
        self.v = integers_of(pdf["v"], width)
        self.align, self.rest = np.stack(pdf["align"].to_numpy()).astype("float64"), pdf["rest"].to_numpy("float64")
        self.code = np.stack(pdf["code"].to_numpy()).astype("int64").view("u8").reshape(*self.align.shape, -1)

    def same(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))

    def bounds(self, part: slice, anchors: np.ndarray, turn: np.ndarray):
        return intervals(self.code[part], self.align[part], self.rest[part], anchors, turn)


def integers_of(values: pd.Series, width: int) -> np.ndarray:
    return np.stack(values.to_numpy()).astype("int64").reshape(len(values), width)


def block_positives(block: Block, asks: pd.DataFrame, turn: np.ndarray, k: int) -> Iterator[tuple]:
    """``(anchor_row, anchor_id, row, vec_id, score)``: each anchor's k best rows of its label in the block."""
    width = turn.shape[0]
    for label, own in asks.groupby("label", sort=False):
        part = block.same(int(label))
        rows, ids, v = block.row[part], block.id[part], block.v[part]
        if not len(rows):
            continue
        for pdf in _batches(own, len(rows)):
            anchors = integers_of(pdf["v"], width)
            low, high = block.bounds(part, anchors, turn)
            itself = rows == pdf["row"].to_numpy("int64")[:, None]
            low[itself] = high[itself] = -np.inf
            for i, (a_row, a_id) in enumerate(zip(pdf["row"], pdf["vec_id"])):
                sure = np.partition(low[i], len(rows) - k)[len(rows) - k] if len(rows) > k else -np.inf
                left = np.flatnonzero((high[i] >= sure) & (high[i] > -np.inf))
                scores = v[left] @ anchors[i]
                for p in best(scores, ids[left], rows[left], k):
                    yield a_row, a_id, rows[left[p]], ids[left[p]], scores[p]


def block_negatives(block: Block, asks: pd.DataFrame, turn: np.ndarray, k: int) -> Iterator[tuple]:
    """``(anchor_row, anchor_id, positive_row, positive_id, positive_score, row, vec_id, score)``: the k best rows
    of other labels whose score lies between 0.5 and 0.95 of the positive's."""
    width = turn.shape[0]
    for pdf in _batches(asks, len(block.row)):
        anchors = integers_of(pdf["v"], width)
        low, high = block.bounds(slice(None), anchors, turn)
        for i, (a_row, a_id, label, positives) in enumerate(zip(pdf["row"], pdf["vec_id"], pdf["label"], pdf["positives"])):
            other = block.label != label
            wanted, windows = np.zeros(len(other), bool), []
            for p in positives:
                least, most = -(-50 * int(p["score"]) // 100), 95 * int(p["score"]) // 100
                windows.append((p, least, most))
                if least > most:
                    continue
                here = other & (high[i] >= least) & (low[i] <= most)
                sure = low[i][here & (low[i] >= least) & (high[i] <= most)]
                if len(sure) >= k:
                    here &= high[i] >= np.partition(sure, len(sure) - k)[len(sure) - k]
                wanted |= here
            left = np.flatnonzero(wanted)
            scores = block.v[left] @ anchors[i]
            for p, least, most in windows:
                fit = np.flatnonzero((scores >= least) & (scores <= most))
                for n in best(scores[fit], block.id[left[fit]], block.row[left[fit]], k):
                    at = left[fit[n]]
                    yield a_row, a_id, p["row"], p["vec_id"], p["score"], block.row[at], block.id[at], scores[fit[n]]


def _batches(pdf: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    """Pieces of ``pdf`` small enough for a table of four million bounds against ``rows`` rows."""
    many = max(1, 4_000_000 // max(1, rows))
    for at in range(0, len(pdf), many):
        yield pdf.iloc[at : at + many]


def _meet(vectors: DataFrame, asks: DataFrame, blocks: int, turn: np.ndarray, find, k: int, schema: str) -> DataFrame:
    """Every anchor against every block: a task holds one block's rows and streams the anchors past them.

    Vectors are dealt once; anchors go to each block.  Neither a block nor a
    batch of anchors grows with the table, and no block depends on ids or labels.
    """
    width, names = turn.shape[0], [f.split()[0] for f in schema.split(", ")]
    extra = "array<struct<row:long,vec_id:long,score:long>>"
    held = vectors.select("*", F.lit(0).alias("kind"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    held = held.select("*", F.lit(None).cast(extra).alias("positives"))
    come = asks.select("*", F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    if "positives" not in asks.columns:
        come = come.select("*", F.lit(None).cast(extra).alias("positives"))
    both = held.unionByName(come).repartition(blocks, "block").sortWithinPartitions("block", "kind", "row")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, block = None, [], None
        for batch in batches:
            for (number, kind), pdf in batch.groupby(["block", "kind"], sort=True):
                if number != at:
                    at, parts, block = number, [], None
                if kind == 0:
                    parts.append(pdf)
                elif parts or block:
                    if block is None:
                        block, parts = Block(pd.concat(parts), width), []
                    found = list(find(block, pdf, turn, k))
                    yield pd.DataFrame(found, columns=names)

    return both.mapInPandas(run, schema)


def mine(
    base: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 3,
    block_rows: int = 65_536,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows where ``is_anchor``.  Each anchor's ``positives`` best
    other rows of its label are found first; for each of them the ``negatives``
    best rows of another label with 0.5 to 0.95 of the positive's score follow,
    ranked from 1.  Scores are inner products of ``floor(256 * x)``; ties go to
    the smaller ``vec_id``.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part.  Repeated ids are rows of their own, so an anchor may meet its copy.
    Shorter vectors count as if they ended in zeros.  A component beyond 2^27
    once scaled is held there.  Columns other than ``vec_id``, ``embedding`` and
    the label's are not read.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    label = F.col(label) if isinstance(label, str) else label
    rows = base.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("e"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL").where(~F.exists("e", bad))
    width = max(1, rows.agg(F.max(F.size("e"))).first()[0] or 1)
    turn = rotation(width)

    @F.pandas_udf("struct<v:array<int>,code:array<long>,align:array<double>,rest:double>")
    def coded(e: pd.Series) -> pd.DataFrame:
        v = integers(e, width)
        code, align, rest = encode(v, turn)
        words = code.reshape(len(v), -1).view("i8")
        return pd.DataFrame({"v": list(v.astype("int32")), "code": list(words), "align": list(align), "rest": rest})

    vectors = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "asks", coded("e").alias("c"))
    vectors = stage(vectors.select("row", "vec_id", "label", "asks", "c.*"), "codes")
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    anchors, vectors = vectors.where("asks").drop("asks"), vectors.drop("asks")

    schema = "anchor_row long, anchor_id long, row long, vec_id long, score long"
    found = _meet(vectors, anchors, blocks, turn, block_positives, positives, schema)
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = found.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("positives"))
    asks = stage(anchors.join(found, "row"), "positives")

    schema = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, negative_id long, negative_score long"
    found = _meet(vectors, asks, blocks, turn, block_negatives, negatives, schema)
    order = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
