"""SimHash fingerprints and near-duplicate groups by generalised pigeonhole search.

Fingerprints at most ``distance`` bits apart are linked.  The 64 bits are cut
into parts, correlated bits together.  If part ``i`` may differ in ``t_i`` bits
and the ``t_i + 1`` add up to ``distance + 1``, two fingerprints that differ in
at most ``distance`` bits are within ``t_i`` in some part ``i``: had every part
more than ``t_i`` differences, they would sum to more than ``distance``.  How
the parts and thresholds are chosen only changes the cost, never the links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import column_map, components, unused
from gramlark.session import stage

SEED = 42
BITS = 64


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority bits of the XXH64 of all ``width``-word shingles, repeats included.

    A-Z are lower-cased, words end at ASCII white space.  Fewer words make one
    shingle, no word gives 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), "<u8", max(1, len(words) - width + 1))
    ones = np.zeros(BITS, "int64")
    for at in range(0, len(h), 16_384):
        bits = np.unpackbits(h[at : at + 16_384].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, width: int = 3, column: str = "text") -> DataFrame:
    """``docs`` plus ``out.fp``, the fingerprint as a signed 64-bit number."""

    def make():
        def each(texts: pd.Series) -> pd.DataFrame:
            fp = np.fromiter((fingerprint(t, width) for t in texts), "u8", len(texts))
            return pd.DataFrame({"fp": fp.view("i8")})

        return each

    return column_map(docs, column, "fp long", make)


def bit_correlation(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of the 64 bits over all fingerprints; tasks emit one small matrix each."""

    def each(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for pdf in batches:
            bits = _bits(pdf.fp.to_numpy("int64")).astype("float64")
            n, both = n + len(bits), both + bits.T @ bits
        if n:
            yield pd.DataFrame({"i": range(BITS), "n": n, "row": list(both)})

    parts = fps.select("fp").mapInPandas(each, "i int, n long, row array<double>")
    cells = parts.select("i", "n", F.posexplode("row").alias("j", "v"))
    sums = cells.groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas()
    if sums.empty:
        return np.eye(BITS)
    both = np.zeros((BITS, BITS))
    both[sums.i, sums.j] = sums.v / sums.n
    p = np.diag(both)
    spread = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    return np.abs((both - np.outer(p, p)) / np.outer(spread, spread))


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into parts of nearly equal width, each grown around its most correlated bits."""
    rest, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        pool = sorted(rest)
        own = [max(pool, key=lambda b: corr[b, pool].sum())]
        while len(own) < width:
            own.append(max(sorted(rest - set(own)), key=lambda b: corr[b, own].sum()))
        rest -= set(own)
        out.append(sorted(own))
    return out


def probe_masks(bits: list[int], threshold: int) -> list[int]:
    """XOR masks that reach every value within ``threshold`` bits of a part."""
    return [sum(1 << b for b in c) for r in range(threshold + 1) for c in combinations(bits, r)]


def allocate(parts: list[list[int]], sample: np.ndarray, total: int, distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds by dynamic programming; -1 leaves a part unused.

    Cost of a part at a threshold: probe rows of all fingerprints plus the
    candidate pairs expected from the sample's pairs within that threshold.
    """
    s = len(sample)
    scale = (total / s) ** 2 if s else 0.0
    table = []
    for bits in parts:
        part = sample & np.uint64(sum(1 << b for b in bits))
        near = np.bincount(
            np.concatenate([np.bitwise_count(part[i] ^ part[i + 1 :]) for i in range(s)] or [np.zeros(0, "u1")]),
            minlength=distance + 1,
        ).cumsum()
        # an unseen pair may still exist: half a pair, or chance in the width, whichever is less
        table.append(
            [0.0]
            + [
                total * len(m) + scale * max(near[t], min(0.5, s * s / 2 * len(m) / 2.0 ** len(bits)))
                for t in range(distance + 1)
                for m in [probe_masks(bits, t)]
            ]
        )
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in table:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for units in range(distance + 2 - spent):
                c = (cost + costs[units], [*chosen, units - 1])
                if spent + units not in nxt or c[0] < nxt[spent + units][0]:
                    nxt[spent + units] = c
        best = nxt
    return best[distance + 1]


def plan_parts(fps: DataFrame, distance: int, total: int, sample_rows: int = 2_000) -> list[tuple[int, list[int]]]:
    """(mask of a part, its probe masks) for the parts in use, at the lowest estimated cost."""
    if distance == 0:
        return [(2**BITS - 1, [0])]
    corr = bit_correlation(fps)
    rows = fps.select("fp").orderBy(F.xxhash64("fp")).limit(sample_rows).toPandas()
    sample = rows.fp.to_numpy("int64").view("u8")
    choices = []
    for parts in range(1, distance + 2):
        cut = correlated_parts(corr, parts)
        cost, thresholds = allocate(cut, sample, total, distance)
        choices.append((cost, parts, [(b, t) for b, t in zip(cut, thresholds) if t >= 0]))
    return [(sum(1 << b for b in bits), probe_masks(bits, t)) for bits, t in min(choices)[2]]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_links(fps: DataFrame, distance: int = 2, crowded: int = 64) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints ``fp`` with the components of all links.

    Probes meet indexed parts in an equality join and are verified.  A part
    value shared by more than ``crowded`` fingerprints would give pairs with the
    square of its size; all fingerprints that probe such a value are linked
    through midpoints instead: two of them are within ``distance`` exactly if
    they share a code within half of it (rounded up and down) of each, and every
    code's visitors form a star around the smallest.  That is linear and loses
    no link.
    """
    total = fps.count()
    parts = plan_parts(fps, distance, total)
    index = None
    probe = None
    for k, (mask, masks) in enumerate(parts):
        m = F.lit(_signed(mask))
        own = fps.select(F.lit(k).alias("part"), F.col("fp").bitwiseAND(m).alias("key"), F.col("fp").alias("b"))
        flips = F.array(*[F.lit(_signed(x)) for x in masks])
        seen = fps.select(F.col("fp").alias("a"), F.explode(flips).alias("flip"))
        seen = seen.select(F.lit(k).alias("part"), F.col("a").bitwiseAND(m).bitwiseXOR(F.col("flip")).alias("key"), "a")
        index = own if index is None else index.unionByName(own)
        probe = seen if probe is None else probe.unionByName(seen)
    sizes = index.groupBy("part", "key").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    probed = stage(probe.join(sizes, ["part", "key"], "left"), "probes")
    # a value that a fingerprint reaches by flips may hold a single other one
    alone = probed.where("members IS NULL").select("part", "key", "a")
    light = probed.where(F.col("members") <= crowded).select("part", "key", "a").unionByName(alone)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    few = light.join(index, ["part", "key"]).where((F.col("a") != F.col("b")) & near).select("a", "b")
    many = probed.where(F.col("members") > crowded).select("a").distinct()
    return few.unionByName(_stars(many, distance))


def _stars(fps: DataFrame, distance: int) -> DataFrame:
    """Links of ``fps(a)`` through shared codes.

    For an even distance 2r the codes within r bits of each are shared exactly
    by fingerprints at most 2r apart.  An odd distance 2r+1 takes codes within
    r of one and r+1 of the other: cores (r) and their visitors (r+1).
    """
    low, high = distance // 2, distance - distance // 2
    every = list(range(BITS))
    near = F.array(*[F.lit(_signed(x)) for x in probe_masks(every, low)])
    core = fps.select("a", F.explode(near).alias("flip")).select(F.col("a").bitwiseXOR(F.col("flip")).alias("code"), "a")
    if low == high:
        star = core.groupBy("code").agg(F.min("a").alias("b"))
        return core.join(star, "code").where("a <> b").select("a", "b")
    far = F.array(*[F.lit(_signed(x)) for x in probe_masks(every, high)])
    visit = fps.select("a", F.explode(far).alias("flip")).select(F.col("a").bitwiseXOR(F.col("flip")).alias("code"), "a")
    star = core.groupBy("code").agg(F.min("a").alias("b"))
    return visit.join(star, "code").where("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, key: str | Column = "doc_id") -> DataFrame:
    """``(key, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable by links.  A null text is an
    empty one (fingerprint 0); rows with a null key take part and get their
    component's smallest key, null if it has none.  Copies share a fingerprint
    and are one node of the search.
    """
    key = F.col(key) if isinstance(key, str) else key
    marked = docs.select(key.alias("key"), with_fingerprint(docs, width).alias("out"))
    marked = stage(marked.select("key", F.col("out.fp").alias("fp")), "fingerprints")
    fps = stage(marked.groupBy("fp").agg(F.min("key").alias("low")), "distinct")
    groups = components(near_links(fps.select("fp"), distance))
    classes = fps.join(groups, fps.fp == groups.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("class")
    )
    lows = classes.groupBy("class").agg(F.min("low").alias("component_id"))
    named = stage(classes.join(lows, "class").select("fp", "component_id"), "classes")
    return marked.join(named, "fp").select("key", "fp", "component_id")


def first_of_groups(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """The row with the smallest ``doc_id`` of every group, with all its columns.

    Repeated ids and nulls (last) are told apart by the row's number, so exactly
    one row of a group stays.  Rows are numbered once, in a written copy.
    """
    row = unused(docs.columns, "row")
    placed = stage(docs.withColumn(row, F.monotonically_increasing_id()), "placed")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))
    groups = near_duplicates(placed, width, distance, key)
    later = groups.where("key.row <> component_id.row").select(F.col("key.row").alias(row))
    return placed.join(later, row, "left_anti").select(docs.columns)
