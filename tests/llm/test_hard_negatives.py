"""Hard negatives against plain integer scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramlark.llm import hard_negatives as hn
from gramlark.llm import queries
from tests.compare import differences, duck

ROW = "vec_id long, embedding array<float>, label int, `row` string, `block` int, `v` int"


def plain(rows, positives=5, negatives=3):
    """``rows`` of (vec_id, embedding, label); anchors have ids divisible by 50."""
    use = [
        (k, i, [min(max(int(np.floor(256 * float(np.float32(x)))), -hn.LIMIT), hn.LIMIT) for x in e], label)
        for k, (i, e, label) in enumerate(rows)
        if i is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)
    ]
    out = []
    for k, i, e, label in use:
        if i % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(e, f)), j, m, g) for m, j, f, g in use if m != k), key=lambda s: s[:3])
        for s, j, _, _ in [x for x in scored if x[3] == label][:positives]:
            fit = [x for x in scored if x[3] != label and -50 * s <= -100 * x[0] <= -95 * s]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROW)
    got = hn.mine(df, F.col("vec_id") % 50 == 0, **how)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    got = queries.op11_one_bit_hard_negatives(spark, sf_dir).toPandas()
    want = duck(sf_dir).execute(queries.OP11_SQL).df()
    assert len(got) and differences(got, want) is None


@pytest.mark.parametrize("width", [1, 5, 64, 70, 200])
def test_intervals_hold_the_scores(width):
    rng = np.random.default_rng(width)
    v = np.concatenate([rng.integers(-300, 300, (40, width)), np.zeros((1, width), "int64"), rng.integers(0, 2, (9, width))])
    v[3] = hn.LIMIT
    turn = hn.rotation(width)
    low, high = hn.intervals(*hn.encode(v, turn), v, turn)
    exact = v @ v.T
    assert (low <= exact).all() and (exact <= high).all()


def test_intervals_drop_rows():
    v = np.floor(256 * np.random.default_rng(0).normal(size=(20_000, 64)) / 8).astype("int64")  # no structure at all
    turn = hn.rotation(64)
    low, high = hn.intervals(*hn.encode(v, turn), v[:50], turn)
    sure = np.sort(low, axis=1)[:, -6:-5]
    assert (high >= sure).mean() < 0.2
    one_low, one_high = hn.intervals(*hn.encode(v, turn, codes=1), v[:50], turn)
    assert (high - low).mean() < 0.3 * (one_high - one_low).mean()


def test_ties_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0], 6)], int(rng.integers(0, 3))) for i in range(0, 260, 2)]
    rows += [rows[0], rows[25], rows[25], (50, rows[3][1], 1)]  # repeated ids, the same and other vectors
    rows += [(300, None, 1), (350, [1.0, float("nan")], 1), (400, [1.0, None], 0), (450, [0.0] * 6, 0), (None, [1.0] * 6, 0)]
    rows += [(500, [1.0] * 6, None), (550, [], 1), (600, [1.0, 1.0], 2), (650, [1e30] * 6, 1), (700, [-1.0] * 6, 2)]
    want = plain(rows)
    assert mined(spark, rows) == want and len(want) > 20
    assert mined(spark, rows, block_rows=7) == want
    assert mined(spark, rows, positives=1, negatives=100) == plain(rows, 1, 100)


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 1), (52, [1.0, 1.0], 2)]) == plain(
        [(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 1), (52, [1.0, 1.0], 2)]
    ) == [(50, 51, 1, 52, 327680, 196608)]
