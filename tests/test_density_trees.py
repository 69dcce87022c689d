"""Density clusters and tree ensembles against one-machine versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramlark.functions.graphs import connected
from gramlark.operators import trees
from gramlark.operators.density import density_clusters


def plain_clusters(rows, eps, least):
    """rows: (key, x, ...) -> {key: (cluster, is_core, is_noise)}."""
    x = np.array([r[1:] for r in rows], "f8")
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = {}
    for i in np.flatnonzero(core):
        if i in label:
            continue
        group, todo = set(), [i]
        while todo:
            j = todo.pop()
            if j not in group:
                group.add(j)
                todo += list(np.flatnonzero(near[j] & core))
        name = min(rows[j][0] for j in group)
        label |= dict.fromkeys(group, name)
    out = {}
    for i, r in enumerate(rows):
        found = [label[j] for j in np.flatnonzero(near[i] & core)]
        name = label.get(i, min(found) if found else None)
        out[r[0]] = (name, bool(core[i]), name is None)
    return out


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_density_equals_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    wide = {1: 120, 2: 8, 3: 4}[dims]
    spread = rng.uniform(0, wide, (110, dims))
    crowd = rng.normal(0, 0.12, (160, dims)) + 2  # crowded cells that touch
    grid = np.round(rng.uniform(3, 6, (60, dims)) * 4) / 4  # distances of exactly eps, repeated places
    x = np.concatenate([spread, crowd, grid, np.zeros((1, dims)), -np.zeros((1, dims))])
    rows = [(f"k{i:03}", *map(float, v)) for i, v in enumerate(x)]
    names = [f"c{i}" for i in range(dims)]
    odd = [("n1", *[None] * dims), ("n2", *[float("nan")] * dims), ("n3", *[float("inf")] * dims)]
    df = spark.createDataFrame(rows + odd, "key string, " + ", ".join(f"{n} double" for n in names))
    eps, least = 0.25, 4
    got = {r.key: (r.cluster, r.is_core, r.is_noise) for r in density_clusters(df, names, "key", eps, least).collect()}
    want = plain_clusters(rows, eps, least)
    assert got == want
    assert len({v[0] for v in want.values()}) > (2 if dims < 3 else 1) and any(v[2] for v in want.values())
    if dims == 1:
        assert density_clusters(df.where("false"), names, "key", eps, least).collect() == []


def test_connected_names_the_smallest(spark):
    edges = [(f"n{i:02}", f"n{i + 1:02}") for i in range(40)] + [("a", "a"), ("c", "b"), ("d", "c")]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"n{i:02}": "n00" for i in range(41)} | {"a": "a", "b": "b", "c": "b", "d": "b"}


def made(spark, parts=3):
    rng = np.random.default_rng(9)
    rows = [
        (f"r{i}", None if i % 17 == 0 else float(rng.integers(0, 30)), float(rng.normal()), 1.0, float(rng.integers(0, 50)))
        for i in range(400)
    ]
    rows = [(k, a, b, c, (a or 3) * 2 + (5 if b > 0.4 else 0) + 0.01 * y) for k, a, b, c, y in rows] + [("gone", 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "key string, a double, b double, c double, y double").repartition(parts), rows[:-1]


def plain_tree(x, y, w, depth, node, least, offered, out):
    out[node] = [None, None, (w * y).sum() / w.sum()]
    if depth == 0:
        return
    best, found = (w * y).sum() ** 2 / w.sum() * (1 + 1e-12), None
    for f in offered(node):
        for cut in range(x.shape[1] and x[:, f].max()):
            low = x[:, f] <= cut
            nl, nr = w[low].sum(), w[~low].sum()
            if nl >= least and nr >= least:
                gain = (w * y)[low].sum() ** 2 / nl + (w * y)[~low].sum() ** 2 / nr
                if gain > best:
                    best, found = gain, (f, cut)
    if found:
        out[node][:2] = found
        low = x[:, found[0]] <= found[1]
        plain_tree(x[low], y[low], w[low], depth - 1, 2 * node + 1, least, offered, out)
        plain_tree(x[~low], y[~low], w[~low], depth - 1, 2 * node + 2, least, offered, out)


@pytest.mark.parametrize("bootstrap", [False, True])
def test_trees_equal_an_exhaustive_search(spark, bootstrap):
    df, _ = made(spark)
    columns = ["a", "b", "c"]
    binned, edges, mean, step = trees._prepared(df, columns, "y", "key", 8)
    share = 0.67 if bootstrap else 1.0
    grown = trees.grow(binned, 3, 3, 8, 5, bootstrap, share, 1)
    rows = binned.collect()
    x, y = np.array([r.bins for r in rows]), np.array([r.y for r in rows], "f8")
    h = np.array([r.h for r in rows])
    for t, tree in enumerate(grown):
        w = trees.draws(h, t, 1) if bootstrap else np.ones(len(y), "int64")
        want = {}
        plain_tree(x[w > 0], y[w > 0], w[w > 0], 3, 0, 5, lambda n: trees._offered(3, share, t, n, 1), want)
        for node, (f, cut, value) in want.items():
            assert tree.feature[node] == (-1 if f is None else f) and tree.value[node] == pytest.approx(value)
            assert f is None or tree.cut[node] == cut
    assert [list(t.feature) for t in trees.grow(binned.repartition(7), 3, 3, 8, 5, bootstrap, share, 1)] == [list(t.feature) for t in grown]


def test_draws_are_poisson():
    w = trees.draws(np.arange(200_000), 4, 42)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and (w != trees.draws(np.arange(200_000), 5, 42)).any()


def test_boosting_lowers_the_error_and_predicts_in_the_jvm(spark):
    df, rows = made(spark)
    model = trees.boosted_trees(df, ["a", "b", "c"], "y", "key", rounds=6, depth=2, bins=8, rate=0.5)
    got = {r.key: r.p for r in df.select("key", model.predict().alias("p")).collect()}
    y = np.array([r[4] for r in rows])
    p = np.array([got[r[0]] for r in rows])
    assert ((y - p) ** 2).mean() < 0.05 * y.var() and "gone" in got
    # the same by hand from the stored splits
    nodes = {(t, n): (f, e, v) for t, n, f, e, v in trees.splits(model)}
    for key, a, b, c, _ in rows[:60]:
        total, own = model.base, {"a": a, "b": b, "c": c}
        for t in range(6):
            n = 0
            while nodes[t, n][0]:
                f, e, _ = nodes[t, n]
                n = 2 * n + (1 if own[f] is None or (e is not None and own[f] <= e) else 2)
            total += 0.5 * nodes[t, n][2]
        assert got[key] == pytest.approx(total)


def test_forest_of_no_rows_and_of_a_constant(spark):
    df, _ = made(spark)
    none = trees.random_forest(df.where("false"), ["a", "b"], "y", "key", trees=2)
    flat = trees.random_forest(df.withColumn("y", F.lit(4.0)), ["a", "b"], "y", "key", trees=2)
    assert {r.p for r in df.select(none.predict().alias("p")).collect()} == {0.0}
    assert {r.p for r in df.select(flat.predict().alias("p")).collect()} == {4.0}


def test_boosting_keeps_one_table_of_residuals_and_needs_no_pass_for_the_leaves(spark, monkeypatch):
    from gramlark import session

    df, _ = made(spark)
    passes, agg = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: passes.append(f.__name__) or agg(self, f, *a, **k))
    before = set(session._STAGED)
    model = trees.boosted_trees(df, ["a", "b", "c"], "y", "key", rounds=6, depth=2, bins=8, rate=0.5)
    kept = [p for p in set(session._STAGED) - before if "residuals" in p or "binned" in p]
    assert len(model.trees) == 6 and len(kept) == 1
    assert passes.count("sums") == 6 * 2


def test_leaves_hand_their_value_down():
    tree = trees.Tree(np.array([1, -1, 0, -1, -1, -1, -1]), np.array([2, 0, 1, 0, 0, 0, 0]), np.array([0.0, 5.0, 0.0, 0.0, 0.0, 7.0, 9.0]))
    bins = np.array([[0, 2], [1, 3], [2, 3]], "u1")
    assert tree.nodes(bins, 2).tolist() == [3, 5, 6]
    assert tree.handed_down()[tree.nodes(bins, 2)].tolist() == [5.0, 7.0, 9.0]
