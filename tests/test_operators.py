"""Feature operators, folds, metrics and tables on small fixtures."""

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gramlark import schema
from gramlark.operators import derive, encode, evaluate, folds, outliers, profile, scale, select
from gramlark.operators.cluster import GeoClusters, silhouette
from gramlark.operators.forest import IsolationScorer, _tree_steps, average_path
from gramlark.operators.impute import Imputer, handle_missing
from gramlark.operators.knn import knn_impute
from gramlark.operators.linear import LinearModel
from gramlark.functions import expressions
from gramlark.plans import plotdata
from gramlark.sources import registry, tables


# -- schema and profile ------------------------------------------------------


def test_schema_checks(spark):
    df = spark.createDataFrame([(1.0, "a")], "longitude double, median_income string")
    with pytest.raises(ValueError, match="latitude"):
        schema.require_columns(df)
    with pytest.warns(UserWarning, match="median_income"):
        assert len(schema.check_types(df)) == 1
    with pytest.raises(ValueError, match="no rows"):
        schema.require_rows(df.limit(0))
    assert schema.column_roles(df) == {
        "numerical": ["longitude"], "categorical": ["median_income"], "target": []
    }


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert schema.nan_to_null(df).where("x IS NULL").count() == 1


def test_profiles_of_odd_columns(spark):
    rows = [(1.0, None, "a"), (1.0, None, "a"), (math.inf, None, None)]
    df = spark.createDataFrame(rows, "x double, empty double, s string")
    d = {r["column"]: r for r in profile.describe(df).collect()}
    assert d["empty"]["count"] == 0 and d["empty"]["q50"] is None and d["x"]["q50"] == 1.0
    assert profile.duplicate_rows(df).first()["duplicates"] == 1
    assert {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()} == {"x": 0, "empty": 3, "s": 1}
    assert {r["column"]: r["distinct_values"] for r in profile.distinct_counts(df).collect()} == {"x": 2, "empty": 0, "s": 1}
    assert {r["column"]: r["infinities"] for r in profile.infinite_counts(df).collect()} == {"x": 1, "empty": 0}
    counts = profile.value_counts(df).collect()
    assert len(counts) == 1 and counts[0]["share"] == 1.0
    assert profile.duplicate_rows(df.limit(0)).first()["duplicates"] == 0


# -- imputation --------------------------------------------------------------


def _gaps(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("b", None), (None, None), ("c", 10.0)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, ocean_proximity string, x double")


def test_grouped_median_falls_back_to_the_global_median(spark):
    out = handle_missing(_gaps(spark)).orderBy("id").collect()
    # empty group, null group: median of 1, 3, 10
    assert [r["x"] for r in out] == [1.0, 3.0, 2.0, 3.0, 3.0, 3.0, 10.0]
    assert [r["x_is_missing"] for r in out] == [0, 0, 1, 1, 1, 1, 0]


def test_large_lookup_tables_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(expressions, "LOOKUP_ROWS", 1)
    out = handle_missing(_gaps(spark)).orderBy("id").collect()
    assert [r["x"] for r in out] == [1.0, 3.0, 2.0, 3.0, 3.0, 3.0, 10.0]


@pytest.mark.parametrize("strategy,want", [("mean", 14 / 3), ("median", 3.0)])
def test_global_fills(spark, strategy, want):
    out = handle_missing(_gaps(spark), strategy, indicators=False)
    assert out.columns == ["id", "ocean_proximity", "x"]
    assert out.where("id = 5").first()["x"] == pytest.approx(want)


def test_no_gaps_no_change(spark):
    df = spark.createDataFrame([(1.0, "a")], "x double, ocean_proximity string")
    assert handle_missing(df).columns == df.columns


def test_fitted_imputer_uses_stored_values(spark):
    imp = Imputer("median").fit(_gaps(spark))
    new = spark.createDataFrame([(1, "a", None), (2, "z", None)], "id int, ocean_proximity string, x double")
    assert [r["x"] for r in imp.transform(new).orderBy("id").collect()] == [3.0, 3.0]


def _brute_knn(pdf, cols, fill, k):
    x = pdf[cols].to_numpy()
    out = pdf[fill].copy()
    for c in fill:
        have = np.flatnonzero(pdf[c].notna())
        for i in np.flatnonzero(pdf[c].isna()):
            diff = x[have] - x[i]
            shared = (~np.isnan(diff)).sum(1)
            d = np.sqrt(np.nansum(diff**2, 1) * len(cols) / np.where(shared, shared, 1))
            ok = np.flatnonzero(shared > 0)
            near = have[ok[np.argsort(d[ok], kind="stable")[:k]]]
            out.loc[i, c] = pdf[c].to_numpy()[near].mean() if len(near) else pdf[c].mean()
    return out


@pytest.mark.parametrize("slice_rows,cell,visitors", [(2000, 50_000, 20_000), (40, 25, 7)])
def test_knn_equals_brute_force(spark, monkeypatch, slice_rows, cell, visitors):
    from gramlark.operators import knn

    monkeypatch.setattr(knn, "SLICE_ROWS", slice_rows)
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.normal(size=(400, 4)) * [1, 50, 3, 0.2], columns=list("abcd"))
    pdf.loc[rng.random(400) < 0.35, "b"] = -20.0  # one popular anchor value
    pdf["b"] += rng.normal(size=400) * 1e-6
    for c, share in (("a", 0.1), ("c", 0.15), ("b", 0.02)):
        pdf.loc[rng.random(400) < share, c] = np.nan
    pdf.loc[0, ["a", "b", "c", "d"]] = np.nan  # nothing to go by: column means
    pdf["id"] = np.arange(400)
    cols = list("abcd")
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, id long")
    fill = ["a", "b", "c", "d"]
    got = knn_impute(df, cols, fill, 5, cell, visitors).orderBy("id").toPandas()
    want = _brute_knn(pdf, cols, fill, 5)
    assert len(got) == 400
    np.testing.assert_allclose(got[fill].to_numpy(float), want.to_numpy(float), rtol=1e-9)


# -- outliers ----------------------------------------------------------------


def _spread(spark):
    rows = [(float(i),) for i in range(20)] + [(1000.0,), (None,)]
    return spark.createDataFrame(rows, "x double")


def test_clip_keeps_nulls_and_mark_counts(spark):
    df = _spread(spark)
    x = np.append(np.arange(20.0), 1000.0)
    q1, q3 = np.quantile(x, [0.25, 0.75])
    hi = q3 + 1.5 * (q3 - q1)
    clipped = outliers.handle_outliers(df, "iqr", "clip")
    assert clipped.agg(F.max("x")).first()[0] == pytest.approx(hi)
    assert clipped.where("x IS NULL").count() == 1
    marked = outliers.handle_outliers(df, "iqr", "mark")
    assert marked.agg(F.sum("x_is_outlier")).first()[0] == 1
    calm = df.where("x < 20")
    assert outliers.handle_outliers(calm, "iqr", "mark").columns == ["x"]


def test_zscore_detects_by_population_and_clips_by_sample(spark):
    df = _spread(spark)
    x = np.append(np.arange(20.0), 1000.0)
    b = outliers.zscore_bounds(df, ["x"], 2.0)["x"]
    assert b.hi == pytest.approx(x.mean() + 2 * x.std()) and b.clip_hi == pytest.approx(x.mean() + 2 * x.std(ddof=1))


def test_remove_is_sequential(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf.loc[:20, "b"] += 5
    pdf.loc[:10, "a"] += 30
    kept = pdf
    for c in "ab":
        q1, q3 = kept[c].quantile([0.25, 0.75])
        kept = kept[(kept[c] >= q1 - 1.5 * (q3 - q1)) & (kept[c] <= q3 + 1.5 * (q3 - q1))]
    got = outliers.handle_outliers(spark.createDataFrame(pdf), "iqr", "remove").toPandas()
    np.testing.assert_allclose(np.sort(got.a), np.sort(kept.a))


def test_forest_steps_cover_the_line():
    rng = np.random.default_rng(0)
    v = np.round(rng.normal(size=256), 1)
    cuts, lengths = _tree_steps(v, rng, 8)
    assert len(lengths) == len(cuts) + 1 and (np.diff(cuts) >= 0).all()
    assert average_path(np.array([1, 2, 256]))[1] == 1.0


@pytest.mark.parametrize("n", [500, 40_000])
def test_isolation_forest_marks_the_tails(spark, n):
    df = spark.range(n).select(F.randn(7).alias("x"))
    df = spark.createDataFrame(df.toPandas())
    out = IsolationScorer.fit(df, "x").mark(df).toPandas()
    share = out.x_is_outlier.mean()
    assert 0.05 < share <= 0.11
    assert out.loc[out.x.abs().idxmax(), "x_is_outlier"] == 1
    assert out[out.x_is_outlier == 1].x.abs().mean() > 2 * out[out.x_is_outlier == 0].x.abs().mean()


def test_forest_cannot_clip(spark):
    df = _spread(spark)
    with pytest.warns(UserWarning, match="clip"):
        assert outliers.handle_outliers(df, "isolation_forest", "clip") is df


# -- derived, encoded, scaled ------------------------------------------------


def test_zero_divisors_give_null(spark):
    cols = {c: 0.0 for c in schema.NUMERIC}
    out = derive.ratio_features(spark.createDataFrame([tuple(cols.values())], list(cols))).first()
    assert all(out[c] is None for c in derive.RATIO_FEATURES)


def test_polynomial_default_features(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(50, 7)), columns=[f"f{i}" for i in range(6)] + ["median_house_value"])
    df = derive.polynomial_features(spark.createDataFrame(pdf), degree=3)
    assert len(df.columns) == 7 + 10
    plain = derive.polynomial_features(spark.createDataFrame(pdf.drop(columns="median_house_value")))
    assert "f0_f0^2" in plain.columns and "f5_f5^2" not in plain.columns


def test_unseen_categories(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("a", 5.0), (None, 9.0)], "s string, median_house_value double")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    hot = encode.Encoder("onehot").fit(train, ["s"]).transform(new).collect()
    assert [tuple(r) for r in hot] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    mean = encode.Encoder("target").fit(train, ["s"]).transform(new)
    assert sorted((r[0] or 0.0) for r in mean.collect()) == [0.0, 0.0, 4.0]
    freq = encode.Encoder("frequency").fit(train, ["s"]).transform(new)
    assert max(r[0] or 0.0 for r in freq.collect()) == pytest.approx(2 / 3)


@pytest.mark.parametrize("method", ["standard", "robust", "minmax", "unknown"])
def test_constant_columns_scale_to_zero(spark, method):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, x double")
    out = scale.Scaler(method).fit(df).transform(df).toPandas()
    assert (out.c == 0).all()
    assert out.x.max() == pytest.approx({"standard": 1.0, "unknown": 1.0, "robust": 1.0, "minmax": 1.0}[method])


def test_selection_prefers_informative_columns(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(600, 6)), columns=[f"f{i}" for i in range(6)])
    pdf["dup"] = pdf.f0
    pdf["median_house_value"] = 5 * pdf.f0 + 3 * pdf.f1 + rng.normal(size=600) * 0.1
    df = spark.createDataFrame(pdf)
    assert set(select.select_features(df, method="correlation", k_best=3)) == {"f0", "dup", "f1"}
    assert "f1" in select.select_features(df, method="mutual_info", k_best=3)
    # of the equal pair one goes first, the other then carries the whole weight
    kept = select.select_features(df, method="rfe", k_best=2)
    assert "f1" in kept and ("f0" in kept or "dup" in kept)
    assert len(select.select_features(df, method="hybrid")) == 1
    with pytest.raises(ValueError):
        select.select_features(df, method="magic")


def test_elimination_equals_refitting(spark):
    from gramlark.functions.moments import gram_by

    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5))
    y = x @ [1.0, 0.5, 4.0, 0.1, 2.0] + rng.normal(size=300) * 0.05
    pdf = pd.DataFrame(x, columns=list("abcde")).assign(y=y)
    left = list("abcde")
    while len(left) > 2:
        a = np.column_stack([np.ones(300), pdf[left]])
        left.pop(int(np.argmin(np.linalg.lstsq(a, y, rcond=None)[0][1:] ** 2)))
    assert select.eliminate(gram_by(spark.createDataFrame(pdf), list("abcde"), "y")[0], 2) == left


def test_clusters_find_separate_groups(spark):
    rng = np.random.default_rng(9)
    centers = np.array([[0, 0], [10, 0], [0, 10]])
    pdf = pd.DataFrame(np.repeat(centers, 50, axis=0) + rng.normal(size=(150, 2)) * 0.2, columns=["latitude", "longitude"])
    pdf["median_house_value"] = np.repeat([1.0, 2.0, 3.0], 50)
    df = spark.createDataFrame(pdf)
    geo = GeoClusters(k=3, n_init=2).fit(df)
    out = geo.transform(df).toPandas()
    assert out.groupby("geo_cluster").size().tolist() == [50, 50, 50]
    assert (out.cluster_mean_value == out.median_house_value).all() and (out.cluster_std_value == 0).all()
    assert silhouette(df, geo) > 0.95


# -- folds and metrics -------------------------------------------------------


def test_folds_are_stable_and_balanced(spark):
    df = spark.range(1003).withColumn("key", F.col("id").cast("string"))
    a = folds.assign_folds(df.repartition(1), "key").orderBy("id").toPandas()
    b = folds.assign_folds(df.repartition(8), "key").orderBy("id").toPandas()
    assert (a.fold == b.fold).all()
    even = folds.assign_balanced_folds(df, "key").groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in even] == [201, 201, 201, 200, 200]
    tiny = folds.assign_balanced_folds(df.limit(3), "key", 5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in tiny) == [0, 1, 2]
    with pytest.raises(ValueError):
        folds.side(a, 0, "test")


def test_content_key_separates_nulls_and_text(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("a", "")], "x string, y string")
    assert folds.content_key(df).select("row_key").distinct().count() == 3


def test_fold_summary_with_a_one_row_fold(spark):
    rows = [(0, 1.0), (0, 2.0), (0, 6.0), (1, 5.0)]
    df = spark.createDataFrame(rows, "fold int, median_house_value double")
    s = {r["fold"]: r for r in folds.fold_summary(df).collect()}
    assert s[1]["validation_std_target"] is None and s[0]["train_std_target"] is None
    assert s[1]["train_mean_target"] == 3.0 and s[1]["train_std_target"] == pytest.approx(np.std([1, 2, 6], ddof=1))


@pytest.mark.parametrize("y,p,r2", [
    ([1, 2, 3, 4, 5], [1.1, 2.1, 2.9, 4.1, 4.9], 0.995),
    ([3, 3, 3, 3, 3], [2.9, 3.1, 3.0, 3.1, 2.9], 0.0),
    ([1.0], [1.1], 0.0),
])
def test_metric_edge_cases(spark, y, p, r2):
    df = spark.createDataFrame(list(zip(map(float, y), map(float, p))), "y double, p double")
    m = evaluate.all_metrics(df, F.col("y"), F.col("p")).first().asDict()
    assert m["r2"] == pytest.approx(r2)
    e = np.array(y) - np.array(p)
    assert m["median_ae"] == pytest.approx(np.median(np.abs(e)))
    assert all(v is not None and math.isfinite(v) for v in m.values())


def test_zero_truth_is_outside_every_band(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 10.1)], "y double, p double")
    m = evaluate.all_metrics(df, F.col("y"), F.col("p")).first()
    assert m["within_20pct"] == 50.0


# -- tables, registry, charts ------------------------------------------------


def test_fold_tables_and_ids(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("row_id"), F.lit(1.5).alias("x"), (F.col("id") % 4).cast("int").alias("fold"))
    path = str(tmp_path / "folds")
    tables.write_folds(df, path)
    assert tables.read_fold(spark, path, 1, "validation").count() == 5
    assert tables.read_fold(spark, path, 1, "train").count() == 15
    plan = tables.read_fold(spark, path, 1, "validation")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan
    paths = {}
    for k in range(4):
        p = tmp_path / f"ids{k}.csv"
        p.write_text("0\n" + "\n".join(str(i) for i in range(20) if i % 4 == k) + "\n")
        paths[k] = str(p)
    ids = tables.read_fold_ids(spark, paths)
    joined = tables.attach_fold_ids(df.drop("fold"), ids)
    assert joined.join(df, ["row_id", "fold"]).count() == 20


def test_csv_round_trip_and_empty_table(spark, tmp_path, raw):
    path = str(tmp_path / "csv")
    sample = raw.select(schema.RAW_COLUMNS).limit(50)
    tables.write_processed(sample, path, "csv")
    back = tables.read_raw(spark, path)
    assert back.exceptAll(sample).count() == 0 and back.schema == sample.schema
    empty = str(tmp_path / "empty")
    tables.write_processed(sample.limit(0), empty)
    with pytest.raises(ValueError):
        tables.read_processed(spark, empty)


def test_registry(spark, tmp_path):
    path = str(tmp_path / "models")
    for day in (1, 3, 2):
        m = LinearModel("ridge_regression", ["a", "b"], np.array([0.0, float(day)]), 1.0, {"alpha": float(day)})
        registry.save_models(registry.model_rows(spark, [(m, None, {"r2": 0.5}, datetime(2024, 1, day))]), path)
    models = registry.load_models(spark, path)
    assert registry.latest(models).first()["coefficients"] == [0.0, 3.0]
    assert registry.at_time(models, "ridge_regression", datetime(2024, 1, 2)).count() == 1
    assert [r["ts"].day for r in registry.listing_by_age(models).collect()] == [3, 2, 1]
    keys = models.select(registry.model_key(F.col("model"), F.col("hyper"))).distinct()
    assert keys.count() == 3
    stats = registry.coefficient_stats(registry.coefficient_rows(models)).first()
    assert stats["n"] == 6 and stats["zeros"] == 3 and stats["zero_percent"] == 50.0


def test_first_and_last_weights(spark):
    m = LinearModel("m", [f"f{i}" for i in range(30)], np.arange(30.0), 0.0)
    rows = registry.coefficient_rows(registry.model_rows(spark, [(m, None, {}, datetime(2024, 1, 1))]))
    assert sorted(r["position"] for r in registry.first_and_last(rows).collect()) == [*range(10), *range(20, 30)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5.0, 1.0), (10.0, 1.0), (None, 1.0)], "x double, k double")
    rows = {(r["column"], r["bin"]): r["count"] for r in plotdata.histogram(df, ["x", "k"], 5).collect()}
    assert rows == {("x", 0): 1, ("x", 2): 1, ("x", 4): 1, ("k", 2): 4}


def test_density_integrates_to_one(spark):
    df = spark.range(2000).select(F.randn(3).alias("x"))
    pts = plotdata.kde(df, "x").orderBy("x").toPandas()
    assert np.trapezoid(pts.density, pts.x) == pytest.approx(1.0, abs=0.01)


def test_knn_groups_skip_far_boxes_and_find_the_same(monkeypatch):
    from gramlark.operators import knn

    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 40, 6_000) * 100.0, rng.uniform(0, 900, 6_000), rng.integers(0, 30, 6_000)])
    x[rng.random(x.shape) < 0.002] = np.nan
    values = np.where(rng.random(6_000) < 0.1, np.nan, rng.integers(0, 50, 6_000))
    q = x[rng.permutation(6_000)[:700]] + rng.integers(0, 2, (700, 3))
    q[:, 2][::5] = np.nan
    want = knn._nearest(q, x, values, 5)
    pairs, plain = [], knn._nearest
    monkeypatch.setattr(knn, "_nearest", lambda a, b, *rest: pairs.append(len(a) * len(b)) or plain(a, b, *rest))
    got = knn._boxed_nearest(q, x, values, 5)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert sum(pairs) < 0.6 * len(q) * len(x)
    few = knn._boxed_nearest(q, x[:300], values[:300], 5)
    assert all(np.array_equal(a, b) for a, b in zip(few, plain(q, x[:300], values[:300], 5)))
    none = knn._boxed_nearest(q, x, np.full(6_000, np.nan), 5)
    assert [len(c) for c in none] == [0, 0, 0]


def test_knn_writes_a_row_per_gap_and_not_candidates_of_every_cell(spark, monkeypatch):
    from gramlark.operators import knn

    rng = np.random.default_rng(8)
    n = 4_000
    pdf = pd.DataFrame({"a": rng.integers(0, 3, n) * 1000.0, "b": rng.uniform(0, 900, n), "c": rng.uniform(0, 50, n)})
    pdf["v"] = np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 90, n))
    pdf["id"] = np.arange(n)
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, v double, id long")
    written, plain = {}, knn.stage

    def counted(df, name, **options):
        out = plain(df, name, **options)
        written[name] = out.count()
        return out

    monkeypatch.setattr(knn, "stage", counted)
    cols = list("abcv")
    got = knn_impute(df, cols, ["v"], 5, cell_rows=60, visitor_rows=50).orderBy("id").toPandas()
    np.testing.assert_allclose(got["v"].to_numpy(float), _brute_knn(pdf, cols, ["v"], 5)["v"], rtol=1e-9)
    assert sum(written.values()) < 2 * n  # each of the three slices of a had 23 cells, with 5 candidates a gap in each


def test_knn_trees_split_gap_kinds_ties_and_limits(spark):
    from gramlark.operators import knn

    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 4, 3_000) * 10.0, rng.uniform(0, 9, 3_000), rng.uniform(0, 5, 3_000)])
    x[rng.random(3_000) < 0.2, 1] = np.nan
    layout = knn._Layout(2)
    kind = knn._kinds(x, 2)
    for name in ("00", "01", None):
        layout.grow(name, x[kind == name] if name else x[:0])
    leaf = layout.leaf_of(x)
    assert layout.leaves > 50 and set(leaf) <= set(range(layout.leaves))
    assert all(len(set(kind[leaf == v])) == 1 for v in set(leaf))
    rows = []
    for v in sorted(set(leaf)):
        own, gap = x[leaf == v], np.isnan(x[leaf == v])
        rows.append((v, len(own), *np.where(gap, -np.inf, own).min(0), *np.where(gap, np.inf, own).max(0)))
    frame = spark.createDataFrame(
        [tuple(int(c) if i < 2 else float(c) for i, c in enumerate(r)) for r in rows],
        "_leaf int, rows long, l0 double, l1 double, l2 double, h0 double, h1 double, h2 double",
    )
    layout.limit(frame.collect(), 20)
    q = np.array([[11.0, 4.0, np.nan], [np.nan, 2.0, np.nan], [30.0, np.nan, np.nan]])
    reach = np.array([3.0, 0.7, np.inf])
    row, cell = layout.reached(q, reach)
    d = knn._distances(q[:, None, :], x[None, :, :])
    for i in range(3):
        near = {v for v, dist in zip(leaf, d[i]) if dist <= reach[i] and np.isfinite(dist)}
        cells = {c for v in near for c in range(layout.starts[v], layout.starts[v] + layout.cells[v])}
        assert cells <= set(cell[row == i])
    assert len(cell[row == 0]) < 0.6 * layout.cells.sum() and len(cell[row == 2]) == layout.cells.sum()


def test_listing_steps_keep_the_rows(spark, sf_dir):
    from gramlark.catalog.base import lean_listing
    from gramlark.session import TIDY_CONF
    from gramlark.sources.listing import listing

    columns = ["row_key", "longitude", "latitude", "housing_median_age", "total_bedrooms"]
    before = spark.conf.get(TIDY_CONF, None)
    got, want = lean_listing(spark, sf_dir, columns), listing(spark, sf_dir, columns)
    assert got.columns == columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.conf.get(TIDY_CONF, None) == before
