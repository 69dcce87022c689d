"""Faults found in review: missing sides of metrics, results that followed the layout, gaps in the flow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramlark.functions.quantiles import quantile_map
from gramlark.operators import evaluate
from gramlark.operators.forest import IsolationScorer
from gramlark.operators.impute import Imputer
from gramlark.operators.knn import knn_impute
from gramlark.operators.outliers import handle_outliers
from gramlark.operators.sgd import fit_sgd
from gramlark.plans.feature_flow import FeatureFlow
from gramlark.schema import TARGET


def test_metrics_leave_rows_without_a_prediction_out(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (9e9, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    both = df.where("y IS NOT NULL AND p IS NOT NULL")
    y, p = F.col("y"), F.col("p")
    got, want = (evaluate.all_metrics(x, y, p).first().asDict() for x in (df, both))
    assert got == pytest.approx(want)
    assert evaluate.row_counts(df, y, p).first() == (3, 2)


def test_forest_sample_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=3000))], "i long, v double")
    a, b = (IsolationScorer.fit(df.repartition(n), "v") for n in (1, 7))
    assert a.cut == b.cut and np.array_equal(a.steps, b.steps)


def test_forest_flags_only_columns_with_outliers(spark):
    rows = [(5.0, float(i), 0.0) for i in range(200)] + [(5.0, 1e6, 0.0)]
    df = spark.createDataFrame(rows, "same double, v double, y double")
    out = handle_outliers(df, "isolation_forest", "mark", columns=["same", "v"], target="y")
    assert "v_is_outlier" in out.columns and "same_is_outlier" not in out.columns


def test_sgd_does_not_depend_on_the_layout(spark):
    x = np.random.default_rng(1).normal(size=(2000, 2))
    df = spark.createDataFrame([(*map(float, r), float(2 * r[0] - r[1] + 5)) for r in x], "a double, b double, y double")
    fits = [fit_sgd(df.repartition(n), ["a", "b"], "y", learning_rate=0.05) for n in (1, 8, 16)]
    for m in fits:
        assert m.converged and len(m.history) == len(fits[0].history)
        np.testing.assert_allclose(np.append(m.coef, m.intercept), [2, -1, 5], atol=0.05)
        np.testing.assert_allclose(m.coef, fits[0].coef, rtol=1e-9)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_of_the_widest_range(spark, by):
    values = [-1.5e308, -1.0, 0.0, 2.0, 1.5e308] * 40
    df = spark.createDataFrame([("x", v) for v in values], "g string, v double")
    if by:
        from gramlark.functions.quantiles import exact_quantiles

        got = exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], by=by, small_group_rows=10, bins=16, final_rows=5).first()["q"]
    else:
        got = quantile_map(df, ["v"], [0.0, 0.5, 1.0], small_group_rows=10, bins=16, final_rows=5)["v"]
    assert list(got) == [-1.5e308, 0.0, 1.5e308]


def test_neighbour_ties_take_the_smaller_values(spark):
    rows = [(0.0, None)] + [(1.0, float(v)) for v in range(60)]
    df = spark.createDataFrame(rows, "x double, v double")
    for n in (1, 3, 7):
        out = knn_impute(df.repartition(n), ["x", "v"], ["v"], k=4)
        assert out.where("x = 0").first()["v"] == 1.5


def test_neighbours_are_those_of_the_fit(spark):
    train = spark.createDataFrame([(0.0, 1.0, 7.0), (10.0, 2.0, 8.0), (10.0, None, 9.0)], "x double, v double, y double")
    imputer = Imputer("knn", indicators=False).fit(train, ["x", "v"])
    new = spark.createDataFrame([(9.0, None, 7.0), (9.0, 500.0, 7.0)], "x double, v double, y double")
    assert imputer.donors.columns == ["x", "v"]
    assert {r["v"] for r in imputer.transform(new).collect()} == {1.5, 500.0}


def test_flow_survives_zero_divisors_and_new_gaps(spark, raw, tmp_path):
    one = raw.agg(F.min("row_key")).scalar()
    bad = raw.withColumns(
        {
            "households": F.when(F.col("row_key") == one, 0.0).otherwise(F.col("households")),
            "population": F.when(F.col("row_key") == one, -5.0).otherwise(F.col("population")),
        }
    )
    flow = FeatureFlow(outlier_method="zscore", selection=None, cluster_starts=1).fit(bad)
    new = raw.limit(20).withColumns({"latitude": F.lit(None).cast("double"), "households": F.lit(0.0)})
    flow.save(spark, str(tmp_path / "flow"))
    for rows in (bad, new):
        out = FeatureFlow.load(spark, str(tmp_path / "flow")).transform(rows).select(flow.selected)
        assert out.where(" OR ".join(f"`{c}` IS NULL" for c in out.columns)).isEmpty()
    assert TARGET not in flow.fills


def test_points_of_a_pass_travel_in_blocks_and_the_nearest_centre_is_the_first_of_equals(spark):
    from gramlark.operators import cluster

    points = spark.range(50_000).selectExpr("cast(id % 7 AS double) AS a", "cast(id % 11 AS double) AS b", "1.0D AS weight")
    blocks = cluster._blocks(points, ["a", "b"])
    assert blocks.count() < 50
    x = np.array([[0.0, 1.0, 2.0], [0.0, 0.0, 0.0]])
    near, d = cluster._nearest(x, np.array([[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]]))
    assert near.tolist() == [0, 0, 1] and d.tolist() == [0.0, 1.0, 0.0]
    moved = cluster._move(blocks, ["a", "b"], {0: np.array([[0.0, 0.0], [6.0, 10.0]])})[0]
    assert moved[:, 0].sum() == 50_000 and moved[:, 1].sum() == sum(i % 7 for i in range(50_000))
