"""The feature flow and the registered queries end to end."""

import pytest
from pyspark.sql import functions as F

from gramlark.catalog import QUERIES
from gramlark.plans.feature_flow import FeatureFlow
from gramlark.schema import CATEGORY, TARGET
from tests.compare import differences, duck


@pytest.fixture(scope="module")
def flow(raw):
    return FeatureFlow(cluster_starts=1).fit(raw.where("fold <> 0"))


def test_transform_needs_fit(raw):
    with pytest.raises(ValueError):
        FeatureFlow().transform(raw)


def test_default_flow_selects_a_quarter(flow, raw):
    # 8 raw + 1 indicator + 18 derived + 5 cluster + 5 one-hot = 37, halved twice
    assert len(flow.scaler.params) == 37
    assert len(flow.selected) == 9
    out = flow.transform(raw)
    assert out.columns == ["row_key", "fold", TARGET, *flow.selected]
    assert out.count() == raw.count()


def test_schema_does_not_depend_on_the_rows(flow, raw):
    odd = raw.limit(5).withColumn(CATEGORY, F.lit("unheard of")).withColumn("total_bedrooms", F.lit(1.0))
    assert flow.transform(odd).schema == flow.transform(raw).schema
    no_target = raw.drop(TARGET)
    assert flow.transform(no_target).columns == ["row_key", "fold", *flow.selected]


def test_rows_are_transformed_independently(flow, raw):
    one = raw.orderBy("row_key").limit(1)
    key = one.first()["row_key"]
    a = flow.transform(one).first()
    b = flow.transform(raw).where(F.col("row_key") == key).first()
    assert a == b


def test_state_round_trip(flow, raw, spark, tmp_path):
    flow.save(spark, str(tmp_path / "flow"))
    again = FeatureFlow.load(spark, str(tmp_path / "flow"))
    a, b = flow.transform(raw), again.transform(raw)
    assert a.schema == b.schema and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("encoding", ["target", "frequency"])
def test_other_encodings_round_trip(raw, spark, tmp_path, encoding):
    flow = FeatureFlow(
        impute="mean", outlier_method="zscore", encoding=encoding, scaling="minmax", selection=None, cluster_starts=1,
        indicators=False,
    ).fit(raw)
    flow.save(spark, str(tmp_path / "flow"))
    again = FeatureFlow.load(spark, str(tmp_path / "flow"))
    assert flow.transform(raw).exceptAll(again.transform(raw)).count() == 0


def test_indicator_survives_unless_asked_to_be_clipped(raw):
    keep = FeatureFlow(selection=None, cluster_starts=1).fit(raw)
    assert "total_bedrooms_is_missing" not in keep.bounds
    erase = FeatureFlow(selection=None, cluster_starts=1, clip_indicators=True).fit(raw)
    b = erase.bounds["total_bedrooms_is_missing"]
    assert (b.clip_lo, b.clip_hi) == (0.0, 0.0)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir):
    item = QUERIES[name]
    got = item.run(spark, sf_dir).toPandas()
    assert len(got) > 0
    if item.sql:
        assert differences(got, duck(sf_dir).execute(item.sql).df()) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).columns) > 3
