"""Versioned tables and one-scan overviews."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gramlark.operators.overview import overview, write_with_overview
from gramlark.plans.ranking import candidate_rows
from gramlark.sources import versions

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def numbers(spark, n):
    return spark.range(n).withColumn("t", F.lit("x"))


def test_only_committed_versions_are_read(spark, tmp_path):
    root = str(tmp_path / "kept")
    assert versions.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    first = versions.write_version(numbers(spark, 3), root, NOON)
    second = versions.write_version(numbers(spark, 5), root, NOON + timedelta(minutes=1))
    fails = numbers(spark, 4).withColumn("t", F.raise_error(F.lit("stopped half-way")))
    with pytest.raises(Exception, match="stopped half-way"):
        versions.write_version(fails, root, NOON + timedelta(minutes=2))
    numbers(spark, 7).write.parquet(f"{root}/20240101T130000000000-unmarked")
    assert versions.versions(spark, root) == [first, second]
    assert versions.read_version(spark, root).count() == 5
    assert versions.read_version(spark, root, first).count() == 3
    assert versions.read_version(spark, root, until=NOON + timedelta(seconds=59)).count() == 3
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root, until=NOON - timedelta(seconds=1))
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root, "20240101T130000000000-unmarked")


def test_old_versions_go_and_readers_keep_theirs(spark, tmp_path):
    root = str(tmp_path / "kept")
    for k in range(4):
        versions.write_version(numbers(spark, k + 1), root, NOON + timedelta(minutes=k))
    numbers(spark, 2).write.parquet(f"{root}/20240101T110000000000-unmarked")
    assert versions.drop_versions(spark, root, keep=2) == 3
    assert [versions.read_version(spark, root, v).count() for v in versions.versions(spark, root)] == [3, 4]


def test_overview_reads_once(spark, tmp_path):
    rows = [(float(i % 100), None if i % 10 == 0 else i, "abc"[i % 3], i % 2 == 0) for i in range(5_000)]
    rows += [(float("inf"), 1, None, None), rows[1], rows[2]]
    spark.createDataFrame(rows, "a double, b int, c string, d boolean").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = overview(df, target="b")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r["column"]: r for r in out.collect()}
    assert {c: (r.role, r.nulls, r.infinite) for c, r in got.items()} == {
        "a": ("numerical", 0, 1), "b": ("target", 500, 0), "c": ("categorical", 1, None), "d": ("other", 1, None),
        "*": ("table", got["*"].nulls, None),
    }
    assert got["c"].distinct == 3 and got["d"].distinct == 2 and got["a"].distinct == pytest.approx(101, abs=2)
    assert got["b"].distinct == pytest.approx(4_500, rel=0.03)
    assert got["a"].q50 == pytest.approx(49.5, abs=2) and got["b"].q25 == pytest.approx(1_250, abs=60)
    assert got["*"].distinct == pytest.approx(4_531, rel=0.03) and got["*"].rows == 5_003
    seen = {r["column"]: r for r in write_with_overview(df, str(tmp_path / "copy"), target="b").collect()}
    exact = lambda rows: {c: (r.nulls, r.mean, r["max"], r.role) for c, r in rows.items() if c != "*"}
    assert exact(seen) == exact(got) and seen["*"].rows == 5_003
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 5_003


def test_overview_of_no_rows(spark):
    got = {r["column"]: r for r in overview(spark.createDataFrame([], "a double, c string"), target="c").collect()}
    assert (got["a"].rows, got["a"].nulls, got["a"].distinct, got["a"].q50, got["*"].distinct) == (0, 0, 0, None, 0)


def test_candidates_without_a_known_configuration(spark):
    summary = spark.createDataFrame(
        [("m1", "validation", 0.5, 1.0, 1.0), ("m2", "validation", 0.9, 1.0, 1.0), ("m2", "train", 1.0, 1.0, 1.0)],
        "model string, side string, r2 double, rmse double, mae double",
    )
    got = candidate_rows(summary, {"m2": {"alpha": "1", "description": "ridge"}}, 5, NOON).orderBy("rank").collect()
    assert [(r.rank, r.model, r.avg_r2, r.description, dict(r.config)) for r in got] == [
        (1, "m2", 0.9, "ridge", {"alpha": "1"}), (2, "m1", 0.5, "", {}),
    ]
    assert {r.selection_date for r in got} == {"2024-01-01 12:00:00"}
    assert len(candidate_rows(summary, {}, 1).first().selection_date) == 19
