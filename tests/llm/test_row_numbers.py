"""Row numbers are stored: another split of the input between two scans changes nothing."""

import pytest

from gramlark.llm import pii, simhash


@pytest.fixture
def docs(spark, tmp_path):
    rows = [(i, f"text number {i} of some words", "x") for i in range(40)]
    rows[8] = (8, rows[23][1], "x")
    rows += [(1000 + 5 * i, f"one more text {i} that makes this file the largest, so it is read first", "x") for i in range(30)]
    rows += [(100 + i, f"Please email: user{i}@mail.example.com soon", "x") for i in range(9)]
    rows += [(203, "again email: odd7(at)mail here", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for k in range(5):  # one file each, so that the split size decides which share a partition
        df.where(f"doc_id % 5 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    return spark.read.parquet(str(tmp_path / "d"))


@pytest.fixture
def moving_splits(spark, monkeypatch):
    """After the first staged table the input's files are dealt to partitions anew."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)

    def moved(stage):
        def run(df, label="table"):
            out = stage(df, label)
            spark.conf.set(name, str(64 << 20))
            return out

        return run

    for module in (simhash, pii):
        monkeypatch.setattr(module, "stage", moved(module.stage))
    spark.conf.set(name, "1")
    yield
    spark.conf.set(name, before)


def test_first_of_groups_at_moving_splits(docs, moving_splits):
    kept = {r.doc_id for r in simhash.first_of_groups(docs).collect()}
    assert {8, 203} <= kept and 23 not in kept and len(kept) == 79


def test_redacted_at_moving_splits(docs, moving_splits):
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[203] == "again email: [EMAIL] here" and clean[7] == "text number 7 of some words"


def test_columns_named_like_the_row_number_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, 8), (2, "a b c", 9, 8)], "doc_id long, text string, __row int, __more int")
    assert [tuple(r) for r in simhash.first_of_groups(docs).collect()] == [(1, "a b c", 7, 8)]
    assert sorted(tuple(r) for r in pii.redacted(docs).collect()) == [(1, "a b c", 7, 8), (2, "a b c", 9, 8)]
