"""Scans and sinks of the working tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramlark.operators.folds import side
from gramlark.schema import RAW_SCHEMA, nan_to_null, require_rows


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """CSV with a header, under a declared schema; an empty table is an error."""
    df = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return require_rows(nan_to_null(df))


def read_processed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.option("header", True).option("inferSchema", True) if fmt == "csv" else spark.read
    return require_rows(nan_to_null(reader.format(fmt).load(path)))


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_folds(df: DataFrame, path: str) -> None:
    """One copy of the rows, partitioned by fold.

    Rows are gathered by fold first, so that not every task writes a file per
    fold; the rebalancing splits folds that are large for one task.
    """
    df.hint("rebalance", "fold").write.mode("overwrite").partitionBy("fold").parquet(path)


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_fold(spark: SparkSession, path: str, fold: int, which: str) -> DataFrame:
    """Training or validation side of a fold; the scan prunes partitions."""
    return side(read_folds(spark, path), fold, which)


def read_fold_ids(spark: SparkSession, paths: dict[int, str], key: str = "row_id") -> DataFrame:
    """Explicit assignment files (one header line, one id per line) as (id, fold)."""
    parts = [
        spark.read.option("header", True).schema(T.StructType([T.StructField(key, T.LongType())]))
        .csv(p).withColumn("fold", F.lit(k))
        for k, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def attach_fold_ids(df: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    return df.join(ids, key, "inner")


def write_rows(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append to a long table of metrics, report rows or profile rows."""
    df.write.mode(mode).parquet(path)
