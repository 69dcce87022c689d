"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_rows(
    df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable]
) -> DataFrame:
    """Map the named columns of ``df`` batch by batch; ``make()`` runs once a task.

    ``make()`` returns a function from a pandas frame with just these columns to
    a frame of ``schema``, so per-task state is built once and dies with the task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = make()
        for pdf in batches:
            if len(pdf):
                yield each(pdf)

    return df.select(*columns).mapInPandas(run, schema)


def column_map(df: DataFrame, column: str, schema: str, make: Callable[[], Callable]) -> DataFrame:
    """Keep every column of ``df`` and add one struct column ``out`` made from ``column``.

    The other columns never go through Python, so extra columns with any name
    are safe; the output struct has the fields of ``schema``.
    """

    @F.pandas_udf(f"struct<{schema}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        each = make()
        for values in batches:
            yield each(values)

    return run(F.col(column))


def unused(columns: list[str], name: str) -> str:
    """``name``, or with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def bounded_sample(df: DataFrame, rows: int, key: Column) -> pd.DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``key``: the same ones at any layout."""
    return df.orderBy(F.xxhash64(key), key).limit(rows).toPandas()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``; returns ``(node, component)``.

    ``component`` is the smallest node reachable.  Each round moves every node
    to the neighbour with the smallest pseudo-random rank and contracts the
    edges, which shrinks any graph (paths too) by a constant factor, so rounds
    grow with the logarithm of the nodes.  A round's edges are a written table.
    Hubs are pre-aggregated in the minimum and left to skewed-join splitting in
    the lookups.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    both = edges.where("a <> b").select("a", "b")
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = None
    while not both.isEmpty():
        move = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        move = move.select(F.col("a").alias("node"), F.least("low", rank("a"))["n"].alias("to"))
        move = stage(move, "moves")
        if label is None:
            label = move.select("node", F.col("to").alias("label"))
        else:
            step = move.select(F.col("node").alias("label"), "to")
            label = label.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        label = stage(label, "labels")
        left = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        both = both.join(left, "a").join(right, "b").where("x <> y")
        both = stage(both.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    low = label.groupBy("label").agg(F.min("node").alias("component"))
    return label.join(low, "label").select("node", "component")
