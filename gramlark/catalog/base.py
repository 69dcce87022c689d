"""Registration of queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.schema import NUMERIC
from gramlark.session import release, stage
from gramlark.sources.listing import listing

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    run: Run
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with reference SQL if there is one."""

    def register(fn: Run) -> Run:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} registered twice")
        QUERIES[fn.__name__] = Query(fn.__name__, fn, sql)
        return fn

    return register


def staged_listing(spark, sf_dir, columns=None, fold=False) -> DataFrame:
    """The listing written out once, for queries that pass over it repeatedly."""
    return stage(listing(spark, sf_dir, columns, fold), "listing")


def lean_listing(spark, sf_dir, columns) -> DataFrame:
    """The listing written out with little disk: each join's shuffle files go before the next one."""
    held = []

    def step(df: DataFrame) -> DataFrame:
        held.append(stage(df, "listing-step", lean=True))
        if len(held) > 1:
            release(held.pop(0))
        return held[0]

    out = stage(listing(spark, sf_dir, columns, between=step), "listing", lean=True)
    for df in held:
        release(df)
    return out


def rounded(df: DataFrame, digits: dict[str, int] | int, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round double columns, either the named ones or all of them."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if isinstance(digits, int):
        digits = {c: digits for c in doubles if c not in skip}
    return df.select(
        [F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def q(expr: str, digits: int) -> str:
    """SQL rounding that matches ``rounded`` (and has no negative zero)."""
    return f"(round({expr}, {digits}) + 0.0)::DOUBLE"


def long_cte(columns: list[str] = NUMERIC, name: str = "long", source: str = "listing") -> str:
    """CTE with rows (column, v) of the non-null values."""
    listed = ", ".join(columns)
    return (
        f'{name} AS (SELECT * FROM (SELECT {listed} FROM {source})'
        f' UNPIVOT (v FOR "column" IN ({listed})))'
    )
