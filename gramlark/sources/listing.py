"""The housing-shaped ``listing`` view over the star schema in the data folder.

One row per line item.  Every dimension is reached by a left join on its key,
so the row set never depends on which columns are asked for, and a dimension
whose columns are not wanted is not joined at all.  Customers are joined to
orders before the fact table, which saves one shuffle of the fact rows.  No
side is marked for broadcast: dimensions grow with the data, so the choice is
left to the statistics Spark has at run time.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.schema import RAW_COLUMNS

FOLDS = 5

# column -> (dimensions it needs, Spark SQL expression)
_COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "longitude": (("supplier",), "s_acctbal / 1000D - 124D"),
    "latitude": (("orders",), "c_acctbal / 1000D + 32D"),
    "housing_median_age": (("part",), "cast(p_size AS DOUBLE)"),
    "total_rooms": ((), "l_quantity * 100D"),
    "total_bedrooms": (
        (),
        "CASE WHEN l_tax = 0D THEN NULL ELSE l_quantity * 20D * (1D + l_tax) END",
    ),
    "population": (("part",), "cast(p_size * 25 + l_partkey % 400 AS DOUBLE)"),
    "households": ((), "l_quantity * 15D + cast(l_orderkey % 200 + 1 AS DOUBLE)"),
    "median_income": ((), "l_discount * 100D + 0.5D"),
    "median_house_value": (
        ("part",),
        "20000D + 800D * l_quantity + 150000D * l_discount"
        " + 200D * cast(p_size AS DOUBLE) + 0.2D * l_extendedprice",
    ),
    "ocean_proximity": (("orders",), "c_mktsegment"),
    "row_key": (
        (),
        "concat_ws('-', cast(l_orderkey AS STRING), cast(l_partkey AS STRING),"
        " cast(l_suppkey AS STRING), cast(l_linenumber AS STRING))",
    ),
}


_NAMES = re.compile(r"\b[lcps]_[a-z]+\b")  # the tables' columns in those expressions


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket number from the first 32 bits of the key's MD5, the same in any engine."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def listing(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | None = None,
    fold: bool = False,
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The listing table, restricted to ``columns``; ``fold`` adds a fold column.

    ``between`` is applied to the rows before each join but the first, with the
    columns still needed, for instance to write them down.
    """
    wanted = list(columns) if columns is not None else list(RAW_COLUMNS)
    needs = {dim for c in wanted for dim in _COLUMNS[c][0]}
    exprs = {c: _COLUMNS[c][1] for c in wanted}
    df = read_table(spark, sf_dir, "lineitem")
    joins = []
    if "orders" in needs:
        customer = read_table(spark, sf_dir, "customer").select(
            "c_custkey", "c_acctbal", "c_mktsegment"
        )
        orders = (
            read_table(spark, sf_dir, "orders")
            .select("o_orderkey", "o_custkey")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "c_acctbal", "c_mktsegment")
        )
        joins.append((orders, "l_orderkey", "o_orderkey"))
    if "part" in needs:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
        joins.append((part, "l_partkey", "p_partkey"))
    if "supplier" in needs:
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
        joins.append((supplier, "l_suppkey", "s_suppkey"))
    keyed = _COLUMNS["row_key"][1] if fold else ""
    for i, (dim, own, key) in enumerate(joins):
        if i and between:
            used = set(_NAMES.findall(" ".join([*exprs.values(), keyed])))
            used |= {k for _, k, _ in joins[i:]}
            df = between(df.select([c for c in df.columns if c in used]))
        df = df.join(dim, F.col(own) == F.col(key), "left")
    out = [F.expr(e).alias(c) for c, e in exprs.items()]
    if fold:
        out.append(hash_bucket(F.expr(keyed), FOLDS).alias("fold"))
    return df.select(out)


# The same view for the SQL side of a comparison.
LISTING_SQL = """
SELECT s_acctbal / 1000.0 - 124 AS longitude,
       c_acctbal / 1000.0 + 32 AS latitude,
       p_size::DOUBLE AS housing_median_age,
       l_quantity * 100 AS total_rooms,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity * 20 * (1 + l_tax) END AS total_bedrooms,
       (p_size * 25 + l_partkey % 400)::DOUBLE AS population,
       l_quantity * 15 + (l_orderkey % 200 + 1)::DOUBLE AS households,
       l_discount * 100 + 0.5 AS median_income,
       20000 + 800 * l_quantity + 150000 * l_discount + 200 * p_size::DOUBLE
         + 0.2::DOUBLE * l_extendedprice AS median_house_value,
       c_mktsegment AS ocean_proximity,
       concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key,
       (('0x' || substr(md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 8))::BIGINT
         % 5)::INTEGER AS fold
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
""".strip()


def with_listing(body: str, extra: str = "", recursive: bool = False) -> str:
    """SQL text with the listing view (and further CTEs) in scope."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    tail = f",\n{extra.strip()}" if extra.strip() else ""
    return f"{head}listing AS (\n{LISTING_SQL}\n){tail}\n{body.strip()}"
