"""Connected components of edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.session import stage


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``edges(a, b)``; the component is its smallest node.

    In every round each node moves to its neighbour of smallest hash and edges
    are contracted, so rounds grow with the logarithm of the nodes, for chains
    too.  Each round's edges and names are written tables.
    """
    hashed = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
    open_ = edges.where("a <> b").select("a", "b")
    open_ = stage(open_.union(open_.select("b", "a")).distinct(), "edges")
    names = stage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("now")), "names")
    while not open_.isEmpty():
        moves = open_.groupBy("a").agg(F.min(hashed("b")).alias("best"))
        moves = stage(moves.select(F.col("a").alias("old"), F.least("best", hashed("a"))["node"].alias("new")), "moves")
        names = names.join(moves, F.col("now") == F.col("old"), "left").select("node", F.coalesce("new", "now").alias("now"))
        names = stage(names, "names")
        ends = [moves.select(F.col("old").alias(c), F.col("new").alias(f"{c}_new")) for c in ("a", "b")]
        open_ = open_.join(ends[0], "a").join(ends[1], "b").where("a_new <> b_new")
        open_ = stage(open_.select(F.col("a_new").alias("a"), F.col("b_new").alias("b")).distinct(), "edges")
    smallest = names.groupBy("now").agg(F.min("node").alias("component"))
    return names.join(smallest, "now").select("node", "component")
