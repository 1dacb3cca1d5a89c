"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours of each node at the smallest node around it.

    A large star moves the neighbours above a node, a small one those below it and the
    node itself.
    """
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        turned = turned.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = F.least(F.min("v"), "u")
    else:  # edges have a < b, so what lies below a node is what it is turned to
        least = F.min("v")
    low = turned.groupBy("u").agg(least.alias("low"))
    moved = turned.join(low, "u")
    if large:
        moved = moved.where("v > u").select(F.col("low").alias("a"), F.col("v").alias("b"))
    else:
        own = low.select(F.col("low").alias("a"), F.col("u").alias("b"))
        moved = moved.select(F.col("low").alias("a"), F.col("v").alias("b")).unionByName(own)
    return moved.where("a < b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for each node of an edge.

    Ids are whole numbers.  Loops and edges with a null end count for nothing, repeated
    edges and directions make no difference, and without edges there are no rows.
    """
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = edges.toDF("a", "b", "both").where("both and a < b").drop("both").distinct()
    edges = stored(edges, "edges")
    before, now = None, _state(edges)
    while before != now:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        before, now = now, _state(edges)
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(roots)
