"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node (summed up before the shuffle) and a join; nothing is gathered in the driver but two
counters.  Edges of each round are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(
        F.least(F.min("low"), F.first("high")).alias("least"))
    return (
        edges.join(least, edges["low"] == least["node"])
        .select("high", F.col("least").alias("low"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of a node, and the node itself, on the least of them."""
    least = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    moved = edges.join(least, edges["high"] == least["node"]).select(
        F.explode(F.array(F.struct(F.col("high"), F.col("least").alias("low")),
                          F.struct(F.col("low").alias("high"), F.col("least").alias("low")))).alias("e"))
    return moved.select("e.high", "e.low").filter("high > low").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every node of the undirected edges ``(a, b)``; the least id names the component.

    Nodes without an edge to another node are not listed.  Edges with a null end or with equal ends are ignored,
    repeated edges count once.  An empty edge list gives an empty result.
    """
    edges = (
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )
    edges = staged(edges, name)
    before = _state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), name)
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("id"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())
