"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.scratch import written
from riskloom.operators.bounded import broadcast_if_small


def _least_per_node(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    # a node with a third of all edges: no shuffle of edges while the table fits, else both sides
    # come straight from a scan and adaptive execution splits the node
    return broadcast_if_small(least)


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """node, component (the smallest node of its component), for every node of an edge.

    Alternates large-star and small-star steps until nothing changes, in a number of rounds that
    grows with the logarithm of the graph. Each round writes its edges, of which there are never
    more than at the start plus one per node. No edge gives no row; null ends are ignored.
    """
    now = written(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(
        "u > v").distinct(), "cc-edges")
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(both.join(_least_per_node(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "cc-large")
        joined = large.join(_least_per_node(large), "u")
        now = written(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").union(joined.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
