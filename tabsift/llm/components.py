"""Connected components over an edge table, by alternating star contractions on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, component)``: the smallest node reachable from each node on an edge.

    Large-star/small-star (Kiveris et al., 2014).  Each half-step is one ``min`` per node (partial
    aggregation, no neighbour lists) and one equi-join, and replaces an edge by one to a smaller node, so
    the edge count never grows.  Each round is written to the shared folder; it ends when the edges
    no longer change, when all point at their component's smallest node.  Self-loops, repeated and reversed
    edges are allowed; no edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    both = materialize(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    seen = None
    while True:
        sign = both.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or sign[0] == 0:
            return both.select(a.alias("node"), b.alias("component")).unionByName(
                both.select(b.alias("node"), b.alias("component")).distinct()
            )
        seen = sign
        both = materialize(_small_star(_large_star(both)))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or the node itself)."""
    arcs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = arcs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        arcs.where(F.col("b") > F.col("a"))
        .join(low, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are tied to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
