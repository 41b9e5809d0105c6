"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest neighbour. Minima are partial aggregates;
    the join on a node with very many neighbours is left to Spark's skew join."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(least.select("a", F.col("_m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is the
    smallest node reachable. Each round is a written table; the driver only sees
    a count and a checksum."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = links.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct()
    edges, seen = written(edges), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = written(_star(_star(edges, True), False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
