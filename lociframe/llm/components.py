"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _starred(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads to the least node of its component: no a has two edges, or is the b of one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out > 0 AND into > 0").isEmpty()


def _star(edges: DataFrame) -> DataFrame:
    """edges (u, v): for each u, every v is linked to the least of u and its v."""
    least = cut(edges.groupBy("u").agg(F.min("v").alias("least")), "least").withColumn("least", F.least("u", "least"))
    return edges.join(least.withColumnRenamed("u", "hub"), F.col("u") == F.col("hub"))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component), the least node that each node of an edge reaches.

    Minima are combined before the shuffle and read back from a table, so that the join of a hub's edges with the one
    row of its minimum is a plain sort-merge join, whose large partitions Spark splits.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _starred(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        joined = _star(both)
        large = cut(joined.where("v > u").select(F.col("v").alias("a"), F.col("least").alias("b")).where("a <> b").distinct(), "large")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        joined = _star(down)
        links = joined.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("least").alias("b")), F.struct(F.col("u").alias("a"), F.col("least").alias("b")))).alias("e"))
        edges = cut(links.select("e.a", "e.b").where("a <> b").distinct(), "small")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def joined_components(found: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) with further edges (a, b): the components themselves are the nodes of a smaller graph."""
    ends = [found.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab"]
    links = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = cut(components(links), "merged")
    known = found.join(merged.select(F.col("node").alias("component"), F.col("component").alias("least")), "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    new = merged.join(found.select("node"), "node", "left_anti").select("node", "component")
    return known.union(new)
