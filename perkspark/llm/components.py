"""Connected components by alternating large and small stars, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One star step over edges (a, b): links go from each node's neighbours to its smallest one."""
    links = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        links = links.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = links.join(least, "u")
    if both:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge (a, b); a component is its smallest node.

    Edges are long pairs, repeated ones and loops allowed.  No step gathers a
    node's neighbours: each is a minimum and a join, which splits hot nodes.
    """
    edges = checkpointed(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct())
    state = None
    while True:
        edges = checkpointed(_star(_star(edges, both=True), both=False))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
