"""Connected components of a graph of links, by alternating large-star and small-star steps.

Every step is an aggregate and a join, with its result written to the shared folder; a node's neighbours are never
gathered, only their minimum, and Spark splits the join where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (u, v) with u > v. Links each neighbour above (or below, with u itself) a node to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    to = both.join(least, "u")
    if larger:
        new = to.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = to.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return new.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of a link (a, b) the smallest node it can reach."""
    edges = saved(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links"
    )
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = mark(edges)
    while seen[0]:
        edges = saved(_star(_star(edges, True), False), "stars")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
