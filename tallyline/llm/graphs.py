"""Connected components of a table of links, in rounds of joins and combining minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` of every node that a link names; the root is the smallest node reachable.

    Alternating stars: each round ties the neighbours of every node to the smallest of them, first the
    larger ones, then all smaller ones. Every round is written as a table, so that a lost executor costs
    no earlier round; the driver only learns whether a round was the last. Links may repeat or join a node to itself; a
    null on either side is no link.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = stored(_large_star(edges.where("u <> v").distinct()), "edges")
    while True:
        edges = stored(_small_star(edges), "edges")
        # Done when every node has one tie, to a node that has none.
        inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        twice = edges.groupBy("u").count().where("count > 1")
        if inner.select("u").unionByName(twice.select("u")).isEmpty():
            break
        edges = stored(_large_star(edges), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(smallest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
