"""Connected components of links between ids.

Alternating star steps: each node's neighbours are tied to the smallest of them, first the larger ones, then the
smaller ones, until nothing changes. The links never become more, each step is an aggregation and a join, and each
result is a table in the shared folder, so that lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.workspace import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(``id``, ``component``) for every id that has a link; the component is its smallest id."""
    edges = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).where("u <> v").distinct()
    edges, before = written(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = written(_small_star(_large_star(edges)), "links")
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
