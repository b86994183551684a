"""Connected components of an edge table by alternating large-star and small-star steps, all in Spark.

A step joins every edge with the least neighbour of one of its ends. Nodes with the most edges (hubs) go by
broadcast, so that no task holds the edges of a hub. Steps go on until the edges are stars; their number grows with
the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import most_frequent, split_join
from .store import discard, materialize

HUBS = 1024


def _with_min(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v, m) with the least of u and its neighbours, and (u, m) alone."""
    sums = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    least = sums.select("u", "m")
    return split_join(edges, least, "u", most_frequent(sums, "u", "n", HUBS)), least


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both)[0].where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    rows, least = _with_min(down)
    moved = rows.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none of its own: then the edges are the components."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    sums = roles.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node of ``edges`` (u, v); component is the smallest node reachable."""
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not settled(now):
        stars = materialize(large_star(now).distinct(), "edges")
        discard(now)
        now = materialize(small_star(stars).distinct(), "edges")
        discard(stars)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
