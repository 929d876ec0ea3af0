"""Connected components of links that no single machine needs to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.sources.scratch import stage


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for nodes other than their root.

    ``links`` has two bigint columns. Alternates two steps until nothing moves:
    every larger neighbour of a node is linked to the node's smallest
    neighbour, then every smaller one. Minima are combined on the map side and
    joined back, so a node with very many links is never gathered in one task.
    Each round is written out, which cuts the lineage.
    """
    a, b = links.columns
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    before = _summary(edges)
    for _ in range(rounds):
        if before[0] == 0:
            break
        edges = stage(_small_star(_large_star(edges)), "links")
        after = _summary(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _summary(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(mixed).alias("total")).first()
    return row["n"], row["total"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("far"))
    moved = larger.join(lowest, "u").select(F.col("far").alias("u"), F.col("low").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(lowest, "u")
    linked = moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
        lowest.select("u", F.col("low").alias("v"))
    )
    return linked.filter("u <> v").distinct()
