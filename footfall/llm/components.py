"""Connected components of a link table, without gathering any group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored


def _toward_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m) for rows (u, v): m is the least of u and all its v. Summed up on the map side, then joined back."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the component is the smallest node that can be reached.

    Links have no direction; loops and repeats change nothing. Alternating large-star and small-star steps; every
    round is written to the shared folder, and the rounds grow with the logarithm of the longest chain.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: neighbours above a node are tied to the least node around it.
        large = _toward_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its neighbours below are tied to the least of them.
        down = _toward_least(large.filter("u <> v").distinct())
        small = down.select(F.col("u"), F.col("m").alias("v")).unionByName(
            down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = stored(small.distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
