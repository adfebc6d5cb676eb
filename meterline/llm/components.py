"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is an aggregation (with map-side minima) and a join, and is stored in the shared folder, so no
neighbourhood is gathered in one place and a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.where(F.col("v") > F.col("u")).join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    """Tells two edge sets apart: their number and the sum of their hashes. One row reaches the driver."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node, root`` for every node of ``edges`` (``u, v``, whole numbers) but the roots.

    The root of a component is its smallest node. Loops are left out; no edges give no rows.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select("u", "v"), "edges")
    before = None
    while (now := _signature(edges)) != before and now[0]:
        before = now
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
