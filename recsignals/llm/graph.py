"""Connected components of an edge table, by hooking to the smallest neighbour and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import BROADCAST_BYTES, few, stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Each round links all neighbours of a node to the smallest of them (large
    star, then small star); the rows never exceed twice the edges, hubs are
    grouped by partial aggregates only, and the rounds grow with the logarithm
    of the longest path. Rounds are cut by staged tables. While the smallest
    neighbours of all nodes are few they are broadcast, so a round has four small
    exchanges; and a round has no more tasks than its rows fill.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    rows = edges.count()
    pairs = stage(few(pairs, rows), "components")
    light = 2 * rows * 16 <= BROADCAST_BYTES
    beside = (lambda df: F.broadcast(few(df, rows))) if light else (lambda df: df)
    while True:
        # Large star: every larger neighbour of a node links to the smallest of its neighbours and itself.
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(beside(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours link to the smallest of these.
        if not light:
            large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(beside(low), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stage(few(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), rows), "components")
        # Stars are left when no node has two links upwards, or links both ways.
        ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        inner = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 AND up > 0")
        if not few(inner, rows).count():
            break
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(few(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct(), rows))
