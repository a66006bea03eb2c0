"""Connected components of a graph that is larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of ``links``; nodes are longs.

    Alternating stars: every node hangs its larger neighbours on the smallest node it sees, then its smaller ones, until
    each component is a star. Rounds grow with the logarithm of the component's size, not with its diameter. Each round
    is written to the shared folder. Neighbours are combined by ``min`` before they are shuffled; a hub is never
    gathered in one place.
    """
    edges = stored(links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node keeps its own smallest neighbour, else a local minimum would lose its link
        down = stored(large.filter("u <> v").distinct(), "components")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = stored(small.filter("u <> v").distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
