"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources.tables import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; a component is named by its smallest node.

    Alternating stars: each round hangs the larger neighbours of every node on its smallest one, then
    the smaller ones, which keeps components together and ends in one star for each. A round only
    takes minima by node and joins them back, so no neighbourhood is ever gathered; rounds grow with
    the logarithm of the longest path. Each round is a stored table. Links with a null end and loops
    are ignored; repeated links count once.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))).distinct()
        # what has no larger neighbour was handed on from its smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
