"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the
    smallest node reachable.

    Alternating large-star and small-star rounds: every round hangs neighbours
    on the smallest node known, until nothing changes; the number of rounds grows
    with the logarithm of the number of nodes.  A hub's neighbours stay separate
    rows joined with the hub's minimum, so they never meet in one group.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, "edges")
    before = None
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        pairs = stored(small, "stars")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
