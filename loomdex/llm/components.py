"""Connected components of a link table, by large-star and small-star rounds over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import keep


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it reaches. `links` has columns u, v.

    Each round is a minimum per node (combined before its shuffle) and a join; links move to ever smaller
    nodes until every node hangs directly on its root. Rounds grow with the logarithm of the longest path.
    """
    edges = keep(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, now = None, _fingerprint(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.filter("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            down.select("u", F.col("m").alias("v"))
        )
        edges = keep(small.filter("u <> v").distinct())
        before, now = now, _fingerprint(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
