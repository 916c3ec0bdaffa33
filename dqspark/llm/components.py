"""Connected components over a table of links, by the large-star/small-star
rounds on DataFrames. Links are aggregated by node with map-side partial
minima and joined back, so no neighbourhood is collected; every round is
written to the shared folder. ``FEW`` links or less are one partition from the
first step to the last, so that none needs a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, saved


FEW = 100_000
"""Links that one task takes, at most: a few MB."""


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("v", "u"))).first())


def is_few(df: DataFrame) -> bool:
    """Whether a ``saved`` table has so few rows that one task or a broadcast takes them."""
    return df.count() <= FEW


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of
    ``links`` (a, b: long, not NULL). Loops and repeated links are harmless;
    no link gives no row."""
    def together(df):
        return df.coalesce(1) if few else df

    few = is_few(links)
    edges = saved(together(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
                  .distinct(), "links")
    mark = fingerprint(edges)
    while True:
        few = mark[0] <= FEW
        edges = together(edges)
        # Large star: every neighbour above a node is linked to the node's smallest neighbour.
        both = together(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: every neighbour below a node, and the node, to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = together(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(low.select("u", F.col("m").alias("v")))).filter("u <> v").distinct()
        after = saved(small, "links")
        drop_saved(edges)
        edges, before, mark = after, mark, fingerprint(after)
        if mark == before:  # a round that changes nothing leaves stars only
            break
    edges = together(edges)
    return together(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
