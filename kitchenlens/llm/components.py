"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_stage


def _state(df: DataFrame):
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long; each an undirected link) → (node, root): root is the smallest node reachable.

    Only nodes that have a link to another node come back.  Every round is a grouped minimum
    and a join on distributed tables and is written to the checkpoint folder, so neither links
    nor components reach the driver and a lost executor repeats one round at most.  Self links,
    repeated links and links with a null end are left out; no links give no rows.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), ((F.col("a") != F.col("b"))).alias("ok"))
        .where("ok").select("a", "b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        # large star: every larger neighbour of a node goes to the smallest node around it
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # small star: every smaller-or-equal neighbour and the node itself go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        done, edges = edges, cut_lineage(small, "star")
        drop_stage(done)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
