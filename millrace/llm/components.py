"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage, unstage


def _least(edges: DataFrame) -> DataFrame:
    """Every (u, v) with the least of u and all its v. The minimum is taken before the shuffle, so a node with many
    links is one row per task; the join back is one that Spark splits where a node has too many rows."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node) of all nodes in ``links`` (a, b of any order, b other than a).

    Large-star and small-star steps in turn: each hangs nodes from the least node around them, until nothing moves.
    Every round is written to the shared folder, so lineage stays short, and takes the place of the one before. No node set
    is gathered anywhere.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  "links")
    print_of = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
    before = None
    while (now := edges.agg(F.count("*"), print_of).first()) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        small = _least(large)
        hung = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        done, edges = edges, stage(hung.where("u <> v").distinct(), "links")
        unstage(done)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
