"""Connected components as Spark joins: alternating star contraction.

Every round replaces the links by fewer, flatter ones: each node's larger
neighbours are tied to its smallest neighbour, then each node's smaller ones
are. It ends when a round changes nothing, after a few rounds (logarithmic in
the size of the largest component). Only counts reach the driver; every round
is written to the shared checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import stored


def _tie_to_smallest(pairs: DataFrame) -> DataFrame:
    """Pairs (node, other) -> (other, smallest of node and its others). The
    minimum is aggregated map-side; a hot node's rows are split by the
    adaptive skew join, since only the one-row side is keyed uniquely."""
    least = (pairs.groupBy("node").agg(F.min("other").alias("least"))
                  .select("node", F.least("least", "node").alias("least")))
    return pairs.join(least, "node")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return (_tie_to_smallest(both).filter(F.col("other") > F.col("node"))
            .select(F.col("other").alias("a"), F.col("least").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    tied = _tie_to_smallest(down)
    return (tied.select(F.col("other").alias("a"), F.col("least").alias("b"))
            .union(tied.select(F.col("node").alias("a"), F.col("least").alias("b")))
            .filter(F.col("a") != F.col("b")).distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): one row per node that has a link to
    another node, ``component`` the smallest node reachable.

    ``a`` and ``b`` share one orderable type. Links with a null end and links
    of a node to itself are ignored; repeated links count once; an empty table
    gives an empty result.
    """
    a, b = links.columns
    now = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                 .filter(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _state(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "links")
        state = _state(now)
        if state == seen:
            break
        seen = state
    # Now a star: every node is tied to its component's smallest node.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
