"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least of the node and its neighbours."""
    around = _both_ways(links)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie the smaller neighbours of a node, and the node itself, to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the least node reachable, for every node of `links` (columns `u` and `v`, longs).

    Each round is a few joins and sums whose hot nodes adaptive execution can split; no node's neighbours are gathered
    in a row. Rounds are stored, and end when a round changes nothing: then all links are stars around least nodes.
    """
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    state = None
    while True:
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state or found[0] == 0:
            break
        state = tuple(found)
        former, links = links, stored(_small_star(_large_star(links)), "links")
        release(former)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
