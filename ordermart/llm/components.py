"""Connected components over links, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.frames import Scratch


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours under a node's smallest neighbour: the larger ones, or the smaller ones with the node."""
    around = _both_ways(links) if large else links
    lowest = around.groupBy("u").agg(F.min("v").alias("lowest")).select("u", F.least("u", "lowest").alias("lowest"))
    each = around.join(lowest, "u")
    if large:
        out = each.where("v > u").select(F.col("v").alias("u"), F.col("lowest").alias("v"))
    else:
        out = each.select(F.col("v").alias("u"), F.col("lowest").alias("v")).union(
            lowest.select("u", F.col("lowest").alias("v"))
        )
    return out.where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    """Count and an order-free sum that tell whether a round has changed anything."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) with u > v, both long, to (node, root): root is the smallest node of the component.

    Nodes without a link are not in the result. Each round ends in a written table. A node with many links is
    reduced before the shuffle, and its links get its minimum through a join that can be split.
    """
    links = scratch.write(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while state[0]:
        large = scratch.write(_star(links, True), "large")
        after = scratch.write(_star(large, False), "small")
        scratch.drop(links, large)
        links, before = after, state
        state = _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct()
    )
