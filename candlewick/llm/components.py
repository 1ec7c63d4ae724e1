"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    """Links (a, b) with the least of a and its partners b."""
    least = links.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return links.join(least, "a")


def _round(links: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step; in and out a > b."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    small = _least(large)
    return (
        small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        .where("a > b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that can be reached, for nodes with a link.

    ``links`` has two columns of long ids, in any order and with repeats.
    Alternating stars: each round links every node to smaller ones, until a
    round changes nothing; the number of rounds grows with the logarithm of
    the longest path. Only a count and a checksum reach the driver.
    """
    x, y = links.columns
    now = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where("a > b").distinct()
    now, before = stored(now, "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == before:
            break
        now, before = stored(_round(now), "links"), mark
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
