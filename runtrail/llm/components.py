"""Connected components by alternating large stars and small stars.

Every round joins each node to the smallest node near it, so that components shrink to stars in
few rounds. A hub's smallest neighbour is an aggregate that every task computes ahead of the
shuffle, and the join back to the links of the hub is one that adaptive execution splits. Each
round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Joins the larger neighbours of each node to its smallest neighbour, or to the node itself."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    moved = both.join(least, "a").where("b > a").select("b", F.least("a", "low").alias("low"))
    return moved.toDF("a", "b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of them. Links have a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").select("b", "low").union(least.select("a", "low"))
    return moved.toDF("a", "b").where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every linked node that is not its component's smallest one.

    ``links`` has the columns ``a`` and ``b`` in any order; loops and repeats do no harm.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.where("a <> b").distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = written(_small_star(_large_star(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
