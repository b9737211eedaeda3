"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import written


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select("b", "a")).toDF("u", "v")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the smallest node around: the larger ones, or the smaller ones."""
    both = _both(links)
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        tied = (tied.select(F.col("m").alias("a"), F.col("v").alias("b"))
                .union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))))
    return tied.where("a < b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one node only, which hangs on none."""
    zero, one = F.lit(0), F.lit(1)
    ends = links.select(F.col("b").alias("node"), one.alias("below"), zero.alias("above")).union(
        links.select("a", zero, one))
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")
                                    ).where("below > 1 or below + above > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of the nodes of links ``a, b``; the component is its smallest node.

    Every step is two aggregations and joins by node; partial minima keep a node
    with many links out of a single task.  The links stay distributed; the driver
    only hears whether any node is not settled yet.
    """
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a < b").distinct(), "links")
    while not _settled(links):
        links = written(_star(_star(links, large=True), large=False), "links")
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        links.select("a", "a").distinct())
