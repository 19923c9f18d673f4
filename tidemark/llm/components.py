"""Connected components of links by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_work_path, written


#: Nodes with more links than this are told their smallest neighbour by a broadcast, of
#: which there are at most ``HUBS``.
LINKS, HUBS = 100, 100_000


def _stars(links: DataFrame, large: bool, count: int) -> DataFrame:
    """One operation over ``count`` links (a, b) with a > b, given and returned.

    Large star: each node's larger neighbours go to its smallest neighbour. Small star:
    its smaller ones and itself do. Only smallest neighbours are gathered, and the links of
    a node with many of them stay where they are, so no task gets all of these.
    """
    around = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        around = around.unionAll(links.select(F.col("b"), F.col("a")))
    least = around.groupBy("node").agg(F.min("other").alias("least"), F.count("*").alias("links")).select(
        F.col("node").alias("centre"), F.least("node", "least").alias("least"), "links"
    )
    # Links have two ends, so at most HUBS nodes have more than this.
    many = max(LINKS, 2 * count // HUBS)
    hubs = F.broadcast(least.where(F.col("links") > many))
    same = F.col("node") == F.col("centre")
    of_hubs = around.join(hubs, same)
    of_others = around.join(hubs, same, "left_anti").join(least.where(F.col("links") <= many), same)
    joined = of_hubs.unionAll(of_others)
    moved = joined.where(F.col("other") > F.col("node") if large else F.col("other") != F.col("least")).select(
        F.col("other").alias("a"), F.col("least").alias("b")
    )
    if not large:
        moved = moved.unionAll(least.select(F.col("centre"), F.col("least")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (columns a, b): its smallest reachable
    node, for all nodes but those smallest ones.

    Each round is written to the work folder and read again; rounds grow with the
    logarithm of the longest path. No links give no rows; loops and repeats do not matter.
    """
    spark = links.sparkSession

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(ordered.distinct(), new_work_path(spark, "links"))
    before, at = None, state(now)
    while at != before and at[0]:
        # No operation makes more links than twice those it is given.
        larger = _stars(now, large=True, count=at[0])
        now = written(_stars(larger, large=False, count=2 * at[0]), new_work_path(spark, "links"))
        before, at = at, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
