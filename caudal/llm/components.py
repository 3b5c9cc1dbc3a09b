"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import stage

#: Steps are logarithmic in the length of a path; more than this many means a fault.
MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Neighbours of each node linked to the smallest of them and the node.

    Large: all neighbours, of which the larger move.  Small: the smaller neighbours and the node move.
    Minima are pre-aggregated, so a node with very many links costs one row per task.
    """
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if large:
        both = both.union(both.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select("m", "u"))
    return out.where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for every node of the links ``a, b``.

    Each round is written to shared storage, which bounds lineage; nothing but two sums comes to the driver.
    """
    now, before = stage(links.where("a <> b"), "links"), None
    for _ in range(MOST_ROUNDS):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())
        now, before = stage(_star(_star(now, True), False), "links"), mark
    raise RuntimeError("components did not settle")
