"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.llm.common import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst: long); root is the smallest node it can reach.

    Alternating large and small stars: every round ties each node's neighbours to the smallest of them,
    first the larger neighbours, then the smaller ones, until only stars are left.  The rounds
    grow with the logarithm of the longest chain.  A hub's neighbours are never gathered: a minimum by
    key, combined before the shuffle, goes back by a join whose skewed partitions Spark can split.
    Self links and repeated links don't matter; an empty graph gives no rows.
    """
    now = stored(_ordered(edges.select("src", "dst")), label)
    mark = _mark(now)
    while True:
        now = stored(_small_star(_large_star(now)), label)
        after = _mark(now)
        if after == mark:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
                now.select("dst", "dst").distinct()
            )
        mark = after


def _ordered(edges: DataFrame) -> DataFrame:
    pair = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    return pair.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("low"))
    least = least.select("src", F.least("src", "low").alias("low"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # each edge points from the larger node to the smaller one already
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())
