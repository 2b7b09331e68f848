"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """The least of ``u`` and its neighbours ``v``; written, so that the join
    with the pairs meets a plain exchange and skewed nodes can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_v"))
    return cut(least.select("u", F.least("u", "_v").alias("m")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
                        .alias("p")).select("p.u", "p.v")
    return (both.join(_least_neighbour(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_least_neighbour(down), "u")
    return (joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                            F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v").where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v; longs, not null), root
    the least node reachable. Both steps are per-node minima and joins: no
    component is gathered anywhere. Rounds grow with the logarithm of the
    longest path."""
    state = cut(links.where("u <> v").distinct())
    mark = None
    while True:
        total = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == mark or total[0] == 0:
            break
        mark = tuple(total)
        state = cut(_small_star(cut(_large_star(state))))
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
