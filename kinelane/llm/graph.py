"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.llm.common import stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """Per node the smallest of it and its neighbours; only partial minima are shuffled."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    # Written out, so that the join deals a node with many neighbours anew and can split it.
    linked = both.join(stored(_least_neighbour(both)), "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(_least_neighbour(down))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each node of ``edges`` (u, v): the smallest id it can reach.

    Loops and repeated edges are ignored; no edges give no rows. Each turn writes its
    edges to the shared folder, so a lost executor costs at most one turn. The number
    of turns follows the logarithm of the longest path, not the number of nodes.
    """
    loose = F.col("u") != F.col("v")
    now = stored(edges.select("u", "v").where(loose).distinct())
    mark = None
    while True:
        tally = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if tally[0] == 0 or tally == mark:
            break
        mark = tally
        now = stored(_small_star(_large_star(now)).where(loose).distinct())
    nodes = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
