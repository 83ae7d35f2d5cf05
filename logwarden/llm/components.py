"""Connected components by alternating stars; every step is an aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest neighbour or itself."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to its smallest neighbour."""
    down = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))  # a > b
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("m").alias("a"), "b")
    return moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of each node of the edges (a, b).

    Edges may repeat, point either way, or join a node to itself; no edges give no rows.
    Each round is written to the checkpoint folder.
    """
    nodes = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    state, mark = common.cut(nodes.where("a < b").distinct()), None
    while True:
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark = now
        state = common.cut(_small_star(_large_star(state)))
    tops = state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return state.select(F.col("b").alias("node"), F.col("a").alias("root")).union(tops)
