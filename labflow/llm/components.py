"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a partial aggregation (the least neighbour) and a join; Spark splits the join's skewed partitions, so a
node with very many neighbours is no single task's load.  Steps are staged, and their number grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _least(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, after one step."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    if large:
        both = edges.unionByName(turned)
        moved = both.join(_least(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = _least(both).filter("m < u").select("u", F.col("m").alias("v"))
        return moved.unionByName(own).filter("u != v").distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node that each node of ``edges`` (u, v) reaches.  Nodes are 64-bit integers."""
    now = stage(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stage(_star(_star(now, True), False), "edges")
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
