"""Connected components of an edge table by alternating large-star and
small-star steps (MapReduce form): only edges move, every step is a min
aggregate (combined on the map side) and an equi-join whose hot keys AQE can
split, and each step is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm.common import stage


def _spread_min(pairs: DataFrame, with_self: bool) -> DataFrame:
    """pairs (u, v) with the least neighbour m of each u. The minima go
    through a stage table, so both join inputs are plain exchanges."""
    low = F.least(F.min("v"), F.col("u")) if with_self else F.min("v")
    return pairs.join(stage(pairs.groupBy("u").agg(low.alias("m")), "cc-min"), "u")


def _ordered(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, without loops or repeats."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one integer
    type): root is the least node reachable. Loops and repeats are allowed."""
    now = stage(_ordered(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "cc-edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _spread_min(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(_ordered(large), "cc-large")
        small = _spread_min(large, False)
        hooked = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v")))
        now = stage(_ordered(hooked), "cc-small")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct())
