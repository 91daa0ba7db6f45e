"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import base

MOST_ROUNDS = 100


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours: ``links`` has (u, v), u the node."""
    return links.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least_neighbour(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a link; the component is its least node.

    ``links`` has two long columns. Each round turns every neighbourhood into stars around smaller
    nodes; the number of rounds grows with the logarithm of the nodes. A node with very many links is
    pre-aggregated for its least neighbour and its rows stay spread by the planner's skew handling.
    """
    a, b = links.columns
    now = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    now = base.stage_table(now, "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == mark:
            break
        mark = state
        now = base.stage_table(_small_star(_large_star(now)), "links")
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
