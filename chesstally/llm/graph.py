"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are joins and grouped minima over the edge table, so no component is ever collected
in one place. Every round is written to the shared folder (see ``materialize``): the plan stays
short, and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import materialize


def _symmetric(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node around it."""
    both = _symmetric(edges)
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return (others.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(node, component)``; the component is its smallest node. Self loops and
    repeated edges are allowed; nodes without an edge to another node do not appear. An empty
    table gives an empty result."""
    edges = materialize(edges.select("u", "v").where("u != v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        last, state = state, _state(edges)
        if state == last:  # a forest of stars: every node hangs on its component's least node
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
