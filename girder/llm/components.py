"""Connected components by alternating large-star and small-star steps.

Every step is a grouped aggregate and a join on the edges, so no component is ever gathered in one
task; the number of rounds grows with the logarithm of the longest path. Each round's edges are a
written table, so a lost executor costs one round at most; a round's table goes when the next is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girder.llm.common import deleted, split_join, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours. A node that is in very
    many of the ``total`` edges is dealt among tasks."""
    around = _both(edges)
    low = around.groupBy("a").agg(
        F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("count")
    )
    joined = split_join(around.filter("b > a"), low, ["a"], "inner", total)
    return joined.select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("count"))
    joined = split_join(down, low, ["u"], "inner", total)
    linked = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b")
    return linked.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def _measure(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).collect()[0]
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge (a, b).

    Loops and null ends are ignored. A graph that isn't settled after ``max_rounds`` is an error,
    never a partial result.
    """
    clean = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    now = written(clean, "edges")
    before = _measure(now)
    for _ in range(max_rounds):
        old, now = now, written(_small_star(_large_star(now, before[0]), before[0]), "edges")
        deleted(old)
        after = _measure(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    tails = now.groupBy("b").agg(F.min("a").alias("component"))
    roots = now.select(F.col("a").alias("node")).distinct()
    found = tails.select(F.col("b").alias("node"), "component")
    return found.unionByName(
        roots.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    )
