"""Connected components by alternating large-star and small-star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import cut

ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node that can be reached.

    Large-star links a node's greater neighbours to the least of its
    neighbourhood, small-star its lesser ones; the two end in stars. Minima are
    aggregated before they are shuffled and joined back one row a node, so a node
    with any number of edges is split by the join.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v").distinct())
    state = _state(now)
    for _ in range(ROUNDS):
        now = cut(_small_star(_large_star(now)))
        then, state = state, _state(now)
        if then == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    return both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).filter("u <> v").unionByName(
        least.filter("m <> x").select(F.col("x").alias("v"), F.col("m").alias("u"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    linked = edges.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u <> v")
    return linked.unionByName(least.select("v", F.col("m").alias("u"))).distinct()
