"""Connected components over an edge table, by alternating large and small stars.

Every round is two aggregations and joins on the edges that are left; nothing
but two numbers per round comes to the driver.  The edges of a round are
written to the shared checkpoint folder, so a lost executor costs one round
at most.  Minima are combined before each shuffle and the joins back are split
by AQE, so a node with very many neighbours doesn't land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siniestro.session import materialize

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without an edge are not listed.

    ``edges`` has two long columns ``u`` and ``v``; loops, repeats and nulls are ignored.
    """
    now = materialize(edges.dropna().filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        now = materialize(_small_star(_large_star(now)), "components")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
