"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins on narrow rows, staged in the shared folder, so neither lineage nor any task's state grows with a
component. Rounds grow with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stage, unstage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u, v), either way round -> (node, label): the least node of each component, for nodes with an edge but
    the least ones themselves."""
    e = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        old, e = e, stage(_small_star(_large_star(e)), "cc")
        unstage(old)
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
