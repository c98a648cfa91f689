"""Connected components of an edge table by alternating star steps, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import settle

MOST_ROUNDS = 40


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """u, v: every node of ``edges`` (long columns u, v) but the smallest of its component, and that smallest node."""
    edges = settle(_small_star(edges), "stars")
    before = None
    for _ in range(MOST_ROUNDS):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        before = state
        edges = settle(_small_star(_large_star(edges)), "stars")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
