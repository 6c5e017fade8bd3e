"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components
in MapReduce and Beyond", 2014): each step hangs a vertex's neighbours on the
smallest one, and the number of rounds grows with the logarithm of the graph's
diameter rather than with the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.plans.checks import require_columns
from textloom.plans.lineage import discard, durable
from textloom.plans.skew import lookup_join

MAX_ROUNDS = 60


def _large_star(edges: DataFrame, heavy_floor: int | None) -> DataFrame:
    """Hang every larger neighbour of a vertex on the smallest id around it."""
    up = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))      # v > u
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))    # v < u
    smallest = (
        up.withColumn("up", F.lit(1)).unionByName(down.withColumn("up", F.lit(0)))
        .groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.sum("up").alias("w"))
        .where("w > 0")
    )
    return lookup_join(up, smallest, ["u"], "w", heavy_floor=heavy_floor).select(
        F.col("v").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame, heavy_floor: int | None) -> DataFrame:
    """Hang a vertex and its smaller neighbours on the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("w"))
    moved = lookup_join(edges, smallest, ["a"], "w", heavy_floor=heavy_floor)
    return (
        moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(smallest.select("a", F.col("m").alias("b")))
    )


def _settled(edges: DataFrame) -> bool:
    """True once every vertex hangs on one centre and no centre hangs on anything."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    seen = ends.groupBy("v").agg(F.sum("hangs").alias("n"), F.max("holds").alias("c"))
    return seen.where("n > 1 or (n = 1 and c = 1)").isEmpty()


def components(
    edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = MAX_ROUNDS, heavy_floor: int | None = None
) -> DataFrame:
    """``(id, cluster)`` for every vertex of ``edges``; the cluster is its smallest id.

    Of the rounds' tables only the last one stays.  More than ``max_rounds`` rounds, far
    beyond the logarithm of any graph, raise an error.
    """
    require_columns(edges, a, b)
    clean = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now = durable(clean.distinct(), "edges")
    rounds = 0
    while not _settled(now):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        stars = durable(_large_star(now, heavy_floor).distinct(), "large-star")
        before, now = now, durable(_small_star(stars, heavy_floor).distinct(), "small-star")
        discard(before, stars)
        rounds += 1
    members = now.select(F.col("a").alias("id"), F.col("b").alias("cluster"))
    centres = now.select(F.col("b").alias("id"), F.col("b").alias("cluster")).distinct()
    return members.unionByName(centres)
