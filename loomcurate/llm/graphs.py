"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (u, v), u > v: neighbours move to the least node they share with a centre."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = around.join(least, "u")
    if large:  # larger neighbours of u point to the least of its neighbourhood
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # u and its smaller neighbours all point to the least of them
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str, made: list | None = None) -> DataFrame:
    """(node, component): every node with an edge to another, and the least node of its component.

    Each round shuffles the edges and writes them, until they are stars; a round at least halves long paths, so rounds
    grow with the logarithm of the longest. Hubs are joined to a single row each, so a skewed hub can be split.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    last: list = []
    now, before = stored(now, last), None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before, made_now = state, []
        now = stored(_star(_star(now, large=True), large=False), made_now)
        release(last)
        last = made_now
    if made is not None:
        made += last
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
