"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import Scratch, remove, written
from marketlake.session import scratch_path


def _are_stars(edges: DataFrame, nearest: DataFrame) -> bool:
    """Whether every edge (u, v) leads to the smallest neighbour of u, which has no smaller one itself."""
    above = nearest.select(F.col("u").alias("v"), F.col("m").alias("top"))
    return edges.join(nearest, "u").join(above, "v").where("m <> v or top <> v").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node of an edge, the smallest node it reaches.

    Nodes are of any ordered type; loops and null ends are left out; repeated
    edges and either direction are fine. Each step is written to the scratch
    folder, so the plan stays short and a lost executor costs one step; the tables
    of earlier steps are removed. Nothing is collected but one flag per round.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = written(now.distinct(), path)
    while True:
        # Both sides of a join are read from written tables, so both are shuffled for it
        # (or one is broadcast) and a hub's edges can be split over tasks (adaptive skew join).
        with Scratch(spark) as step:
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            nearest = step.written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
            if _are_stars(now, nearest):
                break
            large = step.written(both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
            least = step.written(large.groupBy("u").agg(F.min("v").alias("m")))
            moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            following = scratch_path(spark, "edges")
            now = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), following)
        remove(spark, path)
        path = following
    pointed = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pointed.unionByName(roots)
