"""Connected components of links by alternating star contraction, and pairs of bounded blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import settle


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step and one small-star step; edges (u, v) with u > v, v = u at a lone centre."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(
        F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
    return small.select("e.u", F.col("e.m").alias("v")).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that edges (a, b) touch; component is its smallest node.

    The steps move only edges, never members of a component as a list; each ends as a table in the
    shared folder, so lineage stays short and a lost executor costs one step.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if row["n"] == 0 or (row["n"], row["s"]) == mark:
            break
        mark = (row["n"], row["s"])
        now = settle(_stars(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())
