"""Connected components of a link table that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``v`` (links, any order, repeats allowed) to ``node``, ``root``: the smallest node reachable.

    Large-star and small-star steps in turn: every node's larger neighbours move to its smallest
    neighbour, then the smaller ones.  Both are a pre-aggregated minimum and an equi-join, so a
    node with very many links is no bottleneck.  Each round is written to the shared folder.
    Nodes without a link to another node do not appear.
    """
    order = F.when(F.col("u") < F.col("v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))).otherwise(F.struct("u", "v"))
    edges = materialise(edges.where("u <> v").select(order.alias("e")).select("e.u", "e.v").distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = materialise(small.distinct(), "links")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
