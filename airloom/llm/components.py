"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.session import materialize


def _stars(pairs: DataFrame) -> bool:
    """Whether every id points to one root and no root points on."""
    ends = pairs.select(F.col("x").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        pairs.select("y", F.lit(0), F.lit(1)))
    ends = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): every id of ``edges`` with the smallest id it can reach; edges in any order.

    The edges end as stars around the roots. A step hooks the neighbours of an id to the smallest among them; a hot id is never gathered,
    as only its minimum is. Every step is stored, so a lost executor repeats one step at most. The
    steps are logarithmic in the size of the largest component.
    """
    pairs = materialize(
        edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct())
    while not _stars(pairs):
        # Large star: neighbours above an id go to the smallest neighbour.
        both = pairs.union(pairs.select("y", "x"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        # Small star: neighbours below an id, and the id, go to the smallest of them.
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        hooked = large.join(low, "x")
        small = hooked.select(F.col("y").alias("x"), F.col("m").alias("y")).union(low.select("x", F.col("m").alias("y")))
        pairs = materialize(small.filter("x <> y").distinct())
    return pairs.select(F.col("x").alias("id"), F.col("y").alias("root")).union(
        pairs.select(F.col("y").alias("id"), F.col("y").alias("root")).distinct())
