"""Connected components of a graph given by its edges, by alternating star operations.

Large-star joins every larger neighbour of a node to the smallest node of its neighbourhood, small-star the smaller ones;
repeated, every component becomes a star around its smallest node. The number of rounds grows with the logarithm of the
graph's size, not with a chain's length. Edges live in written tables; the driver sees two sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import written


def _star(pairs: DataFrame) -> DataFrame:
    """Each ``v`` joined to the smallest node beside its ``u``, and ``u`` as well."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _sums(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``u``, ``v``) that is not the smallest."""
    edges = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = _sums(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large-star: only larger neighbours move; the smallest may be smaller than the node itself.
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small-star: edges point from the larger to the smaller node.
        edges = written(_star(large), "edges")
        after = _sums(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
