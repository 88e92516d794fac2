"""Exact ranks within groups too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str, value: str, pieces: int = 500) -> DataFrame:
    """``df`` with ``rank`` and ``dense_rank`` of ``value`` within ``group``, highest first.

    A window over the group would sort all of it in one task. Here equal values
    are counted first, each group is cut at approximate quantiles of its values,
    and a value's rank is what the pieces above it hold plus its place in its
    own piece. The cuts only decide how evenly the work is spread, never the
    ranks. Rows with NULL in either column are left out.
    """
    known = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    counted = known.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    at = [i / pieces for i in range(1, pieces)]
    cuts = counted.groupBy(group).agg(F.percentile_approx(value, at, 10 * pieces).alias("_cuts"))
    above = F.size(F.filter("_cuts", lambda cut: cut > F.col(value)))
    placed = counted.join(cuts, group).withColumn("_piece", above).drop("_cuts")

    earlier = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    held = placed.groupBy(group, "_piece").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values")
    )
    held = held.select(
        group,
        "_piece",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_values_above"),
    )
    inside = Window.partitionBy(group, "_piece").orderBy(F.desc(value))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranks = placed.join(held, [group, "_piece"]).select(
        group,
        value,
        (F.col("_rows_above") + F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1)
        .cast("int")
        .alias("rank"),
        (F.col("_values_above") + F.row_number().over(inside)).cast("int").alias("dense_rank"),
    )
    return known.join(ranks, [group, value])
