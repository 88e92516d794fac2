"""Incremental refresh of monthly marts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.gold import month_of, ratio
from forecourt.sources.files import NULL_PARTITION, drop_partitions, layer_path, write_layer

# So many months are passed to the scan as a list; beyond, a semi join selects them.
LISTED_MONTHS = 1200

Mart = Callable[[DataFrame], DataFrame]


def _months(rows: DataFrame) -> set:
    return {row[0] for row in rows.select(F.col("sales_month").cast("date")).distinct().collect()}


def stored_rows(spark: SparkSession, path: str, folders: str | list[str]) -> DataFrame:
    """The rows below some folders of a table; no other folder is listed."""
    below = [f"{path}/{f}" for f in ([folders] if isinstance(folders, str) else folders)]
    rows = spark.read.option("basePath", path).parquet(*below)
    return rows.withColumns({"sales_month": F.col("sales_month").cast("date"), "batch": F.col("batch").cast("string")})


def month_folder(month: object) -> str:
    return f"sales_month={NULL_PARTITION if month is None else month}"


def stored_months(
    spark: SparkSession, base: str, batch: str, name: str = "contracts", load: str | None = None
) -> set:
    """The months a batch, or one load of it, has rows in; none if it was never loaded."""
    try:
        stored = stored_rows(spark, layer_path(base, "silver", name), f"sales_month=*/batch={batch}")
    except AnalysisException:  # the batch has never been loaded
        return set()
    return _months(stored if load is None else stored.filter(F.col("load") == load))


def add_batch(
    rows: DataFrame,
    base: str,
    batch: str,
    date: str = "contract_date",
    name: str = "contracts",
    dealt: bool = False,
) -> tuple[str, set, set]:
    """Store one load by month; returns the load's mark, the months it has and the batch's other months.

    The months that an earlier load of the batch had and this one lacks are left for the caller to
    remove, after it has dealt with them: until then a repeated run finds them again.
    Months come first in the layout, so a refresh reads its months' folders only; ``batch`` must be plain in a
    folder name (letters, digits, ``_``, ``-``, ``.``), as it is part of the path. Rows that are ``dealt`` are already
    gathered by month.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"not a plain batch name: {batch!r}")
    spark, load = rows.sparkSession, uuid.uuid4().hex
    before = stored_months(spark, base, batch, name)
    # The marks are the same in all rows, so they are put on after the shuffle by month.
    dated = rows.withColumn("sales_month", month_of(date))
    if not dealt:
        dated = dated.hint("rebalance", "sales_month")
    stamped = dated.withColumns({"load": F.lit(load), "batch": F.lit(batch)})
    write_layer(stamped, base, "silver", name, ("sales_month", "batch"), dealt=True)
    now = stored_months(spark, base, batch, name, load)
    return load, now, before - now


def monthly_summary(contracts: DataFrame) -> DataFrame:
    """The summary itself. Distinct customers cannot be added up, hence whole months."""
    return (
        contracts.groupBy("sales_month")
        .agg(
            F.count(F.lit(1)).alias("units"),
            F.sum("actual_price").alias("sales"),
            F.sum("gross_profit").alias("gross_profit"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .withColumn("margin_rate", ratio("gross_profit", "sales"))
    )


def store_summary(contracts: DataFrame) -> DataFrame:
    """Units, sales and gross profit by store and month."""
    return contracts.groupBy("store_id", "sales_month").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("actual_price").alias("sales"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def rows_of_months(contracts: DataFrame, months: set) -> DataFrame:
    """The rows of the given months.

    A literal list prunes the partitions of other months from the scan.
    """
    known = [m for m in months if m is not None]
    if len(known) > LISTED_MONTHS:
        wanted = contracts.sparkSession.createDataFrame([(m,) for m in months], "_month date")
        return contracts.join(wanted, F.col("sales_month").eqNullSafe(F.col("_month")), "left_semi")
    listed = F.col("sales_month").isin(known) if known else F.lit(False)
    return contracts.filter(listed | F.col("sales_month").isNull() if None in months else listed)


def refresh_incremental(
    spark: SparkSession,
    delta: DataFrame,
    base: str,
    batch: str,
    mart: Mart = monthly_summary,
    name: str = "monthly_sales",
    date: str = "contract_date",
    dealt: bool = False,
) -> str:
    """Store ``delta`` as ``batch`` and recompute only the months of ``mart`` that it touches.

    ``mart`` gets rows with their ``sales_month`` and must keep that column. A
    month that no row is left in disappears from the mart. A delta that is
    ``dealt`` is already gathered by month.
    """
    load, months, gone = add_batch(delta, base, batch, date, dealt=dealt)
    path = layer_path(base, "silver", "contracts")
    stale = (F.col("batch") == batch) & (F.col("load") != load)
    touched = months | gone
    if not touched:  # an empty load of a batch that had no rows
        return layer_path(base, "view", name)
    # Beyond so many months the whole table is listed once, which is cheaper than that many paths.
    some = [month_folder(m) for m in touched] if len(touched) <= LISTED_MONTHS else ""
    rows = rows_of_months(stored_rows(spark, path, some).filter(~stale), touched).drop("load")
    view = write_layer(mart(rows), base, "view", name, ("sales_month",))
    empty = gone - _months(rows) if gone else set()
    drop_partitions(spark, view, [{"sales_month": month} for month in empty])
    drop_partitions(spark, path, [{"sales_month": month, "batch": batch} for month in gone])
    return view


def summary_path(base: str) -> str:
    return layer_path(base, "view", "monthly_sales")
