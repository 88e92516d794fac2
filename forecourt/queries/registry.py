"""Named queries over the test tables, each with the plain SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.sources.bindings import LogicalTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TODAY = "DATE '2001-08-01'"  # AS_OF as a SQL literal


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, tables)`` under ``name``; ``sql`` is its independent counterpart."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Months and days are cut in UTC, whatever zone the cluster runs in.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, LogicalTables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: Mapping[str, int]) -> DataFrame:
    """Round the named columns, so that summation order cannot show in a comparison."""
    return df.withColumns({name: F.round(f"`{name}`", n) for name, n in places.items()})
