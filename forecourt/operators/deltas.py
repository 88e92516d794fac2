"""Monthly marts kept up by signed deltas: what a load adds, less what the same batch had added before.

The state of a mart is stored by month at the grain of its keys and of the columns whose distinct values it counts: rows,
and per sum its total and the number of amounts in it. A batch's own contribution is stored at the same grain. A load
therefore reads its rows, the batch's last contribution and the state of the months that either touches; neither the
rows nor the contributions of other batches are read, and a distinct value goes when the last row with it goes.

Totals are decimals of ``scale`` places, so that adding and taking away leaves no trace: amounts count as rounded to them.
Sums without any amount are NULL, as in SQL. Rows without a date make a month of their own, NULL.

A load is written to a log before the state changes, and every month of the state names the last load that it holds. A run that
was broken off is finished by the next one, whatever batch that brings, and no month takes a load twice.
One load of a mart runs at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.gold import month_of
from forecourt.operators.refresh import month_folder
from forecourt.sources.files import drop_partitions, layer_path, write_layer


@dataclass(frozen=True)
class SignedMart:
    """``keys`` beside the month, the row count's name, sums and distinct counts by name, and what follows from them."""

    name: str
    keys: tuple[str, ...] = ()
    count: str = "units"
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    finish: Callable[[DataFrame], DataFrame] = lambda mart: mart
    scale: int = 4

    @property
    def grain(self) -> list[str]:
        return ["sales_month", *dict.fromkeys([*self.keys, *self.distinct.values()])]

    def path(self, base: str, part: str) -> str:
        return f"{layer_path(base, 'view', self.name)}_{part}"


def contribution(rows: DataFrame, mart: SignedMart, date: str) -> DataFrame:
    """Rows, totals and numbers of amounts at the grain of the state."""
    amounts = {name: F.col(column).cast(f"decimal(28,{mart.scale})") for name, column in mart.sums.items()}
    totals = [F.sum(amount).cast(f"decimal(38,{mart.scale})").alias(f"sum_{name}") for name, amount in amounts.items()]
    numbers = [F.count(amount).alias(f"n_{name}") for name, amount in amounts.items()]
    return rows.withColumn("sales_month", month_of(date)).groupBy(*mart.grain).agg(F.count(F.lit(1)).alias("n"), *totals, *numbers)


def _signed(rows: DataFrame, mart: SignedMart, sign: int) -> DataFrame:
    totals = [(F.coalesce(F.col(f"sum_{s}"), F.lit(0)) * sign).cast(f"decimal(38,{mart.scale})").alias(f"sum_{s}") for s in mart.sums]
    numbers = [(F.col(c) * sign).alias(c) for c in ("n", *(f"n_{s}" for s in mart.sums))]
    return rows.select(*mart.grain, *totals, *numbers)


def _added(rows: DataFrame, mart: SignedMart) -> DataFrame:
    """Signed rows added up; what nothing is left of goes."""
    totals = [F.sum(f"sum_{s}").cast(f"decimal(38,{mart.scale})").alias(f"sum_{s}") for s in mart.sums]
    numbers = [F.sum(c).alias(c) for c in ("n", *(f"n_{s}" for s in mart.sums))]
    return rows.groupBy(*mart.grain).agg(*totals, *numbers).filter("n > 0")


def mart_rows(state: DataFrame, mart: SignedMart) -> DataFrame:
    """The mart itself from its state."""
    sums = [F.when(F.sum(f"n_{s}") > 0, F.sum(f"sum_{s}")).cast("double").alias(s) for s in mart.sums]
    distinct = [F.count_distinct(column).alias(name) for name, column in mart.distinct.items()]
    return mart.finish(state.groupBy(*mart.keys, "sales_month").agg(F.sum("n").alias(mart.count), *sums, *distinct))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing was ever stored there
        return None


def stored_state(spark: SparkSession, base: str, mart: SignedMart, months: set) -> DataFrame | None:
    """The state of some months, with the ``load`` each holds last; files of other months are not listed."""
    path, folders = mart.path(base, "state"), ",".join(month_folder(m) for m in sorted(months, key=str))
    try:
        state = spark.read.option("basePath", path).parquet(f"{path}/{{{folders}}}")
    except AnalysisException:  # none of them is stored
        return None
    return state.withColumn("sales_month", F.col("sales_month").cast("date"))


def _months(rows: DataFrame | None) -> set:
    return set() if rows is None else {row[0] for row in rows.select("sales_month").distinct().collect()}


def _mark(spark: SparkSession, base: str, mart: SignedMart, batch: str | None, load: str | None) -> None:
    marked = spark.createDataFrame([(batch, load)], "batch string, load string").coalesce(1)
    marked.write.mode("overwrite").parquet(mart.path(base, "pending"))


def finish_pending(spark: SparkSession, base: str, mart: SignedMart) -> None:
    """Bring the logged load, if there is one, into the state, the mart and the batch's contribution."""
    pending = _stored(spark, mart.path(base, "pending"))
    marked = pending.first() if pending is not None else None
    if marked is None or marked.load is None:
        return
    logged, own = f"{mart.path(base, 'log')}/{marked.load}", f"{mart.path(base, 'batches')}/{marked.batch}"
    after, before = _stored(spark, logged), _stored(spark, own)
    months = _months(after) | _months(before)
    held = stored_state(spark, base, mart, months)
    done = _months(held.filter(F.col("load") == marked.load)) if held is not None else set()
    todo = months - done
    if todo:
        parts = [_signed(after, mart, 1)]
        if before is not None:
            parts.append(_signed(before, mart, -1))
        if held is not None:
            parts.append(_signed(held, mart, 1))
        signed = parts[0]
        for part in parts[1:]:
            signed = signed.unionByName(part)
        wanted = F.col("sales_month").isin([m for m in todo if m is not None])
        if None in todo:
            wanted = F.coalesce(wanted, F.lit(True))
        new = _added(signed.filter(wanted), mart).withColumn("load", F.lit(marked.load))
        # Dynamic overwriting stages the new months before it replaces those that are being read.
        state = write_layer(new, base, "view", f"{mart.name}_state", ("sales_month",))
        held = stored_state(spark, base, mart, todo)
        kept = _months(held.filter(F.col("load") == marked.load)) if held is not None else set()
        drop_partitions(spark, state, [{"sales_month": m} for m in todo - kept])
    current = stored_state(spark, base, mart, months)
    view = layer_path(base, "view", mart.name)
    if current is not None:
        write_layer(mart_rows(current, mart), base, "view", mart.name, ("sales_month",))
    drop_partitions(spark, view, [{"sales_month": m} for m in months - _months(current)])
    after.write.mode("overwrite").parquet(own)
    _mark(spark, base, mart, None, None)


def apply_load(
    spark: SparkSession, delta: DataFrame, base: str, batch: str, mart: SignedMart, date: str = "contract_date"
) -> str:
    """Take ``delta`` as the rows of ``batch``, in place of those it had before; returns the mart's path.

    ``batch`` must be plain in a folder name. An empty delta takes the batch out again.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"not a plain batch name: {batch!r}")
    finish_pending(spark, base, mart)
    load = uuid.uuid4().hex
    contribution(delta, mart, date).write.parquet(f"{mart.path(base, 'log')}/{load}")
    _mark(spark, base, mart, batch, load)
    finish_pending(spark, base, mart)
    return layer_path(base, "view", mart.name)
