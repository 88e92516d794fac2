"""Data-quality rules, key checks and their violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from forecourt.operators.joins import fits_broadcast

# A rule set maps a rule name to the SQL condition every good row meets.
Rules = Mapping[str, str]

# The rules of the vehicle master.
VEHICLE_RULES = {
    "sale_above_purchase": "listing_price > purchase_price",
    "year_from_1990": "model_year >= 1990",
    "vin_17": "length(vin) = 17",
}


def _met(condition: str) -> Column:
    """A condition that evaluates to NULL counts as a violation."""
    return F.coalesce(F.expr(condition), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that meet every rule."""
    for condition in rules.values():
        df = df.filter(_met(condition))
    return df


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """The same rows, or a failed job naming the first rule that some row violates."""
    verdict = F.lit(True)
    for name, condition in reversed(list(rules.items())):
        failure = F.raise_error(F.lit(f"expectation {name!r} violated: {condition}"))
        verdict = F.when(_met(condition), verdict).otherwise(failure.cast("boolean"))
    return df.filter(verdict)


def quality_counts(rules: Rules) -> list[Column]:
    """Aggregates ``n`` and ``failed_<rule>``, for one pass or a streaming observation."""
    return [F.count(F.lit(1)).alias("n")] + [
        F.count_if(~_met(condition)).alias(f"failed_{name}") for name, condition in rules.items()
    ]


def observed(df: DataFrame, rules: Rules, observation: Observation | str) -> DataFrame:
    """``df`` unchanged; the counts are collected as a side product of the job that reads it."""
    return df.observe(observation, *quality_counts(rules))


def quality_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: passed and failed row counts, all from a single pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, passed long, failed long")
    counts = df.agg(*quality_counts(rules))
    per_rule = F.array(
        *(
            F.struct(
                F.lit(name).alias("rule"),
                (F.col("n") - F.col(f"failed_{name}")).alias("passed"),
                F.col(f"failed_{name}").alias("failed"),
            )
            for name in rules
        )
    )
    return counts.select(F.inline(per_rule))


def typed(df: DataFrame, types: Mapping[str, str], errors: str = "invalid") -> DataFrame:
    """Cast the named columns; ``errors`` lists those whose text did not fit the type.

    A value that cannot be cast becomes NULL and is listed, a NULL stays NULL
    and is not.
    """
    bad = [
        F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), F.lit(name))
        for name, kind in types.items()
    ]
    # Without the NULLs; unlike array_compact, this leaves the casts in generated code.
    marked = df.withColumn(errors, F.array_except(F.array(*bad), F.array(F.lit(None).cast("string"))))
    return marked.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key under ``order``, which must be total for a stable result.

    Spark keeps one row per key and map task before the shuffle (window group
    limit), so a key holding a large part of all rows does not end in one task.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str | None = None, late="1 day"):
    """Streaming duplicate removal.

    Without ``event_time`` every key stays in state for ever. With it, state is
    dropped once the watermark has passed, and later duplicates are not noticed.
    """
    if event_time is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


def repeated_keys(batch: DataFrame, keys: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Keys that ``batch`` has more than once or that ``stored`` has as well; ``_known`` tells the latter.

    Of a batch that repeats little this is little, and only keys are shuffled for it.
    """
    found = batch.select(*keys, F.lit(1).alias("_n"), F.lit(False).alias("_known"))
    if stored is not None:
        found = found.unionAll(stored.select(*keys, F.lit(0).alias("_n"), F.lit(True).alias("_known")))
    counted = found.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.bool_or("_known").alias("_known"))
    return counted.filter("_n > 1 OR (_n = 1 AND _known)").drop("_n")


def without_repeats(batch: DataFrame, keys: Sequence[str], repeats: DataFrame) -> DataFrame:
    """One row of each key of ``batch`` that is not known, given its ``repeated_keys``.

    Rows whose key does not repeat stay where they lie, as long as the repeated keys fit a broadcast. No key is NULL.
    """
    if repeats.isEmpty():
        return batch
    if fits_broadcast(repeats):
        rest = batch.join(F.broadcast(repeats.filter("NOT _known")), list(keys), "left_semi")
        rows = batch.join(F.broadcast(repeats), list(keys), "left_anti").unionAll(rest.dropDuplicates(list(keys)))
    else:
        rows = batch.join(repeats.filter("_known"), list(keys), "left_anti").dropDuplicates(list(keys))
    return rows.select(*(F.col(f"`{c}`") for c in batch.columns))


def check_pk(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL in some part or occur more than once, with their row count ``n``."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | any_null)


def check_fk(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL child values without a parent row, with the number of child rows ``n``.

    Child rows are counted per value first, so the join moves one row per
    distinct value however often a value repeats.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column)
    counted = values.agg(F.count(F.lit(1)).alias("n")).select(F.col(column).alias("value"), "n")
    return counted.join(parent.select(F.col(key).alias("value")), "value", "left_anti")
