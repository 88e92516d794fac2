"""Landed files to bronze, silver and gold in one run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from forecourt.operators.quality import Rules
from forecourt.sources.files import layer_path, write_layer
from forecourt.streaming.ingest import ingest_files, refine


@dataclass(frozen=True)
class Feed:
    """One landed feed: its raw columns, target types, key, rules that drop rows and rules that end the run."""

    name: str
    raw_schema: str
    types: Mapping[str, str]
    keys: Sequence[str]
    rules: Rules = field(default_factory=dict)
    event_time: str | None = None
    fail: Rules = field(default_factory=dict)


def run_medallion(
    spark: SparkSession,
    landing: str,
    base: str,
    feed: Feed,
    marts: Mapping[str, Callable[[DataFrame], DataFrame]],
) -> dict[str, str]:
    """Take what has newly landed through all layers; returns the path of every table.

    The gold marts are recomputed from silver; large ones use
    ``operators.refresh`` instead.
    """
    bronze = layer_path(base, "bronze", feed.name)
    clean = layer_path(base, "silver", feed.name)
    metrics = layer_path(base, "silver", f"{feed.name}_quality")
    checkpoints = f"{base}/_checkpoints"
    ingest_files(spark, landing, feed.raw_schema, bronze, f"{checkpoints}/{feed.name}_bronze")
    refine(
        spark,
        bronze,
        clean,
        metrics,
        f"{checkpoints}/{feed.name}_silver",
        feed.types,
        feed.rules,
        feed.keys,
        feed.event_time,
        fail=feed.fail,
    )
    silver = spark.read.parquet(clean).drop("batch_id")
    paths = {"bronze": bronze, "silver": clean, "quality": metrics}
    for name, mart in marts.items():
        paths[name] = write_layer(mart(silver), base, "gold", name)
    return paths
