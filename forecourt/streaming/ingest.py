"""Incremental ingestion: landed files to bronze, bronze to silver.

Each run takes what has arrived since the last one and stops. The checkpoint
remembers which files were read, so repeating a run adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from forecourt.operators import quality
from forecourt.sources.files import COMPRESSION

# Tasks that list landed folders; Spark's own default is one for each folder.
_LISTING_TASKS = 32
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List many folders in a few tasks: with one folder each, starting the tasks takes longer than listing."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(before), _LISTING_TASKS))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def audited(df: DataFrame) -> DataFrame:
    """Rows with the time they were read and the file they came from."""
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def ingest_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    out: str,
    checkpoint: str,
    max_files: int = 10_000,
) -> None:
    """Append the CSV files that are new under ``source`` to the bronze table ``out``.

    ``source`` may hold any number of files, in ``day=`` folders or matched by a
    glob; at most ``max_files`` go into one micro-batch, and the run continues
    until all are taken. Bronze keeps the text as delivered: give a schema of
    strings and cast on the way to silver.
    """
    with few_listing_tasks(spark):
        stream = (
            spark.readStream.schema(schema)
            .option("header", True)
            .option("maxFilesPerTrigger", max_files)
            .csv(source)
        )
        run = (
            audited(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("compression", COMPRESSION)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()


def ingest_checked(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    out: str,
    quarantine: str,
    checkpoint: str,
    max_files: int = 10_000,
) -> None:
    """Like ``ingest_files``, but lines with too few or too many fields go to ``quarantine`` as they were delivered.

    A quarantined row is the line, its file and the time it was read; what is in bronze and in quarantine adds up to
    what was delivered. Every micro-batch replaces its own ``batch_id=`` folder of both tables, so a batch that is run
    again after a failure is written once. No column of ``schema`` may be called ``_line``.
    """
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with few_listing_tasks(spark):
        stream = (
            spark.readStream.schema(StructType([*parsed.fields, StructField("_line", StringType())]))
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_line")
            .option("maxFilesPerTrigger", max_files)
            .csv(source)
        )

    def store(batch: DataFrame, batch_id: int) -> None:
        def put(rows: DataFrame, path: str) -> None:
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        put(batch.filter("_line IS NULL").drop("_line"), out)
        put(batch.filter("_line IS NOT NULL").select("_line", "_source_file", "_ingested_at"), quarantine)

    with few_listing_tasks(spark):
        writer = audited(stream).writeStream.foreachBatch(store).trigger(availableNow=True)
        writer.option("checkpointLocation", checkpoint).start().awaitTermination()


def refine(
    spark: SparkSession,
    bronze: str,
    out: str,
    metrics_out: str,
    checkpoint: str,
    types: Mapping[str, str],
    rules: quality.Rules,
    keys: Sequence[str],
    event_time: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    fail: quality.Rules | None = None,
    max_files: int = 1_000,
    partition_by: Sequence[str] = (),
) -> None:
    """New bronze rows to silver: cast, drop violating rows and rows without a key, then drop repeats.

    Repeats are looked for among accepted rows only, so a row that was refused
    once is taken when it is delivered again in order. Violations are counted
    by a stream of their own over all rows as delivered. A violation of a
    ``fail`` rule ends the run before the batch is written.

    Every micro-batch, of at most ``max_files`` files, replaces its own
    ``batch_id=`` folder of ``out`` and of ``metrics_out``, so a batch that is
    run again after a failure is not written twice. Without ``event_time`` a
    batch is compared with the keys of all earlier ones as they lie in ``out``;
    no key is held in memory from batch to batch.
    """

    def delivered() -> DataFrame:
        raw = spark.readStream.schema(spark.read.parquet(bronze).schema)
        stream = quality.typed(raw.option("maxFilesPerTrigger", max_files).parquet(bronze), types)
        return stream if prepare is None else prepare(stream)

    def run(stream: DataFrame, store: Callable[[DataFrame, int], None], name: str) -> None:
        writer = stream.writeStream.foreachBatch(store).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{checkpoint}/{name}").start().awaitTermination()

    def earlier(batch: DataFrame, batch_id: int) -> DataFrame | None:
        schema = StructType([*batch.schema.fields, StructField("batch_id", LongType())])
        try:
            return batch.sparkSession.read.schema(schema).parquet(out).filter(F.col("batch_id") < batch_id)
        except AnalysisException:  # nothing has been stored yet
            return None

    def keep(batch: DataFrame, batch_id: int) -> None:
        if event_time is None:
            repeats = quality.repeated_keys(batch, keys, earlier(batch, batch_id))
            repeats.write.mode("overwrite").parquet(f"{checkpoint}/repeats")
            repeats = batch.sparkSession.read.schema(repeats.schema).parquet(f"{checkpoint}/repeats")
            batch = quality.without_repeats(batch, keys, repeats)
        writer = batch.write.mode("overwrite").partitionBy(*partition_by).option("compression", COMPRESSION)
        writer.parquet(f"{out}/batch_id={batch_id}")

    def count(batch: DataFrame, batch_id: int) -> None:
        counted = quality.quality_metrics(batch, rules).coalesce(1)
        counted.write.mode("overwrite").parquet(f"{metrics_out}/batch_id={batch_id}")

    checked = quality.expect_or_fail(delivered(), fail) if fail else delivered()
    accepted = quality.expect_or_drop(checked, rules).dropna(subset=list(keys))
    run(accepted if event_time is None else quality.dedup_stream(accepted, keys, event_time), keep, "rows")
    run(delivered(), count, "metrics")
