"""Reading landed files and writing the layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The name prefix of each layer.
LAYERS = {"bronze": "bz", "silver": "sl", "gold": "gd", "view": "mv"}

# How layer tables are compressed: numbers and numbers as text take a quarter less than with Spark's default.
COMPRESSION = "zstd"


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{LAYERS[layer]}_{name}"


def load_master(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A whole-file master table from CSV; text that does not fit its type becomes NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def with_day(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn("day", F.to_date(date_col))


def write_daily(df: DataFrame, date_col: str, path: str) -> None:
    """Append rows as gzipped CSV files below one ``day=`` folder per day.

    The rebalance hint gathers small days into few files and lets adaptive
    execution split a day that holds much of the data.
    """
    landed = with_day(df, date_col).hint("rebalance", F.col("day"))
    writer = landed.write.mode("append").partitionBy("day").option("header", True)
    writer.option("compression", "gzip").csv(path)


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dealt: bool = False,
) -> str:
    """Write a layer table as parquet and return its path.

    With ``partition_by``, ``overwrite`` replaces only the partitions present in
    ``df``, so repeating a write gives the same table. Rows that are ``dealt`` are already gathered by partition.
    """
    path = layer_path(base, layer, name)
    if partition_by and not dealt:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    writer = df.write.mode(mode).partitionBy(*partition_by).option("compression", COMPRESSION)
    writer.option("partitionOverwriteMode", "dynamic" if partition_by else "static").parquet(path)
    return path


# Fixed value: the folder name Spark gives to a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def drop_partitions(
    spark: SparkSession, path: str, partitions: Sequence[Mapping[str, object]]
) -> None:
    """Remove partition folders of a table, through Spark's file system; missing ones are no error.

    Values must be plain in a folder name: dates, numbers, simple text.
    """
    if not partitions:
        return
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for partition in partitions:
        names = (f"{k}={NULL_PARTITION if v is None else v}" for k, v in partition.items())
        files.delete(hadoop("/".join((path.rstrip("/"), *names))), True)
