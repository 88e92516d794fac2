"""Choosing a broadcast by measured size."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side is held by the driver and by every executor at once.
BROADCAST_BYTES = 64 << 20
_FIXED_WIDTH = 8
# What a row costs in a hash table besides its columns.
_ROW_OVERHEAD = 64
# Input files beyond so many times the bound are not worth measuring: no job is run for them.
_FILES_FACTOR = 8

# Sizes measured lately: (frame, its input files, bytes). A dashboard asks the same small dimensions
# again and again; a table that got other files is another entry.
_REMEMBER_FRAMES = 64
_measured: list[tuple[DataFrame, tuple[str, ...], int]] = []


def _remembered(df: DataFrame, files: tuple[str, ...]) -> int | None:
    del _measured[:-_REMEMBER_FRAMES]
    for known, their_files, size in _measured:
        if files and files == their_files and known.sparkSession is df.sparkSession:
            if known.columns == df.columns and known.sameSemantics(df):
                return size
    return None


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the files below a plan, as the scans report them, without a job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return sum(int(str(size)) for size in sizes)


def _width(name: str, kind: str) -> Column:
    """Bytes of a value; text and nested values by what they hold."""
    column = F.col(f"`{name}`")
    if kind in ("string", "binary"):
        size = F.octet_length(column)
    elif kind.startswith(("array", "struct", "map", "variant")):
        # Numbers in an array take at least the digits they are written with, text its own length.
        size = F.octet_length(F.to_json(F.struct(column))) * 2
    else:
        return F.lit(_FIXED_WIDTH).cast("long")
    return F.coalesce(size, F.lit(0)).cast("long") + _FIXED_WIDTH


def measured_bytes(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of each frame's rows, from one job that aggregates all of them."""
    files = {name: tuple(sorted(df.inputFiles())) for name, df in frames.items()}
    sizes = {name: _remembered(df, files[name]) for name, df in frames.items()}
    sizes = {name: size for name, size in sizes.items() if size is not None}
    frames = {name: df for name, df in frames.items() if name not in sizes}
    measures = []
    for name, df in frames.items():
        size = sum((_width(*column) for column in df.dtypes), F.lit(_ROW_OVERHEAD).cast("long"))
        measures.append(df.agg(F.lit(name).alias("name"), F.sum(size).alias("bytes")))
    rows = reduce(DataFrame.unionByName, measures).collect() if measures else []
    for row in rows:
        sizes[row["name"]] = row["bytes"] or 0
        _measured.append((frames[row["name"]], files[row["name"]], sizes[row["name"]]))
    return sizes


def _worth_measuring(df: DataFrame, max_bytes: int) -> bool:
    return max_bytes > 0 and _input_bytes(df) <= max_bytes * _FILES_FACTOR


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df``, as measured, may be broadcast."""
    return _worth_measuring(df, max_bytes) and measured_bytes({"only": df})["only"] <= max_bytes


def broadcast_if_small(
    frames: Mapping[str, DataFrame], max_bytes: int = BROADCAST_BYTES
) -> dict[str, DataFrame]:
    """Mark the frames whose measured size is within the bound.

    Spark estimates the output of a join by multiplying its inputs, so a small
    dimension built from several tables looks huge and the fact would be
    shuffled to meet it. Frames beyond the bound, and those whose files are far
    beyond it, are left to a shuffle join, where adaptive execution splits
    skewed keys.
    """
    sizes = measured_bytes({n: df for n, df in frames.items() if _worth_measuring(df, max_bytes)})
    return {
        name: F.broadcast(df) if sizes.get(name, max_bytes + 1) <= max_bytes else df
        for name, df in frames.items()
    }
