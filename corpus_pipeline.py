"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it again, so that a lost executor never costs more than a stage. All stages
but the last return the columns they were given. Null texts are empty; a missing ``n_chars`` is not added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.chosen_path import mark_duplicates
from forecourt.llm.common import documents, written
from forecourt.llm.decontaminate import find_leaks
from forecourt.llm.language_id import identify
from forecourt.llm.line_dedup import dedup_lines
from forecourt.llm.packing import pack


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in like.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure, with ``lang`` as identified; the others go."""
    accepted = identify(docs).filter("accepted")
    return _columns(accepted.withColumn("lang", F.col("language")), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated windows of lines; those of which nothing is left go."""
    cut = dedup_lines(docs).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    sizes = {c: F.length("text").cast("long") for c in docs.columns if c.lower() == "n_chars"}
    return _columns(cut.withColumns(sizes) if sizes else cut, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return _columns(mark_duplicates(docs).filter("kept"), docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _columns(found.filter(F.size("leaks") == 0), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie in sequences."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("line dedup", lines),
    ("near duplicates", near_copies),
    ("decontamination", benchmarks),
    ("packing", packing),
]

# Tokens, likelihoods and edit distances have no counterpart in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
