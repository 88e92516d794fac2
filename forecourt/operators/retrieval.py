"""Exact top-k similarity search and the joins on top of it."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.similarity import BLOCK_BYTES, Best, nothing, vector_bytes
from forecourt.operators.vector_table import VectorTable
from forecourt.session import working_folder

# Tasks get the functions below by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Query vectors held by every task; more of them are handled block by block.
QUERY_BYTES = 32 << 20
# Row and bucket cells counted at a time while embedding.
_CELLS_AT_ONCE = 1 << 20
# Corpus rows shown to a search at a time.
_ROWS_AT_ONCE = 1024


def topk_similar(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_key: str,
    key: str,
    vector: str,
    query_vector: str | None = None,
    skip_self: bool = False,
    query_bytes: int = QUERY_BYTES,
    block_bytes: int = BLOCK_BYTES,
    terms: TermWeights | None = None,
) -> DataFrame:
    """The ``k`` corpus vectors with the largest dot product for each query, exactly.

    Result: query_id, id, similarity (rounded to six digits) and place. A
    vector whose similarity is not a number is not found. Each task keeps ``k`` rows per query and hands on only those at its end; a last
    window picks the final ones. Both keys must be numbers or text.

    Query vectors measured within ``query_bytes`` go to every task and the
    corpus is read once where it lies. For more queries the corpus is stored by
    cluster (``vector_table``), and a query visits only clusters that can hold one of its ``k``.

    With ``terms``, the corpus column ``vector`` holds buckets of terms (``hashed_terms``); a searching task makes their
    vectors a slice at a time, so they are neither handed from worker to worker nor held for a whole batch.
    """
    q = queries.select(
        F.col(query_key).alias("query_id"), F.col(query_vector or vector).alias("vector")
    ).filter("query_id IS NOT NULL AND vector IS NOT NULL")
    c = corpus.select(F.col(key).alias("id"), F.col(vector).alias("vector")).filter(
        "id IS NOT NULL AND vector IS NOT NULL"
    )
    kinds = dict(q.dtypes)["query_id"], dict(c.dtypes)["id"]
    schema = f"query_id {kinds[0]}, id {kinds[1]}, similarity double"

    size = vector_bytes(q, "query_id")
    if size <= query_bytes:
        local = q.toPandas()
        if local.empty:
            nearest = q.sparkSession.createDataFrame([], schema)
        else:
            shared = q.sparkSession.sparkContext.broadcast(local)

            def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                best = Best(shared.value["query_id"], shared.value["vector"], k, skip_self)
                for batch in batches:
                    for start in range(0, len(batch), _ROWS_AT_ONCE):
                        part = batch.iloc[start : start + _ROWS_AT_ONCE]
                        best.show(part["id"], unit_vectors(part["vector"], terms) if terms else part["vector"])
                yield best.frame()

            nearest = c.mapInPandas(search, schema)
    else:
        if terms:
            c = embed_terms(c, terms, "vector", "embedded").withColumnRenamed("embedded", "vector")
        table = VectorTable.build(c, "id", "vector", working_folder(q.sparkSession, "vectors"), block_bytes)
        nearest = table.search(q, k, skip_self).hits

    return placed(nearest, k)


def placed(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of each query with their place; ties go to the lower id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _tokens(text: str, bigrams: bool):
    lowered = F.lower(text)
    if bigrams:  # for text written without spaces; a look-ahead finds overlapping pairs
        return F.regexp_extract_all(lowered, F.lit(r"(?s)(?=([\p{L}\p{N}]{2}))"), F.lit(1))
    return F.regexp_extract_all(lowered, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


@dataclass(frozen=True)
class TermWeights:
    """One weight per hash bucket, and how terms are cut."""

    weights: tuple[float, ...]
    bigrams: bool = False


def hashed_terms(
    df: DataFrame, text: str, dimensions: int = 256, bigrams: bool = False, out: str = "terms"
) -> DataFrame:
    """``df`` with the buckets of its terms: the first 32 bits of each term's MD5, modulo ``dimensions``."""

    def bucket(term: Column) -> Column:
        return (F.conv(F.left(F.md5(term), F.lit(8)), 16, 10).cast("long") % dimensions).cast("int")

    return df.withColumn(out, F.transform(_tokens(text, bigrams), bucket))


def fit_weights(
    hashed: DataFrame, terms: str = "terms", dimensions: int = 256, bigrams: bool = False
) -> TermWeights:
    """ln((rows + 1) / (rows with the bucket + 1)); the driver only receives one count per bucket."""
    counts = hashed.select(F.explode(F.array_distinct(terms)).alias("bucket")).groupBy("bucket").count()
    having = dict(map(tuple, counts.collect()))
    rows = hashed.count()
    return TermWeights(
        tuple(log((rows + 1) / (having.get(b, 0) + 1)) for b in range(dimensions)), bigrams
    )


def fit_embedding(df: DataFrame, text: str, dimensions: int = 256, bigrams: bool = False) -> TermWeights:
    """Term weights learnt from ``df``."""
    hashed = hashed_terms(df.select(text), text, dimensions, bigrams)
    return fit_weights(hashed, "terms", dimensions, bigrams)


def unit_vectors(buckets: pd.Series, model: TermWeights) -> pd.Series:
    """Unit vectors of weighted bucket counts, for rows of one batch; null for null."""
    weights = np.asarray(model.weights)
    at_once = max(1, _CELLS_AT_ONCE // max(1, len(weights)))
    own = [None if b is None else np.asarray(b, dtype=np.int64) for b in buckets]
    out = []
    for start in range(0, len(own), at_once):
        part = [np.empty(0, np.int64) if b is None else b for b in own[start : start + at_once]]
        row = np.repeat(np.arange(len(part)), [len(b) for b in part])
        cells = np.bincount(row * len(weights) + np.concatenate(part), minlength=len(part) * len(weights))
        values = cells.reshape(len(part), -1) * weights
        length = np.sqrt((values * values).sum(axis=1, keepdims=True))
        out += list(values / np.where(length > 0, length, 1))
    return pd.Series([None if b is None else v for b, v in zip(own, out)], dtype=object)


def embed_terms(
    hashed: DataFrame, model: TermWeights, terms: str = "terms", out: str = "embedding"
) -> DataFrame:
    """Unit vectors of weighted bucket counts, in place of the buckets."""

    @F.pandas_udf("array<double>")
    def unit(buckets: pd.Series) -> pd.Series:
        return unit_vectors(buckets, model)

    return hashed.withColumn(out, unit(F.col(terms))).drop(terms)


def embed_hash(
    df: DataFrame, model: TermWeights, text: str, bigrams: bool = False, out: str = "embedding"
) -> DataFrame:
    """Unit vectors of hashed term weights, a repeatable stand-in for a learnt embedding."""
    hashed = hashed_terms(df, text, len(model.weights), bigrams or model.bigrams, "_terms")
    return embed_terms(hashed, model, "_terms", out)


def join_hits_to_metrics(hits: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Search hits next to the figures of the item they point at; hits without figures stay."""
    return hits.join(metrics.withColumnRenamed(key, "id"), "id", "left")


def nearest(df: DataFrame, key: str, probe: object, column: str, k: int) -> DataFrame:
    """The ``k`` rows whose ``column`` is nearest to that of the row with key ``probe``.

    Nothing is near an unknown probe or one without a value; a probe key that occurs twice fails the job.
    """
    target = df.filter(F.col(key) == F.lit(probe)).select(F.col(column).alias("_target"))
    distance = F.abs(F.col(column) - target.scalar())
    others = df.filter((F.col(key) != F.lit(probe)) & F.col(column).isNotNull())
    near = others.withColumn("distance", distance).filter("distance IS NOT NULL")
    return near.orderBy("distance", key).limit(k)
