"""Vectors stored by cluster, and an exact top-k search that skips clusters.

Every vector lies with the nearest of a bounded number of centres, and a directory keeps each cluster's centre c and
radius r. No vector of a cluster has a dot product with q above q·c + |q|·r. A search visits each query's most promising
cluster first, which gives a k-th best similarity to beat, then only those clusters whose bound reaches it.
What is skipped cannot change the result, so rows are those of a full comparison.

Centres come from a bounded sample; they only decide how much is skipped. The directory has at most ``CLUSTERS`` + 1 rows
whatever the corpus is, so tasks may hold it. A cluster beyond ``block_bytes`` is cut into pieces. A query looks into one
piece of its first cluster. For the second round neighbouring pieces are put on shelves, and a query goes once to every shelf that has
a cluster for it, where it is compared with those clusters only. Queries of a shelf are cut into chunks, so a task compares
two blocks of at most about ``cell_bytes``. There are ``SIDES`` shelves and ``SIDES`` chunks until blocks of that size
are full: up to there, what is shuffled grows with the input even if nothing can be skipped.
Vectors with a component that is not finite share a cluster whose radius is infinite; it is always visited.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.operators.similarity import BLOCK_BYTES, Best, ids_of, matrix, nothing, vector_bytes
from forecourt.session import working_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLUSTERS = 1024
# Vectors from which centres are chosen: so many for each, and in all at most so many bytes.
SAMPLED = 8
SAMPLE_BYTES = 32 << 20
_STEPS = 4
# Shelves, and chunks of a shelf's queries, while blocks are smaller than allowed; and the least block worth cutting.
SIDES = 8
_LEAST = 64
# Pieces up to which their loads are known to every task, and queries whose bounds are found at a time.
_LISTED = 1 << 16
_AT_ONCE = 8192
# Similarities are compared after rounding to six digits; bounds also carry rounding errors of their own.
_SLACK = 1e-6
_RELATIVE = 1e-9

_WIDTH = "size(vector) * {} + 64"


def _kept(vector: Column, kind: str) -> Column:
    """Vectors in the precision they come in."""
    return vector if kind == "array<float>" else vector.cast("array<double>")


def _width(kind: str) -> Column:
    return F.expr(_WIDTH.format(4 if kind == "array<float>" else 8))


def _centres(sample: np.ndarray, n: int) -> np.ndarray:
    """A few steps of k-means over the sample, started from its first different vectors."""
    different = np.unique(sample, axis=0)
    centres = different[np.linspace(0, len(different) - 1, min(n, len(different))).astype(int)]
    for _ in range(_STEPS):
        own = _nearest(sample, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


@dataclass(frozen=True)
class Directory:
    """What tasks know of the clusters, in order of their number."""

    cluster: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    centre: np.ndarray
    pieces: np.ndarray

    def shelves(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each cluster begins if all pieces stand in a row over ``n`` shelves, and the width of its pieces."""
        share = self.rows / max(1, self.rows.sum()) * n
        return np.cumsum(share) - share, share / self.pieces

    def products(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """q·c and the bound, for each query and cluster; a bound that is no number excludes nothing."""
        with np.errstate(all="ignore"):
            inner = queries @ self.centre.T
            length = np.linalg.norm(queries, axis=1)[:, None]
            reach = length * self.radius[None, :]
            error = _RELATIVE * length * (np.linalg.norm(self.centre, axis=1) + self.radius)[None, :]
            bound = inner + reach + error + _SLACK
        return inner, np.where(np.isnan(bound), np.inf, bound)


@dataclass(frozen=True)
class Search:
    """``hits`` (query_id, id, similarity) hold every query's best; ``visits`` the queries of the second round."""

    hits: DataFrame
    visits: DataFrame


class VectorTable:
    def __init__(self, spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, cell_bytes: int = BLOCK_BYTES):
        """The table stored at ``path``."""
        self.spark, self.block_bytes, self.cell_bytes = spark, block_bytes, cell_bytes
        self.rows = spark.read.parquet(f"{path}/rows")
        self.listed = spark.read.parquet(f"{path}/clusters")
        found = self.listed.orderBy("cluster").toPandas()  # at most CLUSTERS + 1 rows
        self.directory = Directory(
            found["cluster"].to_numpy(),
            found["rows"].to_numpy(),
            found["radius"].to_numpy(dtype=np.float64),
            matrix(found["centre"]) if len(found) else np.empty((0, 0)),
            found["pieces"].to_numpy(),
        )

    @classmethod
    def build(
        cls, corpus: DataFrame, key: str, vector: str, path: str, block_bytes: int = BLOCK_BYTES, clusters: int = CLUSTERS
    ) -> VectorTable:
        """Store ``corpus`` by cluster below ``path``; rows without a key or a vector are left out."""
        spark = corpus.sparkSession
        kind = dict(corpus.dtypes)[vector]
        kept = corpus.select(F.col(key).alias("id"), _kept(F.col(vector), kind).alias("vector")).filter(
            "id IS NOT NULL AND vector IS NOT NULL"
        )
        size = vector_bytes(kept, "id")
        wanted = min(clusters, CLUSTERS, max(1, ceil(size / block_bytes)))
        kind = dict(kept.dtypes)["vector"]
        finite = kept.filter("NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
        width = finite.agg(F.max(F.size("vector"))).first()[0] or 1
        most = max(wanted, min(SAMPLED * wanted, SAMPLE_BYTES // (8 * width)))
        mixed = F.xxhash64("id", F.monotonically_increasing_id())
        sample = finite.select(mixed.alias("h"), "vector").orderBy("h").limit(most).toPandas()["vector"]
        centres = _centres(_double(sample), wanted) if len(sample) else np.zeros((1, width))
        shared = spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                vectors = _double(batch["vector"])
                plain = np.isfinite(vectors).all(axis=1)
                safe = np.where(plain[:, None], vectors, 0.0)
                own = _nearest(safe, shared.value)
                away = np.linalg.norm(safe - shared.value[own], axis=1)
                yield batch.assign(
                    cluster=np.where(plain, own, -1).astype(np.int32), distance=np.where(plain, away, np.inf)
                )

        schema = f"id {dict(kept.dtypes)['id']}, vector {kind}, spread long, cluster int, distance double"
        # Rows with the same key and vector differ in their place, so that pieces can part them.
        placed = kept.withColumn("spread", F.xxhash64("id", F.monotonically_increasing_id()))
        assigned = placed.mapInPandas(assign, schema)
        totals = assigned.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(_width(kind)).alias("bytes"), F.max("distance").alias("radius")
        )
        listed = [
            (r["cluster"], r["rows"], max(1, ceil(r["bytes"] / block_bytes)), r["radius"],
             [float(x) for x in (centres[r["cluster"]] if r["cluster"] >= 0 else np.zeros(centres.shape[1]))])
            for r in totals.collect()  # at most CLUSTERS + 1 rows
        ]
        known = spark.createDataFrame(listed, "cluster int, rows long, pieces int, radius double, centre array<double>")
        known.coalesce(1).write.parquet(f"{path}/clusters")
        piece = F.pmod("spread", F.col("pieces")).cast("int").alias("piece")
        cut = assigned.join(F.broadcast(known.select("cluster", "pieces")), "cluster")
        cut = cut.select("cluster", piece, "id", "vector")
        cut.repartition("cluster", "piece").sortWithinPartitions("cluster", "piece").write.parquet(f"{path}/rows")
        return cls(spark, path, block_bytes)

    def search(self, queries: DataFrame, k: int, skip_self: bool = False) -> Search:
        """The ``k`` best of every query among at most a few more hits; ``queries`` has query_id and vector."""
        base = working_folder(self.spark, "vector-search")
        kind, own_kind = dict(queries.dtypes)["query_id"], dict(self.rows.dtypes)["id"]
        vectors = _kept(F.col("vector"), dict(queries.dtypes)["vector"]).alias("vector")
        queries.select(F.monotonically_increasing_id().alias("row"), "query_id", vectors).write.parquet(f"{base}/queries")
        asked = self.spark.read.parquet(f"{base}/queries")
        precision = dict(asked.dtypes)["vector"]
        shared = self.spark.sparkContext.broadcast(self.directory)
        enough = k + skip_self

        def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = shared.value
            for batch in batches:
                if len(batch) and len(known.cluster):
                    at = _first(known, _double(batch["vector"]), enough)
                    piece = batch["row"].to_numpy() % known.pieces[at]
                    yield batch.assign(cluster=known.cluster[at], piece=piece.astype(np.int32))

        columns = f"row long, query_id {kind}, vector {precision}, cluster int, piece int"
        asked.mapInPandas(first, columns).write.parquet(f"{base}/placed")
        begun = self.spark.read.parquet(f"{base}/placed")
        hit = f"row long, query_id {kind}, id {own_kind}, similarity double"
        self._begun(begun, k, skip_self, hit).write.parquet(f"{base}/first")
        found = self.spark.read.parquet(f"{base}/first")
        order = Window.partitionBy("row").orderBy(F.desc("similarity"))
        bars = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") == k)
        barred = begun.join(bars.select("row", F.col("similarity").alias("bar")), "row", "left")
        barred.na.fill({"bar": float("-inf")}).write.parquet(f"{base}/barred")
        visits, others = self._others(self.spark.read.parquet(f"{base}/barred"), k, skip_self, hit, shared)
        return Search(found.unionByName(others).drop("row"), visits)

    def _begun(self, begun: DataFrame, k: int, skip_self: bool, schema: str) -> DataFrame:
        """Every query with the ``k`` best of the piece it begins with."""
        keys = ["cluster", "piece"]
        load = begun.groupBy(*keys).agg(F.sum(_width(dict(begun.dtypes)["vector"])).alias("bytes"))
        cuts = load.select(*keys, F.ceil(F.col("bytes") / self.cell_bytes).cast("int").alias("chunks"))
        cuts = F.broadcast(cuts) if self.directory.pieces.sum() <= _LISTED else cuts
        left = begun.join(cuts, keys).withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))
        # Pieces that nobody visits end here, before the shuffle.
        right = self.rows.join(cuts, keys).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

        def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return _none()
            best = Best(left["query_id"], left["vector"], k, skip_self)
            best.show(right["id"], right["vector"])
            return _numbered(best, left["row"])

        keys.append("chunk")
        grouped = left.select(*keys, "row", "query_id", "vector").groupBy(*keys)
        return grouped.cogroup(right.select(*keys, "id", "vector").groupBy(*keys)).applyInPandas(cell, schema)

    def _others(self, barred: DataFrame, k: int, skip_self: bool, schema: str, shared) -> tuple[DataFrame, DataFrame]:
        """The shelves that queries visit after their first piece, and the hits there that reach the bar."""
        kind, own = dict(barred.dtypes)["vector"], dict(self.rows.dtypes)["vector"]
        per_row = self.rows.agg(F.max(_width(own))).first()[0] or 1
        n = self._sides(int(self.directory.rows.sum()) * per_row)
        begin, step = self.directory.shelves(n)
        # Positions of clusters, at most CLUSTERS + 1 rows.
        listed = list(zip(self.directory.cluster.tolist(), begin.tolist(), step.tolist()))
        places = F.broadcast(self.spark.createDataFrame(listed, "cluster int, begin double, step double"))
        end = begin + step * (self.directory.pieces - 1)
        ranges = np.minimum(np.stack([begin, end]), n - 1).astype(int)

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = shared.value
            for batch in batches:
                if not len(batch) or not len(known.cluster):
                    continue
                bound = known.products(_double(batch["vector"]))[1]
                open_ = ~(bound < batch["bar"].to_numpy(dtype=np.float64)[:, None])
                # The first piece is done; it is left out in the cell unless it is all of its cluster.
                alone = known.pieces[np.searchsorted(known.cluster, batch["cluster"])] == 1
                open_[alone, np.searchsorted(known.cluster, batch["cluster"][alone])] = False
                for shelf in range(n):
                    here = open_[:, (ranges[0] <= shelf) & (shelf <= ranges[1])].any(axis=1)
                    if here.any():
                        yield batch[here].assign(shelf=shelf)

        columns = f"row long, query_id {dict(barred.dtypes)['query_id']}, vector {kind}, cluster int, piece int, bar double, shelf int"
        visits = barred.select("row", "query_id", "vector", "cluster", "piece", "bar").mapInPandas(others, columns)
        # A query's visits are counted as if it went to every shelf, which bounds the load without another pass.
        asking = barred.agg(F.count(F.lit(1)), F.max(_width(kind))).first()
        chunks = self._sides(asking[0] * (asking[1] or 1))
        place = F.least(F.floor(F.col("begin") + F.col("piece") * F.col("step")), F.lit(n - 1)).cast("int").alias("shelf")
        rows = self.rows.join(places, "cluster").select("cluster", "piece", "id", "vector", place)
        rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        left = visits.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))

        def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return _none()
            known = shared.value
            best = Best(left["query_id"], left["vector"], k, skip_self, left["bar"])
            done = left["cluster"].to_numpy(), left["piece"].to_numpy()
            ids, vectors = ids_of(right["id"]), matrix(right["vector"])
            for (cluster, piece), at in right.groupby(["cluster", "piece"]).indices.items():
                near = ~(_bound(known, cluster, best.queries) < best.bar) & ~((done[0] == cluster) & (done[1] == piece))
                if near.any():
                    best.show(ids[at], vectors[at], near)
            return _numbered(best, left["row"])

        keys = ["shelf", "chunk"]
        # Cells are few and large; so many partitions are not put together again.
        parts = 4 * n * chunks
        left = left.repartition(parts, *keys).groupBy(*keys)
        right = rows.select(*keys, "cluster", "piece", "id", "vector").repartition(parts, *keys).groupBy(*keys)
        return visits, left.cogroup(right).applyInPandas(cell, schema)

    def _sides(self, size: int) -> int:
        """Parts of a block of ``size`` bytes."""
        return max(1, ceil(size / self.cell_bytes), min(SIDES, ceil(size * _LEAST / self.cell_bytes)))


def _bound(known: Directory, cluster: int, queries: np.ndarray) -> np.ndarray:
    """The bound of every query for one cluster."""
    at = np.searchsorted(known.cluster, [cluster])
    one = Directory(known.cluster[at], known.rows[at], known.radius[at], known.centre[at], known.pieces[at])
    some = (queries[start : start + _AT_ONCE].astype(np.float64) for start in range(0, len(queries), _AT_ONCE))
    return np.concatenate([one.products(x)[1][:, 0] for x in some])


def _double(column: pd.Series) -> np.ndarray:
    return matrix(column).astype(np.float64, copy=False)


def _none() -> pd.DataFrame:
    return nothing().assign(row=pd.Series([], dtype=object))


def _numbered(best: Best, row: pd.Series) -> pd.DataFrame:
    found = best.best()
    return _none() if found is None else best.frame().assign(row=row.to_numpy()[found[0]])


def _first(known: Directory, queries: np.ndarray, enough: int) -> np.ndarray:
    """Where each query looks first: the largest q·c among clusters that can fill its places."""
    full = known.rows // known.pieces
    able = full >= enough
    able = able if able.any() else full == full.max()
    inner = known.products(queries)[0]
    return np.argmax(np.where(able[None, :] & ~np.isnan(inner), inner, -np.inf), axis=1)
