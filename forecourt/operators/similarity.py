"""The most similar vectors seen so far, as numpy inside a task."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors of one side in one block; query rows and vectors multiplied at a time.
BLOCK_BYTES = 32 << 20
_ROWS_AT_ONCE = 512
_VECTORS_AT_ONCE = 1024
_DIGITS = 6
# So many new hits of ``_ROWS_AT_ONCE`` queries wait before they are merged.
_WAITING = 1 << 13
# Beyond this length, products could leave the range of single precision.
_LONGEST = 1e18


class Best:
    """The ``k`` most similar vectors seen so far for each query; ties go to the lower id.

    Holds a few rows more than ``k`` per query whatever the number of vectors shown to it. A
    vector enters only if it reaches the query's ``k``-th similarity so far, or the ``bar`` known of it before.
    Products in single precision tell which pairs may do so, with room for all its rounding errors; these are computed in
    double precision, which alone decides. Vectors beyond its range are multiplied in double precision at once.
    """

    def __init__(self, query_ids: pd.Series, queries: pd.Series, k: int, skip_self: bool, bar: pd.Series | None = None):
        self.query_ids, self.queries = ids_of(query_ids), matrix(queries)
        self.k, self.skip_self = k, skip_self
        n = len(self.query_ids)
        self.bar = np.full(n, -np.inf) if bar is None else bar.to_numpy(dtype=np.float64).copy()
        self.length = _lengths(self.queries)
        tiles = -(-n // _ROWS_AT_ONCE)
        self.kept: list[tuple | None] = [None] * tiles  # query position, id, similarity
        self.waiting: list[list[tuple]] = [[] for _ in range(tiles)]

    def show(self, ids: pd.Series | np.ndarray, vectors: pd.Series | np.ndarray, asking: np.ndarray | None = None) -> None:
        """Compare vectors with all queries, or with those that ``asking`` marks."""
        ids = ids_of(ids) if isinstance(ids, pd.Series) else ids
        vectors = matrix(vectors) if isinstance(vectors, pd.Series) else vectors
        for first in range(0, len(ids), _VECTORS_AT_ONCE):
            some = slice(first, first + _VECTORS_AT_ONCE)
            shown = ids[some], vectors[some], _lengths(vectors[some]).max()
            for tile, start in enumerate(range(0, len(self.query_ids), _ROWS_AT_ONCE)):
                at = np.arange(start, min(start + _ROWS_AT_ONCE, len(self.query_ids)))
                if asking is not None:
                    at = at[asking[start : start + _ROWS_AT_ONCE]]
                if len(at):
                    self._compare(tile, at, *shown)

    def _compare(self, tile: int, at: np.ndarray, ids: np.ndarray, vectors: np.ndarray, longest: float) -> None:
        queries, bar = self.queries[at], self.bar[at]
        single = self.length[at].max() < _LONGEST and longest < _LONGEST
        if single:
            block = queries.astype(np.float32, copy=False) @ vectors.astype(np.float32, copy=False).T
            error = (queries.shape[1] + 8) * 2.0**-23 * self.length[at] * longest + 10.0**-_DIGITS + 1e-30
        else:
            with np.errstate(all="ignore"):
                block = np.round(queries.astype(np.float64) @ vectors.astype(np.float64).T, _DIGITS)
            block[np.isnan(block)] = -np.inf  # no similarity at all
            error = 0.0
        if len(ids) > self.k and np.isneginf(bar).any():
            if self.skip_self:
                block[self.query_ids[at, None] == ids[None, :]] = -np.inf
            last = len(ids) - self.k
            bar = np.maximum(bar, np.partition(block, last, axis=1)[:, last] - error)
        least = bar - error
        if single:  # rounded down, so that the comparison in single precision loses nothing
            least = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
        near = np.flatnonzero((block >= least[:, None]) & (block > -np.inf) if np.isneginf(least).any() else block >= least[:, None])
        if not len(near):
            return
        query, vector = np.divmod(near, len(ids))
        if single:
            left, right = queries[query].astype(np.float64), vectors[vector].astype(np.float64)
            similarity = np.round(np.einsum("ij,ij->i", left, right), _DIGITS)
        else:
            similarity = block[query, vector]
        wanted = similarity >= self.bar[at[query]]
        if self.skip_self:
            wanted &= self.query_ids[at[query]] != ids[vector]
        self.waiting[tile].append((at[query[wanted]], ids[vector[wanted]], similarity[wanted]))
        if np.isneginf(self.bar[at]).any() or sum(len(x[0]) for x in self.waiting[tile]) >= _WAITING:
            self._merge(tile)

    def _merge(self, tile: int) -> None:
        """Keep the ``k`` best of each query of a tile."""
        parts = [x for x in (self.kept[tile], *self.waiting[tile]) if x is not None and len(x[0])]
        self.waiting[tile] = []
        if not parts:
            return
        rows = tuple(np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((rows[1], -rows[2], rows[0]))
        query = rows[0][order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.kept[tile] = tuple(column[order[place < self.k]] for column in rows)
        last = place == self.k - 1
        self.bar[query[last]] = np.maximum(self.bar[query[last]], rows[2][order[last]])

    def best(self) -> tuple | None:
        """Position of the query, id and similarity of all that is kept, or nothing."""
        for tile in range(len(self.kept)):
            self._merge(tile)
        kept = [x for x in self.kept if x is not None and len(x[0])]
        return tuple(np.concatenate(column) for column in zip(*kept)) if kept else None

    def frame(self) -> pd.DataFrame:
        found = self.best()
        if found is None:
            return nothing()
        query, ids, similarity = found
        return pd.DataFrame(
            {
                "query_id": plain(self.query_ids[query]),
                "id": plain(ids),
                "similarity": similarity,
            }
        )


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths of vectors; infinite where one is no number."""
    with np.errstate(all="ignore"):
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
    return np.where(np.isnan(length), np.inf, length)


def ids_of(column: pd.Series) -> np.ndarray:
    """Keys as a sortable array; text sorts by code point, as it does in Spark."""
    is_number = pd.api.types.is_numeric_dtype(column)
    return column.to_numpy() if is_number else column.to_numpy(dtype=str)


def nothing() -> pd.DataFrame:
    # Empty object columns convert to any key type, empty float columns do not.
    empty = pd.Series([], dtype=object)
    return pd.DataFrame({"query_id": empty, "id": empty, "similarity": empty})


def plain(ids: np.ndarray) -> pd.Series:
    """Text keys as Python strings; pandas' own string type may not reach Arrow in one piece."""
    return pd.Series(ids.astype(object), dtype=object) if ids.dtype.kind == "U" else pd.Series(ids)


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors as rows, in single precision if all of them are."""
    rows = np.stack(column.to_numpy())
    return rows if rows.dtype == np.float32 else rows.astype(np.float64, copy=False)


def vector_bytes(vectors: DataFrame, key: str) -> int:
    """Bytes of vectors and keys, with what a row costs besides."""
    size = F.size("vector") * 8 + F.octet_length(F.col(key).cast("string")) + 64
    return vectors.agg(F.sum(size)).first()[0] or 0
