"""Packing of tokenised documents into windows by non-negative least squares on the histogram of lengths.

1. Documents are tokenised in tasks; each, with an end token, is cut into whole windows and a remainder.
2. The histogram of remainders (a row per length) goes to the driver. Shallow combinations of up to three lengths
   that fill a window exactly are enumerated; non-negative least squares finds how often to use each, so that
   together they use up the histogram; counts are rounded and held to what is there.
3. What rounding leaves is packed greedily: equal lengths in groups that share a few windows, then the last few
   of each length one after the other, cutting where a window ends (on a grid of 64 tokens).
4. The plan says for each length which ranks go to which windows; its size depends on the window, not on the number
   of documents. Each piece gets its rank within its length from counts per task and running sums over tasks, so
   a length that a third of all documents share is ranked without meeting in one place.

Pieces carry checksums at every grid point, from which those of a cut piece follow without the tokens.

Defined results: a null or empty text is a document of one token, the end token; every row is a document of its own,
so repeated rows are all packed; rows without an id keep a null id.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import documents, hold, written
from forecourt.llm.token_counts import tokenizer_path

TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048
END = 1  # the id after each document
GRID = 64  # tokens between the points where a piece may be cut
PRE_TOKENS = 1 << 18  # pre-tokens that a worker remembers, about 150 bytes each; a rare one costs a call of the tokenizer's model
WORDS = 1 << 17  # and words of texts that the patterns below do not cover
SLICE = 256

_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ", "0-9²³¹¼-¾", "\\t-\\r "
_PLAIN = re.compile(f"[{_S}!-~¡-¬®-įı-ſ‐-‧€]*")
_PRE_TOKEN = re.compile(f"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^{_S}{_L}{_N}]+")

# The vocabulary writes bytes as characters: printable Latin-1 as it is, the others in order from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Remembered(dict):
    """Ids, as bytes, that ``find`` gives for a key that is not there yet; starts anew when it is full."""

    def __init__(self, find: Callable, most: int):
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        found = self[key] = self.find(key)
        return found


class WordIds:
    """Ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops blanks and encodes each pre-token by itself, so a text's ids are its pre-tokens' ids in a row.
    Where it might cut or change characters otherwise than the patterns above, a text goes through it word by word.
    """

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.model = self.tokenizer.model
        self.words = Remembered(self.word, WORDS)
        self.pieces = Remembered(self.piece, PRE_TOKENS)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not ("<|" in text and any(a in text for a in self.added))

    def piece(self, piece: str) -> bytes:
        """The ids of a pre-token in lower case."""
        written = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTES)
        ids = [token.id for token in self.model.tokenize(written)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, raw: bytes) -> bytes:
        """The ids of what stands between two ASCII blanks."""
        word = raw.decode()
        if self.plain(word):
            return self.plain_ids(word)
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def plain_ids(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PRE_TOKEN.findall(text.lower())))

    def ids(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each text, without end token."""
        for raw in texts:
            text = (raw or b"").decode()
            yield self.plain_ids(text) if self.plain(text) else b"".join(map(self.words.__getitem__, raw.split()))


@lru_cache(maxsize=1)
def _word_ids(name: str) -> WordIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(name)


def word_ids(name: str) -> WordIds:
    hold("packing", _word_ids.cache_clear)
    return _word_ids(name)


def shifted(crc: int, n_bytes: int) -> int:
    """The part of a checksum that stays when ``n_bytes`` follow: crc(a + b) == shifted(crc(a), len(b)) ^ crc(b)."""
    zeros = bytes(n_bytes)
    return zlib.crc32(zeros, crc) ^ zlib.crc32(zeros)


def grid_checksums(data: bytes, grid: int = GRID) -> bytes:
    """Checksums of the first ``grid``, ``2 * grid``, ... ids, as 32-bit integers."""
    crc, out, step = 0, [], 4 * grid
    for at in range(0, len(data) - step + 1, step):
        crc = zlib.crc32(data[at : at + step], crc)
        out.append(crc)
    return np.asarray(out, "<u4").tobytes()


PIECES = "doc_id long, doc_tokens long, start long, length int, crc long, grid binary, task int, nth long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tokenizer: str = TOKENIZER) -> DataFrame:
    """Windows and remainder of each document, numbered by task and, within it, per length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, task, seen = word_ids(tokenizer), TaskContext.get().partitionId(), [0] * (window + 1)
        end = np.asarray([END], "<u4").tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), worker.ids(part.column(1).cast(pa.binary()).to_pylist()), strict=True):
                    data = ids + end
                    n = len(data) // 4
                    for start in range(0, n, window):
                        own = data[4 * start : 4 * (start + window)]
                        length = len(own) // 4
                        grid = grid_checksums(own) if length < window else b""
                        rows.append((doc_id, n, start, length, zlib.crc32(own), grid, task, seen[length]))
                        seen[length] += 1
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["doc_id", "doc_tokens", "start", "length", "crc", "grid", "task", "nth"],
                )

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES)


# --- the plan ---------------------------------------------------------------------------------------------------


def fillings(lengths: np.ndarray, window: int, step: int) -> np.ndarray:
    """Combinations that fill the window: all of one or two lengths, and of three those with one on a coarse step
    or two alike. Rows of three lengths, 0 for none."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    out = [(window, 0, 0)] if there[window] else []
    out += [(window - a, a, 0) for a in range(1, window // 2 + 1) if there[a] and there[window - a]]
    triples = set()
    for a in lengths.tolist():
        for b in {a, *range(step, window, step)}:
            c = window - a - b
            if c > 0 and there[b] and there[c]:
                triples.add(tuple(sorted((a, b, c), reverse=True)))
    return np.asarray(out + sorted(triples, reverse=True), int).reshape(-1, 3)


def least_squares(columns: np.ndarray, histogram: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """x >= 0 that makes the combinations, used x times, come closest to the histogram (coordinate descent)."""
    sides = [np.unique(row[row > 0], return_counts=True) for row in columns]
    sides = [(lengths.tolist(), counts.tolist(), float((counts**2).sum())) for lengths, counts in sides]
    left, x = histogram.astype(float).tolist(), [0.0] * len(sides)
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, counts, norm) in enumerate(sides):
            slope = sum(left[a] * n for a, n in zip(lengths, counts, strict=True)) / norm
            change = max(slope, -x[j])
            if change:
                x[j] += change
                moved = max(moved, abs(change))
                for a, n in zip(lengths, counts, strict=True):
                    left[a] -= change * n
        if moved < 0.25:
            break
    return np.asarray(x)


@dataclass
class Plan:
    """Slots in order of (length, first rank): ranks ``lo + m * k + j`` lie in the k-th repetition as its j-th piece.

    ``parts[slot][j]`` lists (start in piece, length, window within the repetition, offset).
    """

    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, lo, m, first window, windows
    parts: list[list[list[tuple[int, int, int, int]]]] = field(default_factory=list)
    windows: int = 0
    tokens: int = 0

    def add(self, length: int, lo: int, repeats: int, windows: int, first: int, parts: list) -> None:
        self.rows.append((length, lo, len(parts), first, windows))
        self.parts.append(parts)
        self.tokens += length * len(parts) * repeats

    def ordered(self) -> Plan:
        order = sorted(range(len(self.rows)), key=lambda i: self.rows[i][:2])
        return Plan([self.rows[i] for i in order], [self.parts[i] for i in order], self.windows, self.tokens)


def laid(length: int, offset: int, at: int, window: int, grid: int) -> tuple[list[tuple[int, int, int, int]], int, int]:
    """Parts of a piece put at ``offset`` of window ``at``, cut on the grid where the window ends; the new place."""
    gap = window - offset
    if length <= gap:
        return [(0, length, at, offset)], offset + length, at
    head = gap // grid * grid
    parts = [(0, head, at, offset)] if head else []
    return [*parts, (head, length - head, at + 1, 0)], length - head, at + 1


def group(length: int, window: int, grid: int, most: int = 32) -> tuple[int, int]:
    """How many equal pieces, laid one after the other from a fresh window, waste least; and the windows they take."""
    best, offset, at = (2.0, 1, 1), 0, 0
    for n in range(1, most + 1):
        _, offset, at = laid(length, offset, at, window, grid)
        waste = 1 - n * length / ((at + 1) * window)
        best = min(best, (round(waste, 4), n, at + 1))
    return best[1], best[2]


def make_plan(histogram: np.ndarray, window: int = WINDOW, grid: int = GRID) -> Plan:
    """Where each rank of each length goes; ``histogram[l]`` pieces have length ``l``."""
    left, plan = histogram.astype(np.int64).copy(), Plan()
    taken = np.zeros_like(left)

    def place(combination: list[int], repeats: int) -> None:
        offset = 0
        spots: dict[int, list] = {}
        for length in combination:
            spots.setdefault(length, []).append([(0, length, 0, offset)])
            offset += length
        for length, parts in spots.items():
            plan.add(length, int(taken[length]), repeats, 1, plan.windows, parts)
            taken[length] += len(parts) * repeats
            left[length] -= len(parts) * repeats
        plan.windows += repeats

    lengths = np.flatnonzero(left)
    combinations = fillings(lengths, window, max(grid, window // 16)) if len(lengths) else np.zeros((0, 3), int)
    x = least_squares(combinations, left)
    for j in np.argsort(-x, kind="stable"):
        combination = [int(a) for a in combinations[j] if a]
        there = min(int(left[a]) // combination.count(a) for a in combination)
        if (repeats := min(int(np.rint(x[j])), there)) > 0:
            place(combination, repeats)

    for length in np.flatnonzero(left).tolist():
        m, windows = group(length, window, grid)
        if repeats := int(left[length]) // m:
            parts, offset, at = [], 0, 0
            for _ in range(m):
                own, offset, at = laid(length, offset, at, window, grid)
                parts.append(own)
            plan.add(length, int(taken[length]), repeats, windows, plan.windows, parts)
            plan.windows += windows * repeats
            taken[length] += m * repeats
            left[length] -= m * repeats

    offset, at = 0, 0
    for length in np.flatnonzero(left)[::-1].tolist():
        for _ in range(int(left[length])):
            parts, offset, at = laid(length, offset, at, window, grid)
            plan.add(length, int(taken[length]), 1, 0, plan.windows, [parts])
            taken[length] += 1
    plan.windows += at + (offset > 0)
    return plan.ordered()


# --- placement --------------------------------------------------------------------------------------------------

PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, grid: int = GRID, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence."""
    cut = written(pieces(docs, id_col, text_col, window, tokenizer), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most a row per length
        histogram[length] = n
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(histogram, window, grid))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "task"]).select(
        "doc_id", "doc_tokens", "start", "length", "crc", "grid", (F.col("base") + F.col("nth")).alias("rank")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = plan.value
        keys = np.asarray([(length << 48) | lo for length, lo, *_ in own.rows], np.int64)
        for batch in batches:
            slots = np.searchsorted(keys, (batch["length"].to_numpy(np.int64) << 48) | batch["rank"].to_numpy(np.int64), "right") - 1
            rows = []
            for doc_id, n, start, length, crc, checks, rank, slot in zip(
                batch["doc_id"].astype("Int64"), batch["doc_tokens"], batch["start"], batch["length"], batch["crc"], batch["grid"], batch["rank"], slots.tolist(), strict=True
            ):
                _, lo, m, first, windows = own.rows[slot]
                k, j = divmod(rank - lo, m)
                for at, size, window_at, offset in own.parts[slot][j]:
                    own_crc = crc if size == length else part_checksum(checks, crc, at, size, length, grid)
                    rows.append((doc_id, start + at, size, own_crc, n, first + k * windows + window_at, offset))
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            yield frame.astype({"doc_id": "Int64"})

    return ranked.mapInPandas(place, PLACED)


def part_checksum(checks: bytes, crc: int, at: int, size: int, length: int, grid: int) -> int:
    """The checksum of ids ``at`` to ``at + size`` of a piece, from those at its grid points and its own."""
    points = np.frombuffer(checks, "<u4")
    to = crc if at + size == length else int(points[(at + size) // grid - 1])
    return to ^ shifted(int(points[at // grid - 1]), 4 * size) if at else to


def sequences(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """The ids of each sequence, for documents with unique ids: ``sequence_id``, ``ids``."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = word_ids(tokenizer).ids(batch.column(1).cast(pa.binary()).to_pylist())
            ids = [[*np.frombuffer(x, "<u4").tolist(), END] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "all_ids"])

    tokens = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        tokenise, "doc_id long, all_ids array<int>"
    )
    own = placed.join(tokens, "doc_id").select(
        "sequence_id", "offset", F.slice("all_ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids")
    )
    parts = own.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def q_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens, a row per piece."""
    return pack(documents(spark, sf_dir))
