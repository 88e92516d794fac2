"""Benchmark passages in documents, found within an edit budget.

Texts are reduced to lower-case words with single blanks between them. A test item of m characters may occur with up to
k = floor(m * rate) edits. Cut into k + 1 pieces, at least one piece must occur unchanged (pigeonhole); all pieces
of all items are looked for in one pass (Aho-Corasick). Around each hit that no earlier match explains, the item is
compared by Myers' bit-parallel distance in a window of its length and the budget on both sides, so that a text costs in proportion to its
hits, and one occurrence never hides its neighbour. Occurrences of an item don't overlap; from the left, each begins
behind the one before.

Documents are scanned where they lie. Items come in blocks of bounded size: each block is broadcast and scanned by
itself, so neither the driver nor a task holds more than a block of any benchmark.

Defined results: null or empty texts and items without words match nothing; an item with a budget of 0 must occur as whole
words; items alike in words are each reported; repeated rows are each scanned; other columns pass through, an
existing column of the result's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import documents, drop_names, free_name, hold

RATE = 0.06  # edits allowed per character of an item
BLOCK_CHARS = 8_000_000  # characters of benchmark text scanned for at a time

_WORD = re.compile(r"\w+")
LEAKS = "array<struct<item_id: bigint, start: bigint, end: bigint, distance: int>>"
_ARROW_LEAKS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int32())])
)


def normalised(text: str) -> str:
    return " ".join(_WORD.findall(text)).lower()


def places(text: str) -> list[int]:
    """For each character of ``" " + normalised(text) + " "``, the position in ``text`` it comes from."""
    out = [0]
    for found in _WORD.finditer(text):
        a, b = found.span()
        out += [min(a + i, b - 1) for i in range(len(found[0].lower()))]
        out.append(b)
    return out


def split_pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces with their offsets, as equal as can be."""
    n, m = budget + 1, len(item)
    cuts = [m * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(item: dict[str, int], m: int, text: Iterable[str], anchored: bool = False) -> tuple[int, int]:
    """The smallest distance of the item to a part of ``text`` (one that begins at its start, if anchored) and where
    the first such part ends (exclusive)."""
    every, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = every, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = item.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (every & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        if score < best:
            best, end = score, j
        up = (up << 1 | anchored) & every
        down = (down << 1) & every
        plus = down | (every & ~(vertical | up))
        minus = up & vertical
    return best, end


class Scanner:
    """Looks for a block of items in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        import ahocorasick

        self.items: list[tuple[str, int, dict, dict, list]] = []
        where: dict[str, list[tuple[int, int]]] = {}
        by_text: dict[str, list] = {}
        for item_id, text in items:
            by_text.setdefault(text, []).append(item_id)
        for text, ids in by_text.items():
            budget = int(len(text) * rate)
            number = len(self.items)
            self.items.append((text, budget, masks(text), masks(text[::-1]), ids))
            for at, piece in split_pieces(text, budget) if budget else [(-1, f" {text} ")]:
                where.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, targets in where.items():
            self.automaton.add_word(piece, (len(piece), targets))
        self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, distance) of each passage, by start, in positions of ``text``."""
        plain = f" {normalised(text)} "
        diagonals: dict[int, set[int]] = {}
        for last, (length, targets) in self.automaton.iter(plain):
            for number, at in targets:
                diagonals.setdefault(number, set()).add(last + 1 - length - at)
        found = [hit for number in diagonals for hit in self.verified(number, diagonals[number], plain)]
        if not found:
            return []
        place = places(text)
        out = [
            (item_id, place[a], place[b - 1] + 1, distance) for number, a, b, distance in found for item_id in self.items[number][4]
        ]
        return sorted(out, key=lambda hit: (hit[1], hit[2], hit[0] is not None, hit[0] or 0))

    def verified(self, number: int, diagonals: set[int], plain: str) -> Iterator[tuple[int, int, int, int]]:
        text, budget, forward, backward, _ = self.items[number]
        m, before = len(text), 0
        explained = -1
        for d in sorted(diagonals):
            # Each diagonal has a window of its own, so the cost is in proportion to the number of hits.
            a, b = max(before, d - budget), min(len(plain), d + m + budget)
            if d <= explained or b - a < m - budget:
                continue
            found = self.nearest(text, budget, forward, backward, plain, a, b)
            if found and found[2]:
                # A hit by chance may have cut off the end of the occurrence that it met.
                reach = min(len(plain), found[0] + m + budget)
                found = self.nearest(text, budget, forward, backward, plain, max(a, found[0] - budget), max(b, reach)) or found
            if found:
                yield number, found[0], found[1], found[2]
                before, explained = found[1], found[0] + budget

    @staticmethod
    def nearest(text: str, budget: int, forward: dict, backward: dict, plain: str, a: int, b: int) -> tuple[int, int, int] | None:
        """(start, end, distance) of the first exact or else the best occurrence between two places."""
        m = len(text)
        if (at := plain.find(text, a, b)) >= 0:
            return at, at + m, 0
        distance, end = myers(forward, m, plain[a:b])
        if distance > budget:
            return None
        end += a
        start = end - myers(backward, m, reversed(plain[max(a, end - m - budget) : end]), True)[1]
        return start, end, distance


@lru_cache(maxsize=2)
def _scanner(items: tuple, rate: float) -> Scanner:
    return Scanner(list(items), rate)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The items' ids and words, in blocks of about ``most`` characters; one block is on the driver at a time."""
    block, size = [], 0
    rows: Iterable[Row] = benchmark.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).toLocalIterator()
    for item_id, text in rows:
        if words := normalised(text or ""):
            block.append((item_id, words))
            size += len(words)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    out_col: str = "leaks",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the passages of benchmark items in each text: item, start, end (code points), distance."""
    docs = drop_names(docs, out_col)
    out = docs.withColumn(out_col, F.array().cast(LEAKS))
    for block in blocks(benchmark, item_id, item_text):
        own = free_name(out.columns, f"{out_col}_of_block")
        out = _scanned(out, docs.sparkSession.sparkContext.broadcast(tuple(block)), text_col, own, rate)
        out = out.withColumn(out_col, F.concat(F.col(out_col), F.col(own))).drop(own)
    return out if keep_text else out.drop(text_col)


def _scanned(docs: DataFrame, items, text_col: str, out_col: str, rate: float) -> DataFrame:
    at = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("decontamination", _scanner.cache_clear)
        scanner = _scanner(items.value, rate)
        for batch in batches:
            leaks = [
                [dict(zip(("item_id", "start", "end", "distance"), hit, strict=True)) for hit in scanner.scan(text)] if text else []
                for text in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks, _ARROW_LEAKS)], [*batch.schema.names, out_col])

    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(f"`{out_col}` {LEAKS}").fields])
    return docs.mapInArrow(scan, schema)


def q_decontamination(spark, sf_dir):
    """Every benchmark passage in every document: where it lies and how many edits it has."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_text=False)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
