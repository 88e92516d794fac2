"""Cheapest repair of conversations by depth-first branch-and-bound.

A repaired conversation's role initials read ``(s?(ua)+)?``. Edits of a row: Keep (0), Rerole to user or assistant (1), Delete (2,
required for blank and duplicate rows); Insert an empty user or assistant turn (5). A truncated row that is not deleted adds 5.
Among the cheapest edits, the one whose initials are least in ASCII counts.

``search`` walks prefixes of edits with an explicit stack. A prefix is cut off if its cost and the least that the
remaining rows can cost exceed the incumbent, or if a no worse prefix has reached the same node (row, state of the
grammar); the search ends when nothing is left on the stack, which proves the incumbent.

Conversations are dealt by id and sorted by turn in Spark and then streamed: a task holds one segment of rows and,
for each of the four states of the grammar at its end, the cheapest audit and the running SHA-256. So a conversation of any
length takes memory for its audit only. (The SHA-256 over a whole conversation makes one task read it; no form of that hash can
be split.) Which rows repeat earlier ones is remembered by the task for up to ``LONG`` rows; longer conversations get
it from a sort in Spark, so that hot ids hold no set in memory either.

Defined results: nulls in any column count as one space in texts, roles and hashed keys; null ids are one conversation; null
turns come first and count in no gap; rows of one turn are ordered by role and text after damage, so that equal rows
are adjacent; a row whose role has no initial s, u or a can't be kept; conversations without rows after damage have zeros,
an empty audit and the hash of the empty string. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = 32  # rows searched at a time; the search may take time exponential in it
LONG = 1 << 17  # rows of a conversation up to which a task remembers all of them
CACHED = 1 << 14  # segments whose edits a worker remembers

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
# States of the grammar: nothing yet, after s, after u, after a. What u, a and s lead to.
STATES = range(4)
AFTER = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ENDS = (0, 3)

Found = dict[int, tuple[int, str]]  # by end state: cost and audit


def least_costs(rows: str) -> list[int]:
    """For each position, the least that the rows from there on can cost, whatever the state."""
    out = [0]
    for row in reversed(rows):
        out.append(out[-1] + (DELETE if row in "xSUAO" else KEEP if row in "sua" else REROLE))
    return out[::-1]


def search(rows: str, start: int, last: bool) -> Found:
    """The least (cost, audit) from a state to each state behind the rows, or to the end of the conversation.

    A row is its role's initial or ``o``; capital if truncated; ``x`` if it must go. Insertions stand before a row or, in
    the last segment, at its end; so no audit between two states begins another of the same cost.
    """
    n, bound = len(rows), least_costs(rows)
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    best: Found = {}
    ends = 1 if last else len(STATES)
    stack = [(0, "", 0, start)]
    while stack:
        cost, audit, at, state = stack.pop()
        if len(best) == ends:
            least = cost + bound[at]
            if all((least, audit) > (c, a[: len(audit)]) for c, a in best.values()):
                continue
        known = reached.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[at, state] = (cost, audit)
        if at == n and (not last or state in ENDS):
            end = ENDS[-1] if last else state
            if end not in best or (cost, audit) < best[end]:
                best[end] = (cost, audit)
        # Pushed last and so taken first: what costs least, so that the first descent finds a good incumbent.
        if at < n or last:
            stack.append((cost + INSERT, audit + "I", at, AFTER[NEXT[state]][state]))
        if at < n:
            row = rows[at]
            free = row != "x"
            extra = TRUNCATED if row.isupper() else 0
            cut = (cost + DELETE, audit + "D", at + 1, state)
            if not extra:
                stack.append(cut)
            if free:
                stack.append((cost + REROLE + extra, audit + "R", at + 1, AFTER[NEXT[state]][state]))
                follow = AFTER.get(row.lower(), {}).get(state)
                if follow is not None:
                    stack.append((cost + KEEP + extra, audit + "K", at + 1, follow))
            if extra:
                stack.append(cut)
    return best


searched = lru_cache(CACHED)(search)


class Repair:
    """One conversation, fed row by row in order; ``result`` ends it."""

    def __init__(self, segment: int = SEGMENT):
        self.segment = segment
        self.rows: list[tuple[str, str, str]] = []  # search letter, role, text
        # By state, the cheapest edits so far: cost, rank of their audit among the states', audit as a chain, running hash.
        self.ends = {0: (0, 0, None, None)}
        self.seen: set[bytes] = set()
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.before = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool | None) -> None:
        """The next row after damage; ``repeated`` is None where this object is to find out itself."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if repeated is None:
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            repeated = key in self.seen
            self.seen.add(key)
        bare = text.rstrip(BLANKS)
        letter = initial if initial in ("s", "u", "a") else "o"
        if not bare:
            self.blank += 1
            letter = "x"
        elif repeated:
            self.duplicate += 1
            letter = "x"
        elif bare[-1] not in ".!?":
            self.truncated += 1
            letter = letter.upper()
        self.rows.append((letter, role, text))
        if len(self.rows) > self.segment:  # at least one row stays for the last segment
            self._close(self.rows[: self.segment], last=False)
            self.rows = self.rows[self.segment :]

    def _close(self, rows: list[tuple[str, str, str]], last: bool) -> None:
        letters = "".join(letter for letter, _, _ in rows)
        ways: dict[int, tuple[int, int, str, int]] = {}
        for start, (cost, rank, _, _) in self.ends.items():
            for end, (more, edits) in searched(letters, start, last).items():
                way = (cost + more, rank, edits, start)
                if end not in ways or way < ways[end]:
                    ways[end] = way
        ranks = {end: i for i, end in enumerate(sorted(ways, key=lambda e: ways[e][1:3]))}
        self.ends = {
            end: (cost, ranks[end], (self.ends[start][2], edits), self._hashed(rows, start, edits))
            for end, (cost, _, edits, start) in ways.items()
        }

    def _hashed(self, rows: list[tuple[str, str, str]], state: int, edits: str):
        hasher, left, out = self.ends[state][3], iter(rows), []
        for edit in edits:
            if edit == "I":
                role, text = {"u": "user", "a": "assistant"}[NEXT[state]], ""
            else:
                _, role, text = next(left)
                if edit == "D":
                    continue
                if edit == "R":
                    role = {"u": "user", "a": "assistant"}[NEXT[state]]
            state = AFTER[role[0]][state]
            out.append(f"{role}:{text}".encode())
        if not out:
            return hasher
        fresh = hasher is None
        hasher = hashlib.sha256() if fresh else hasher.copy()
        hasher.update((b"" if fresh else b"\n") + b"\n".join(out))
        return hasher

    def result(self) -> tuple:
        self._close(self.rows, last=True)
        cost, _, chain, hasher = self.ends[ENDS[-1]]
        parts = []
        while chain:
            chain, edits = chain
            parts.append(edits)
        audit = "".join(reversed(parts))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        digest = (hasher or hashlib.sha256()).hexdigest()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: rows after damage, and how often each stands there (0: dropped)."""
    text, role = _or_blank("text"), _or_blank("role")
    kind = F.crc32(F.concat(_or_blank("conv_id"), F.lit(":"), _or_blank("turn"))) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def with_repeats(rows: DataFrame, long: int = LONG) -> DataFrame:
    """With ``repeated``: whether an earlier row has the same role and text; null in conversations of at most ``long`` rows."""
    sizes = rows.groupBy("conv_id").count().filter(F.col("count") > long).select(F.col("conv_id").alias("id"))
    if sizes.isEmpty():
        return rows.withColumn("repeated", F.lit(None).cast("boolean"))
    same = F.col("conv_id").eqNullSafe(F.col("id"))
    short = rows.join(sizes, same, "left_anti").withColumn("repeated", F.lit(None).cast("boolean"))
    first = F.min(F.struct(F.col("turn").isNotNull().alias("t"), "turn")).alias("first")
    text = F.sha2("text", 256)
    hot = rows.join(sizes, same, "left_semi").withColumn("h", text)
    # Rows that are alike down to the turn become one row with a number of times, before ids of any size are compared.
    alike = hot.groupBy("conv_id", "turn", "role", "h").agg(F.first("text").alias("text"), F.sum("times").cast("int").alias("times"))
    firsts = alike.filter("times > 0").groupBy("conv_id", "role", "h").agg(first)
    firsts = firsts.select(*(F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "h")), "first")
    found = alike.join(
        firsts,
        F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("h") == F.col("f_h")),
        "left",
    )
    later = F.coalesce(F.col("first") != F.struct(F.col("turn").isNotNull().alias("t"), "turn"), F.lit(False))
    return short.unionByName(found.select(*rows.columns, later.alias("repeated")))


def repair_conversations(rows: DataFrame, segment: int = SEGMENT, long: int = LONG) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text as they are after damage; ``times`` if they have it)."""
    if "times" not in rows.columns:
        rows = rows.select("conv_id", "turn", _or_blank("role").alias("role"), _or_blank("text").alias("text"), F.lit(1).alias("times"))
    rows = with_repeats(rows, long).withColumn("turn", F.col("turn").cast("long"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string"

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, ids, results = Repair(segment), None, [], []
        started = False

        def batch_of(ids: list, results: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*results, strict=True)]
            arrays = [pa.array(c, pa.int64()) for c in columns[:-2]] + [pa.array(c, pa.string()) for c in columns[-2:]]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_arrow), *arrays], ["conv_id", *COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            id_arrow = batch.schema.field("conv_id").type
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "times", "repeated"))
            for conv, turn, role, text, times, repeated in zip(*columns, strict=True):
                if not started or conv != own:
                    if started:
                        ids.append(own)
                        results.append(current.result())
                    current, own, started = Repair(segment), conv, True
                for again in range(times):
                    current.add(turn, role, text, repeated if repeated is None else repeated or again > 0)
            if len(ids) >= 1000:
                yield batch_of(ids, results)
                ids, results = [], []
        if started:
            yield batch_of([*ids, own], [*results, current.result()])

    return ordered.mapInArrow(repaired, schema)


def q_conversation_repair(spark, sf_dir):
    """Every conversation's faults after damage, and its cheapest repair."""
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
