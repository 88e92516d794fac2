"""Where patterns match, as DataFrame expressions: spans in code points, without Python.

Patterns are written so that Java's engine takes linear time on any text: a run is entered only at its start
(look-behind) and never given back (possessive), which leaves leftmost non-overlapping matches as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start: bigint, end: bigint, value: string>>"
CHUNK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def no_spans() -> Column:
    return F.array().cast(SPANS)


def folded(items: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of ``items`` (structs of the text before a match, ``gap``, and the match, ``value``).

    Matches are folded in chunks, so that the work grows with their number, not with its square.
    """

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        own = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        out = F.concat(acc["out"], own)
        if keep is not None:
            out = F.when(keep(x["value"]), out).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def state(at: Column, out: Column) -> Column:
        return F.struct(at.cast("bigint").alias("at"), out.alias("out"))

    def chunk(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, state(acc["at"], no_spans()), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(acc["out"], i["out"]).alias("out")))

    def whole(all_items: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / CHUNK).cast("int"))
        parts = F.transform(numbers, lambda i: F.slice(all_items, i * CHUNK + 1, F.lit(CHUNK)))
        return F.aggregate(parts, state(F.lit(0), no_spans()), chunk, lambda acc: acc["out"])

    return let(items, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(no_spans()))


def found_spans(text: Column, pattern: str, gate: Column | None = None, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the pattern's matches that ``keep`` accepts; ``gate`` says cheaply which texts can have any."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    items = let(gaps, lambda g: F.transform(values, lambda v, i: F.struct(F.get(g, i).alias("gap"), v.alias("value"))))
    spans = folded(items, keep)
    return spans if gate is None else F.when(gate, spans).otherwise(no_spans())


def listed(spans: Column, kind: str) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
