"""Metric queries answered from stored summaries of a view.

A summary holds, at the grain of some dimensions and key columns, the parts that measures are made of: counts, sums,
minima and maxima. A query can be answered from it if every dimension it groups or filters by is stored, or is the month
of a stored date, and every measure can be put together from stored parts: parts are combined over the summary's rows,
a mean is its sum by its count, and a distinct count counts the stored keys. Everything else goes to the fact.

Columns are named after the expressions they hold, with ``current_date`` already replaced, so a summary of another
day, or of a view whose expressions changed, simply lacks the columns. A summary is as old as its last build.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.plans import expressions as ex
from forecourt.plans.metric_view import MetricView, _listed
from forecourt.plans.spec import FACT, Dimension, Measure

_SOURCE = "summary"
_MONTH = re.compile(r"trunc\((.+), 'MM'\)")


def _column(kind: str, text: str) -> str:
    return f"{kind}_{hashlib.md5(re.sub(r'\s+', ' ', text).strip().encode()).hexdigest()}"


@dataclass(frozen=True)
class Part:
    """One stored column: what it holds, and how rows of a summary are put together."""

    column: str
    expr: str
    combine: str  # sum, min, max, or key for a column the rows are grouped by


def _parts_of(call: ex.Aggregate) -> tuple[tuple[Part, ...], str] | None:
    """The parts an aggregate call needs and the expression that rebuilds it; None if it cannot be rebuilt."""
    where = f" FILTER (WHERE {call.filter})" if call.filter else ""
    if call.distinct:
        if call.function != "count" or call.filter or ex.split_arguments(call.argument) != [call.argument.strip()]:
            return None
        key = Part(_column("key", call.argument), call.argument, "key")
        return (key,), f"count(DISTINCT {FACT}.{key.column})"

    def part(function: str, combine: str) -> Part:
        text = f"{function}({call.argument}){where}"
        return Part(_column("part", text), text, combine)

    if call.function in ("count", "count_if"):
        own = part(call.function, "sum")
        return (own,), f"coalesce(sum({FACT}.{own.column}), 0)"
    if call.function in ("sum", "min", "max"):
        own = part(call.function, call.function)
        return (own,), f"{call.function}({FACT}.{own.column})"
    if call.function == "avg":
        total, n = part("sum", "sum"), part("count", "sum")
        return (total, n), f"(sum({FACT}.{total.column}) / nullif(sum({FACT}.{n.column}), 0))"
    return None


def _rebuilt(text: str) -> tuple[list[Part], str] | None:
    """Parts and rebuilt expression of a whole measure; None if any column lies outside a known aggregate."""
    parts: list[Part] = []
    out, end = [], 0
    for call in ex.aggregates(text):
        found = _parts_of(call)
        if found is None:
            return None
        parts += found[0]
        out += [text[end : call.start], found[1]]
        end = call.end
    outside = re.sub(rf"\b{FACT}\.(?:part|key)_\w+", "", "".join([*out, text[end:]]))
    if not parts or ex.qualified_columns(outside):
        return None
    return parts, "".join([*out, text[end:]])


@dataclass(frozen=True)
class Summary:
    """Rows of a stored summary; ``n`` is their number, by which the smallest fitting one is chosen."""

    view: MetricView
    rows: DataFrame
    n: int

    @classmethod
    def open(cls, spark: SparkSession, view: MetricView, path: str) -> Summary:
        rows = spark.read.parquet(path)
        return cls(view, rows, rows.count())


def build_summary(
    spark: SparkSession,
    view: MetricView,
    path: str,
    dims: Sequence[str],
    measures: Sequence[str],
    tables: Mapping[str, DataFrame] | None = None,
    as_of: dt.date | None = None,
) -> Summary:
    """Store the parts of ``measures`` by ``dims``, and by the keys that distinct counts among them need."""
    grouped = [view.resolve(d, view.dimensions, "dimension") for d in _listed(dims)]
    parts: dict[str, Part] = {}
    for asked in _listed(measures):
        measure = view.resolve(asked, view.measures, "measure")
        found = _rebuilt(ex.pin_today(view._measure_sql(measure), as_of))
        if found is None:
            raise ValueError(f"{measure.name!r} cannot be put together from stored parts")
        parts.update((p.column, p) for p in found[0])
    keys = [p for p in parts.values() if p.combine == "key"]
    kept = [p for p in parts.values() if p.combine != "key"]
    stored = MetricView(
        name=view.name,
        source=view.source,
        joins=view.joins,
        dimensions=(
            *(Dimension(_column("dim", ex.pin_today(d.expr, as_of)), d.expr, format=d.format) for d in grouped),
            *(Dimension(k.column, k.expr) for k in keys),
        ),
        measures=tuple(Measure(p.column, p.expr) for p in kept),
    )
    rows = stored.query(spark, [d.name for d in stored.dimensions], [m.name for m in stored.measures], tables=tables, as_of=as_of)
    rows.write.mode("overwrite").parquet(path)
    return Summary.open(spark, view, path)


def _over(summary: Summary, dims, measures, where, as_of) -> MetricView | None:
    """The view expressed over the summary's rows, or None if something asked for is not in it."""
    view, types = summary.view, dict(summary.rows.dtypes)

    def dimension(d: Dimension) -> Dimension | None:
        text = ex.pin_today(d.expr, as_of)
        if _column("dim", text) in types:
            return replace(d, expr=f"{FACT}.{_column('dim', text)}")
        month = _MONTH.fullmatch(text)
        if month and types.get(_column("dim", month[1])) == "date":
            return replace(d, expr=f"trunc({FACT}.{_column('dim', month[1])}, 'MM')")
        return None

    def measure(m: Measure) -> Measure | None:
        found = _rebuilt(ex.pin_today(view._measure_sql(m), as_of))
        if found is None or any(p.column not in types for p in found[0]):
            return None
        # Decimals widen with every sum and a mean has a scale of its own; these stay with the fact.
        if any(p.combine == "sum" and types[p.column].startswith("decimal") for p in found[0]):
            return None
        return replace(m, expr=found[1])

    known = {d.name: dimension(d) for d in view.dimensions}
    asked = [view.resolve(d, view.dimensions, "dimension").name for d in _listed(dims)]
    if where is not None:
        where = ex.renamed(where, view._dimension_name)
        asked += [d.name for d in view.dimensions if d.name in ex.names(where)]
        if ex.qualified_columns(where):
            return None
    wanted = [measure(view.resolve(m, view.measures, "measure")) for m in _listed(measures)]
    if None in wanted or any(known[name] is None for name in asked):
        return None
    return MetricView(
        name=view.name,
        source=_SOURCE,
        dimensions=tuple(d for d in known.values() if d is not None),
        measures=tuple(wanted),
    )


def query_from_summaries(
    spark: SparkSession,
    view: MetricView,
    summaries: Iterable[Summary],
    dims: Sequence[str] = (),
    measures: Sequence[str] = (),
    where: str | Column | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    as_of: dt.date | None = None,
    **options,
) -> DataFrame:
    """As ``view.query``, from the smallest summary that holds all that is asked, else from the fact.

    A filter given as a column cannot be looked into and goes to the fact.
    """
    for summary in sorted(summaries, key=lambda s: s.n):
        if summary.view != view or isinstance(where, Column):
            continue
        over = _over(summary, dims, measures, where, as_of)
        if over is not None:
            return over.query(spark, dims, measures, where, tables={_SOURCE: summary.rows}, as_of=as_of, **options)
    return view.query(spark, dims, measures, where, tables=tables, as_of=as_of, **options)
