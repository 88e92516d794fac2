"""Metric views: declare a fact, joins, dimensions and measures once, group them freely later.

``MetricView.query`` turns names chosen at query time into one ordinary Spark
plan: fact LEFT JOIN dimension tables, computed dimensions, filter, group,
aggregate, sort. Spark optimises and runs it; nothing is evaluated here.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from fnmatch import fnmatchcase
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.display import shown
from forecourt.operators.joins import BROADCAST_BYTES, broadcast_if_small
from forecourt.operators.quality import check_pk
from forecourt.plans import expressions as ex
from forecourt.plans.spec import FACT, Dimension, Field, Join, Measure, VERSION, _required, check


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    joins: tuple[Join, ...] = ()
    comment: str | None = None
    version: str = VERSION

    def __post_init__(self):
        check(self.version, self.joins, self.dimensions, self.measures)
        for measure in self.measures:
            self._measure_sql(measure)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any], name: str = "metric_view") -> MetricView:
        return cls(
            name=name,
            version=str(_required(raw, "version", "metric view")),
            source=_required(raw, "source", "metric view"),
            joins=tuple(Join.from_dict(j) for j in raw.get("joins") or ()),
            dimensions=tuple(
                Dimension.from_dict(d) for d in _required(raw, "dimensions", "metric view")
            ),
            measures=tuple(Measure.from_dict(m) for m in _required(raw, "measures", "metric view")),
            comment=raw.get("comment"),
        )

    @classmethod
    def from_yaml(cls, text: str, name: str = "metric_view") -> MetricView:
        try:
            import yaml
        except ImportError as missing:  # the dictionary form needs no extra package
            raise RuntimeError("from_yaml needs PyYAML; use from_dict instead") from missing
        return cls.from_dict(yaml.safe_load(text), name)

    def extend(self, *fields: Field) -> MetricView:
        """The same view with further dimensions or measures."""
        return replace(
            self,
            dimensions=self.dimensions + tuple(f for f in fields if isinstance(f, Dimension)),
            measures=self.measures + tuple(f for f in fields if isinstance(f, Measure)),
        )

    # -- names -------------------------------------------------------------

    def resolve(self, asked: str, among: Sequence[Field], kind: str) -> Field:
        """The field called ``asked`` by name, display name or synonym."""
        listing = f"; {kind}s: {', '.join(f.name for f in among)}"
        if asked == "*":
            raise ValueError(f"'*' is not supported, list the {kind}s{listing}")
        exact = [f for f in among if f.name == asked]
        hits = exact or [f for f in among if asked.casefold() in f.labels]
        if not hits:
            raise ValueError(f"unknown {kind} {asked!r}{listing}")
        if len(hits) > 1:
            raise ValueError(f"{asked!r} is ambiguous: {', '.join(f.name for f in hits)}")
        return hits[0]

    def _measure_sql(self, measure: Measure) -> str:
        by_name = {m.name: m.expr for m in self.measures}

        def lookup(name: str) -> str:
            if name not in by_name:
                raise ValueError(f"{measure.name!r} refers to unknown measure {name!r}")
            return by_name[name]

        return ex.expand_measures(measure.expr, lookup, (measure.name,))

    # -- plan --------------------------------------------------------------

    def needed_joins(self, exprs: Iterable[str]) -> list[Join]:
        """Joins whose alias is mentioned, plus the joins their conditions depend on.

        Leaving the others out cannot change a result as long as dimension keys
        are unique (see ``validate``), because the joins are LEFT OUTER.
        """
        aliases = [j.name for j in self.joins]
        used = ex.aliases_used(exprs, aliases)
        while True:
            wider = used | ex.aliases_used((j.on for j in self.joins if j.name in used), aliases)
            if wider == used:
                return [j for j in self.joins if j.name in used]
            used = wider

    def _base(self, spark, tables, joins: Sequence[Join], texts, broadcast_bytes) -> DataFrame:
        """Fact and dimension rows side by side, one struct column per table.

        Structs keep ``source.x`` and ``store.x`` apart from dimension names;
        the optimiser removes them again and reads only the fields in use.
        ``texts`` are all expressions of the query, or None if some are unknown.
        """
        named = [
            pair
            for text in (*(texts or ()), *(j.on for j in joins))
            for pair in ex.qualified_columns(text)
        ]
        sides = {}
        for join in joins:
            table = find_table(spark, tables, join.source)
            used = {column.casefold() for alias, column in named if alias == join.name.casefold()}
            kept = [f"`{c}`" for c in table.columns if texts is None or c.casefold() in used]
            sides[join.name] = table.select(*kept)
        sides = broadcast_if_small(sides, broadcast_bytes)
        rows = find_table(spark, tables, self.source).select(F.struct("*").alias(FACT))
        for join in joins:
            side = sides[join.name].select(F.struct("*").alias(join.name))
            rows = rows.join(side, F.expr(join.on), "left")
        return rows

    def query(
        self,
        spark: SparkSession,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: str | Column | None = None,
        order_by: Sequence[str | tuple[str, str]] = (),
        limit: int | None = None,
        tables: Mapping[str, DataFrame] | None = None,
        as_of: dt.date | None = None,
        formatted: bool = False,
        prune: bool = True,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """Measures grouped by dimensions, both chosen by name.

        ``where`` filters on dimensions before aggregation, by name or, in
        backticks, by any label. Comparisons of a month dimension with a date are
        also passed on as a range of its date, which a scan can use. ``order_by``
        takes names or ``(name, "asc" | "desc")``; a limited result is also
        ordered by its dimensions so that it is the same on every run. Display
        formats are applied last and never affect the order. Dimension tables
        measured within ``broadcast_bytes`` are broadcast; 0 skips the measuring.
        """
        grouped = [self.resolve(d, self.dimensions, "dimension") for d in _listed(dims)]
        wanted = [self.resolve(m, self.measures, "measure") for m in _listed(measures)]
        if not grouped and not wanted:
            raise ValueError("name at least one dimension or measure")

        filtered_on: list[Field] = list(self.dimensions) if where is not None else []
        if isinstance(where, str):
            where = ex.renamed(where, self._dimension_name)
            mentioned = ex.names(where)
            filtered_on = [d for d in self.dimensions if d.name in mentioned]
        computed = list(dict.fromkeys([*grouped, *filtered_on]))

        dim_sql = {d: ex.pin_today(d.expr, as_of) for d in computed}
        measure_sql = {m: ex.pin_today(self._measure_sql(m), as_of) for m in wanted}
        texts = [*dim_sql.values(), *measure_sql.values()]
        if isinstance(where, str):
            where = ex.pin_today(where, as_of)
            texts.append(where)

        joins = self.needed_joins(texts) if prune else self.joins
        known = tables if tables is not None else {}
        all_texts = None if isinstance(where, Column) else texts
        rows = self._base(spark, known, joins, all_texts, broadcast_bytes)
        rows = rows.withColumns({d.name: _typed(d, F.expr(sql)) for d, sql in dim_sql.items()})
        if where is not None:
            rows = rows.filter(where)
        if isinstance(where, str):
            rows = self._with_date_ranges(rows, where)

        keys = [F.col(f"`{d.name}`") for d in grouped]
        if wanted:
            result = rows.groupBy(*keys).agg(
                *(F.expr(sql).alias(m.name) for m, sql in measure_sql.items())
            )
        else:
            result = rows.select(*keys).distinct()

        result = self._sorted(result, grouped, wanted, order_by, limit)
        return result.select(
            *(
                (shown(f"`{f.name}`", f.format) if formatted else F.col(f"`{f.name}`")).alias(
                    f.name, metadata=f.metadata
                )
                for f in (*grouped, *wanted)
            )
        )

    def _dimension_name(self, asked: str) -> str:
        """The name of the dimension called ``asked``; other identifiers as they are."""
        if any(d.name == asked for d in self.dimensions):
            return asked
        hits = [d.name for d in self.dimensions if asked.casefold() in d.labels]
        return hits[0] if len(hits) == 1 else asked

    def _with_date_ranges(self, rows: DataFrame, where: str) -> DataFrame:
        """``rows`` also filtered by what month comparisons imply for the date below.

        A month start m that is at least some day has all its dates at or after that day; one that is at
        most some day has them before the end of that day's month.
        """
        months = {
            d.name: found[1]
            for d in self.dimensions
            if (found := re.fullmatch(r"trunc\(([\w.`]+), 'MM'\)", d.expr))
        }
        for name, comparison, day in ex.date_comparisons(where):
            if name not in months:
                continue
            if comparison in ("=", ">", ">="):
                rows = rows.filter(f"{months[name]} >= DATE'{day}'")
            if comparison in ("=", "<", "<="):
                index = day.year * 12 + day.month
                following = dt.date(index // 12, index % 12 + 1, 1)
                rows = rows.filter(f"{months[name]} < DATE'{following}'")
        return rows

    def _sorted(self, result, grouped, wanted, order_by, limit) -> DataFrame:
        output = [*grouped, *wanted]
        keys, used = [], set()
        for item in order_by:
            asked, direction = (item, "asc") if isinstance(item, str) else item
            field = self.resolve(asked, output, "output column")
            if direction.lower() not in ("asc", "desc"):
                raise ValueError(f"unknown sort direction {direction!r}")
            column = F.col(f"`{field.name}`")
            keys.append(column.desc() if direction.lower() == "desc" else column.asc())
            used.add(field.name)
        if limit is not None:
            keys += [F.col(f"`{d.name}`").asc() for d in grouped if d.name not in used]
        if keys:
            result = result.orderBy(*keys)
        return result if limit is None else result.limit(limit)

    # -- checks ------------------------------------------------------------

    def validate(self, spark: SparkSession, tables: Mapping[str, DataFrame] | None = None):
        """Join keys that occur more than once on a dimension side, as (join, key, n).

        Any row here would inflate every measure that uses the join.
        """
        known = tables if tables is not None else {}
        found = []
        for join in self.joins:
            keys = sorted(
                column
                for alias, column in ex.qualified_columns(join.on)
                if alias == join.name.casefold()
            )
            duplicates = check_pk(find_table(spark, known, join.source), keys)
            found.append(
                duplicates.filter("n > 1").select(
                    F.lit(join.name).alias("join"),
                    F.to_json(F.struct(*keys)).alias("key"),
                    "n",
                )
            )
        if not found:
            return spark.createDataFrame([], "join string, key string, n long")
        return reduce(DataFrame.unionByName, found)


def _listed(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(dict.fromkeys(names))


def _typed(dimension: Field, column: Column) -> Column:
    """A date-formatted dimension is a DATE even if its expression gives a timestamp."""
    is_date = dimension.format is not None and dimension.format.kind == "date"
    return column.cast("date") if is_date else column


def find_table(spark: SparkSession, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """``name`` among the given frames, by full or last name part, else in the session catalog."""
    for candidate in (name, name.split(".")[-1].strip("`")):
        try:
            return tables[candidate]
        except KeyError:
            continue
    return spark.table(name)


def list_views(views: Iterable[MetricView], pattern: str = "*") -> list[MetricView]:
    """The views whose name matches a ``*`` pattern."""
    return [view for view in views if fnmatchcase(view.name, pattern)]
