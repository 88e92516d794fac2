"""The metric-view specification: a fact, its dimensions tables, grouping candidates and measures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

VERSION = "1.1"
FACT = "source"  # how expressions refer to the fact table


@dataclass(frozen=True)
class Format:
    """How a column is displayed: a number, a percentage or a date."""

    kind: str
    places: int = 0

    def __post_init__(self):
        if self.kind not in ("number", "percentage", "date"):
            raise ValueError(f"unknown format type {self.kind!r}")

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Format:
        kind = _required(raw, "type", "format")
        if kind == "date":
            if raw.get("date_format", "year_month_day") != "year_month_day":
                raise ValueError(f"unknown date format {raw['date_format']!r}")
            return cls("date")
        decimals = raw.get("decimal_places", {})
        if decimals.get("type", "exact") != "exact":
            raise ValueError(f"unknown decimal places {decimals['type']!r}")
        return cls(kind, int(decimals.get("places", 0)))


@dataclass(frozen=True)
class Field:
    """A dimension or a measure: a name and the SQL expression behind it."""

    name: str
    expr: str
    synonyms: tuple[str, ...] = ()
    format: Format | None = None
    display_name: str | None = None
    comment: str | None = None

    @property
    def labels(self) -> set[str]:
        """Every text a caller may use for this field, case-folded."""
        return {t.casefold() for t in (self.name, self.display_name, *self.synonyms) if t}

    @property
    def metadata(self) -> dict[str, Any]:
        """Column metadata carried on the result frame."""
        entries = {
            "display_name": self.display_name or self.name,
            "synonyms": list(self.synonyms),
            "comment": self.comment,
            "format": self.format and self.format.kind,
        }
        if self.format and self.format.kind != "date":
            entries["decimal_places"] = self.format.places
        return {key: value for key, value in entries.items() if value or value == 0}

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Field:
        shown = raw.get("format")
        return cls(
            name=_required(raw, "name", "field"),
            expr=str(_required(raw, "expr", "field")),
            synonyms=tuple(str(s) for s in raw.get("synonyms", ())),
            format=Format.from_dict(shown) if shown else None,
            display_name=raw.get("display_name"),
            comment=raw.get("comment"),
        )


class Dimension(Field):
    """A grouping candidate."""


class Measure(Field):
    """An aggregate evaluated at the grain of the query."""


@dataclass(frozen=True)
class Join:
    """A many-to-one join from the fact to a dimension table, referred to by ``name``."""

    name: str
    source: str
    on: str

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Join:
        # YAML 1.1 reads a bare `on` key as the boolean true.
        condition = raw.get("on", raw.get(True))
        if not condition:
            raise ValueError("join is missing 'on'")
        return cls(_required(raw, "name", "join"), _required(raw, "source", "join"), condition)


def _required(raw: Mapping[str, Any], key: str, what: str) -> Any:
    value = raw.get(key)
    if value in (None, "", [], ()):
        raise ValueError(f"{what} is missing {key!r}")
    return value


def check(version: str, joins, dimensions, measures) -> None:
    """Refuse a specification whose version is unknown or whose names clash."""
    if str(version) != VERSION:
        raise ValueError(f"version {version!r} is not supported, expected {VERSION!r}")
    aliases = [FACT, *(j.name for j in joins)]
    for group in (aliases, aliases + [f.name for f in (*dimensions, *measures)]):
        seen: set[str] = set()
        for name in group:
            if name.casefold() in seen:
                raise ValueError(f"name {name!r} is used twice")
            seen.add(name.casefold())
