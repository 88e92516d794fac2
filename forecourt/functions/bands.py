"""SQL expression texts for banded values and month starts."""

from __future__ import annotations

from collections.abc import Iterable


def band(value: str, edges: Iterable[tuple[object, str]], beyond: str, op: str = "<=") -> str:
    """Label ``value`` by the first edge it satisfies; NULL and the rest are ``beyond``."""
    whens = " ".join(f"WHEN {value} {op} {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE {whens} ELSE '{beyond}' END"


def month_start(date: str) -> str:
    """First day of the month, as DATE (``date_trunc`` would give a timestamp)."""
    return f"trunc({date}, 'MM')"


def share(condition: str) -> str:
    """Share of rows meeting ``condition``; NULL on an empty group."""
    return f"count_if({condition}) / nullif(count(1), 0)"
