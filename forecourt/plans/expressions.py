"""Small text helpers over SQL expressions; Spark itself parses and checks them."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

# String literals are matched first so that nothing inside them is touched.
_LITERAL = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\""
_MEASURE = re.compile(rf"({_LITERAL})|\bMEASURE\s*\(\s*(?:`([^`]+)`|(\w+))\s*\)", re.I)
_TODAY = re.compile(rf"({_LITERAL}|`[^`]*`)|(?<![\w.])current_date\b(?:\s*\(\s*\))?", re.I)
_QUALIFIED = re.compile(rf"({_LITERAL})|(?<![\w.`])(?:`([^`]+)`|(\w+))\s*\.\s*(?:`([^`]+)`|(\w+))")
_NAME = re.compile(rf"({_LITERAL})|`([^`]+)`|(\w+)")


def expand_measures(expr: str, lookup: Callable[[str], str], _open: tuple[str, ...] = ()) -> str:
    """Replace each ``MEASURE(name)`` by the stored expression, in parentheses, all the way down."""

    def replace(found: re.Match) -> str:
        if found[1]:
            return found[1]
        name = found[2] or found[3]
        if name in _open:
            raise ValueError("measures refer to each other in a circle: " + " > ".join((*_open, name)))
        return "(" + expand_measures(lookup(name), lookup, (*_open, name)) + ")"

    return _MEASURE.sub(replace, expr)


def pin_today(expr: str, as_of: dt.date | None) -> str:
    """Replace ``current_date`` by a fixed day, for repeatable results."""
    if as_of is None:
        return expr
    return _TODAY.sub(lambda found: found[1] or f"DATE'{as_of.isoformat()}'", expr)


def qualified_columns(expr: str) -> set[tuple[str, str]]:
    """``(alias, column)`` pairs written as ``alias.column``; the alias is case-folded."""
    return {
        ((m[2] or m[3]).casefold(), m[4] or m[5]) for m in _QUALIFIED.finditer(expr) if not m[1]
    }


def names(expr: str) -> set[str]:
    """Every identifier-like word outside string literals."""
    return {m[2] or m[3] for m in _NAME.finditer(expr) if not m[1]}


def renamed(expr: str, name: Callable[[str], str]) -> str:
    """``expr`` with each backticked identifier that stands alone replaced by ``name`` of it."""

    def replace(found: re.Match) -> str:
        if found[1] or found[2] is None:
            return found[0]
        beside = expr[found.start() - 1 : found.start()], expr[found.end() : found.end() + 1]
        return found[0] if "." in beside else f"`{name(found[2])}`"

    return _NAME.sub(replace, expr)


_COMPARED = re.compile(r"`([^`]+)`\s*(=|>=|<=|>|<)\s*DATE\s*'(\d{4}-\d{2}-\d{2})'", re.I)


def date_comparisons(expr: str) -> list[tuple[str, str, dt.date]]:
    """Comparisons of a backticked name with a date that every row meeting ``expr`` must meet.

    They must be joined by AND at the top level; anything else in the text gives none.
    """
    found = []
    for part in re.split(r"\bAND\b", expr, flags=re.I):
        if match := _COMPARED.fullmatch(part.strip()):
            found.append((match[1], match[2], dt.date.fromisoformat(match[3])))
        elif re.search(r"\b(?:OR|NOT|BETWEEN|CASE)\b|[()'\"]", _PLAIN.sub("", part), re.I):
            return []
    return found


# What may stand beside: one comparison of a name with a literal.
_PLAIN = re.compile(rf"(?:`[^`]+`|[\w.]+)\s*(?:=|<>|!=|>=|<=|>|<)\s*(?:DATE\s*)?(?:{_LITERAL}|[\w.]+)", re.I)


def aliases_used(exprs: Iterable[str], aliases: Iterable[str]) -> set[str]:
    """Aliases mentioned anywhere in the texts; a mention in any role counts as use."""
    mentioned = {name.casefold() for expr in exprs for name in names(expr)}
    return {alias for alias in aliases if alias.casefold() in mentioned}


@dataclass(frozen=True)
class Aggregate:
    """An aggregate call within an expression and where it stands."""

    start: int
    end: int
    function: str
    argument: str
    distinct: bool = False
    filter: str | None = None


_CALL = re.compile(rf"({_LITERAL}|`[^`]*`)|(?<![\w.])(count_if|count|sum|avg|min|max)\s*\(", re.I)
_BRACKET = re.compile(rf"{_LITERAL}|`[^`]*`|[(),]")
_FILTER = re.compile(r"\s*FILTER\s*\(\s*WHERE\b", re.I)


def _closing(expr: str, start: int) -> int:
    """Where the bracket opened just before ``start`` is closed."""
    depth = 1
    for found in _BRACKET.finditer(expr, start):
        depth += {"(": 1, ")": -1}.get(found[0], 0)
        if depth == 0:
            return found.start()
    raise ValueError(f"a bracket is not closed: {expr!r}")


def aggregates(expr: str) -> list[Aggregate]:
    """The calls of known aggregates in ``expr``, in order; nothing inside another call."""
    found, at = [], 0
    while call := _CALL.search(expr, at):
        if call[1]:
            at = call.end()
            continue
        close = _closing(expr, call.end())
        argument, end, condition = expr[call.end() : close].strip(), close + 1, None
        if own := _FILTER.match(expr, end):
            last = _closing(expr, own.end())
            condition, end = expr[own.end() : last].strip(), last + 1
        distinct = re.match(r"DISTINCT\b\s*", argument, re.I)
        if distinct:
            argument = argument[distinct.end() :]
        found.append(Aggregate(call.start(), end, call[2].lower(), argument, bool(distinct), condition))
        at = end
    return found


def split_arguments(text: str) -> list[str]:
    """The arguments of a call, cut at commas outside brackets and literals."""
    out, depth, start = [], 0, 0
    for found in _BRACKET.finditer(text):
        depth += {"(": 1, ")": -1}.get(found[0], 0)
        if found[0] == "," and depth == 0:
            out.append(text[start : found.start()].strip())
            start = found.end()
    return [*out, text[start:].strip()]
