"""Display formats as column expressions; all of them keep NULL as NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(column: str | Column, fmt) -> Column:
    """``column`` as display text, or unchanged where no format is declared."""
    value = F.col(column) if isinstance(column, str) else column
    if fmt is None:
        return value
    if fmt.kind == "date":
        return F.date_format(value, "yyyy-M-d")
    if fmt.kind == "percentage":
        return F.concat(F.format_number(value * 100, fmt.places), F.lit("%"))
    return F.format_number(value, fmt.places)
