"""Masks for personal data as column expressions. NULL stays NULL.

Open-source Spark has no session groups, so whether the reader is privileged is
an argument, decided by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIN_LENGTH = 17


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def mask_name(column: str | Column) -> Column:
    """As many asterisks as there are characters."""
    value = _col(column)
    return F.repeat(F.lit("*"), F.length(value))


def mask_phone(column: str | Column) -> Column:
    """Digits before the last four characters hidden; up to four characters are hidden whole."""
    value = _col(column)
    hidden = F.regexp_replace(F.left(value, F.length(value) - 4), F.lit("[0-9]"), F.lit("*"))
    return F.when(F.length(value) <= 4, F.repeat(F.lit("*"), F.length(value))).otherwise(
        F.concat(hidden, F.right(value, F.lit(4)))
    )


def mask_vin(column: str | Column) -> Column:
    """Seventeen asterisks, whatever the length, so that not even that shows."""
    return F.when(_col(column).isNotNull(), F.lit("*" * VIN_LENGTH))


def mask_plate(column: str | Column) -> Column:
    """Every character hidden."""
    return mask_name(column)


Mask = Callable[[str | Column], Column]

CUSTOMER_MASKS: Mapping[str, Mask] = {"name": mask_name, "phone": mask_phone}
VEHICLE_MASKS: Mapping[str, Mask] = {"vin": mask_vin, "plate_number": mask_plate}


def apply_masks(df: DataFrame, masks: Mapping[str, Mask], privileged: bool = False) -> DataFrame:
    """``df`` as a reader sees it: unchanged if privileged, else with the named columns masked."""
    return df if privileged else df.withColumns({name: mask(name) for name, mask in masks.items()})
