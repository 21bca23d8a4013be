"""Numeric column expressions with explicit null rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import col


def nan_to_null(value: str | Column) -> Column:
    value = col(value)
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def raise_to(value: str | Column, floor: float) -> Column:
    """Lower clip; a missing value stays missing (``greatest`` would replace it)."""
    value = col(value)
    return F.when(value < F.lit(float(floor)), F.lit(float(floor))).otherwise(value)


def cap_at(value: str | Column, ceiling: float) -> Column:
    value = col(value)
    return F.when(value > F.lit(float(ceiling)), F.lit(float(ceiling))).otherwise(value)


def magnitude_cell(value: str | Column, steps: int = 65536) -> Column:
    """Order-preserving BIGINT cell of a double: ``steps`` linear steps inside each power of two.

    A pure function of the value, so a re-run task always agrees with the first run, and a
    group spreads over thousands of cells whatever its size. Equal values share a cell.
    """
    v = col(value).cast("double")
    size = F.abs(v)
    power = F.floor(F.log2(size))
    inside = F.floor(size / F.pow(F.lit(2.0), power) * steps)
    magnitude = (power + 1100) * steps + inside
    top = F.lit(3000 * steps).cast("bigint")
    magnitude = F.when(size > F.lit(8e307), top).otherwise(magnitude)
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, magnitude).otherwise(-magnitude)


def decimals_of(step: float) -> int:
    """Decimal places kept for a cell size: only its power of ten counts (0.05 keeps one)."""
    return abs(int(round(-math.log10(step), 0)))
