"""All registered queries."""

from . import aggregates, cleaning, forecasts, grids, quality, splits, tables  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
