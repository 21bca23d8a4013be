"""Attribute and weather joins.

No broadcast hints: Spark broadcasts a table whose file size is under its threshold and
otherwise runs a sort-merge join, where AQE splits the partitions of a hot sensor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ATTRIBUTES = ("lanes", "lon", "lat", "pos", "length", "fclass")


def with_detectors(
    df: DataFrame, detectors: DataFrame, key: str = "detid", columns: Sequence[str] = ATTRIBUTES, how: str = "left"
) -> DataFrame:
    """Adds the chosen detector attributes. Repeated keys in ``detectors`` multiply rows; see ``first_per_key``."""
    return df.join(detectors.select(key, *columns), key, how)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order; at most one row per key and task is shuffled."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_weather(df: DataFrame, weather: DataFrame, on: Sequence[str] = ("day", "interval_s")) -> DataFrame:
    """Inner join on day and interval, so a reading meets the weather of its own day only."""
    return df.join(weather, list(on))


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not listed. An anti join: rows without a key stay, unlike with NOT IN."""
    return df.join(keys.select(on), on, "left_anti")
