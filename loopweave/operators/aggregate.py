"""Aggregates and report tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import keyed


def hourly_mean(
    df: DataFrame,
    keys: Sequence[str] = ("interval_s", "day", "detid", "weekday"),
    interval: str = "interval_s",
    means: Sequence[str] = ("traffic", "flow", "occ"),
    ratio: int = 3600,
) -> DataFrame:
    """Means per key after rounding the interval half-even to multiples of ``ratio``."""
    rounded = df.withColumn(interval, cal.bucket_half_even(interval, ratio))
    return rounded.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in means])


def value_counts(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per value (and key); missing values are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))


def summary(df: DataFrame, column: str = "traffic", keys: Sequence[str] = ()) -> DataFrame:
    """min, mean, mode of the rounded value (smallest on a tie) and max, per key.

    Rows are first combined per (key, rounded value), so a frequent value or a large key
    arrives at the second step as a few rows.
    """
    df, group = keyed.with_key(df, keys)
    per_value = (
        df.where(F.col(column).isNotNull())
        .groupBy(*group, F.rint(column).alias("_r"))
        .agg(
            F.count(F.lit(1)).alias("_m"),
            F.sum(column).alias("_sum"),
            F.min(column).alias("_min"),
            F.max(column).alias("_max"),
        )
    )
    return per_value.groupBy(*group).agg(
        F.min("_min").alias("min_value"),
        (F.sum("_sum") / F.sum("_m")).alias("mean_value"),
        F.max_by("_r", F.struct(F.col("_m"), -F.col("_r"))).alias("mode_value"),
        F.max("_max").alias("max_value"),
    ).select(*list(keys), "min_value", "mean_value", "mode_value", "max_value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max; one row per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in columns])
    values = df.select(F.inline(pairs)).where(F.col("_v").isNotNull())
    basic = values.groupBy("column").agg(
        F.count("_v").alias("n"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quarts = keyed.exact_quantiles(values, ["column"], "_v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, few_keys=True)
    return basic.join(quarts, "column")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, one pass."""
    return _per_column(df, lambda c: F.count_if(F.col(c).isNull()), "n_null")


def frame_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column."""
    info = _per_column(df, lambda c: F.count(c), "n_not_null")
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return info.withColumn("type", types[F.col("column")])


def _per_column(df: DataFrame, measure, name: str) -> DataFrame:
    one = df.agg(*[measure(c).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in df.columns])
    return one.select(F.inline(pairs))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations as long rows; each pair uses the rows where both are present."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"r{i}").alias("r")))
    return one.select(F.inline(F.array(*cells)))


def having_multi(df: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that occur more than once."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > 1).select(key)
    return df.join(keyed.settle(repeated), key, "left_semi")


def group_head(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows per group. Spark prunes to ``n`` rows per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def sample_keys(df: DataFrame, key: str, k: int, seed: int = 27) -> DataFrame:
    """``k`` different keys in random but repeatable order of choice."""
    from ..functions.draws import hash_text

    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.orderBy(hash_text(seed, F.col(key)), key).limit(k)


def weekday_profile(df: DataFrame, column: str = "traffic") -> DataFrame:
    return df.groupBy("detid", "weekday", "interval_s").agg(F.avg(column).alias("mean_traffic"))
