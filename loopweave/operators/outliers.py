"""Outlier, flat-line and frequency filters per sensor.

No filter gathers a sensor's readings in one place. Per-key statistics come from map-side
combined aggregates, are settled as small tables, and are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keyed

# Reading order inside a sensor; ``row_id`` settles equal times.
READING_ORDER = ("day", "interval_s", "row_id")


def drop_outliers(df: DataFrame, column: str = "traffic", keys: Sequence[str] = ("detid",), factor: float = 3) -> DataFrame:
    """Keeps rows inside the IQR fences of their group. Missing values are dropped, as are rows without a key."""
    columns = df.columns
    keyed_df, group = keyed.with_key(df, keys)
    fences = keyed.iqr_fences(keyed_df, group, column, factor)
    if keys:
        fences = keyed.settle(fences)  # a plain join side, so that AQE may split a hot sensor
    kept = keyed.join_stats(keyed_df, fences, group).where(F.col(column).between(F.col("lower"), F.col("upper")))
    return kept.select(*columns)


def clip_outliers(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("detid",),
    factor: float = 3,
    buckets: int = 24,
    order: Sequence[str] = READING_ORDER,
    slot: Sequence[str] = ("day", "interval_s"),
    bounds: str = "bucket",
) -> DataFrame:
    """Replaces outliers by the mean of their positional bucket.

    Each group is cut, in ``order``, into ``buckets`` runs of n // buckets rows; the last run
    takes the remainder (and every row when n < buckets). Fences come from the bucket, or from
    the whole group with ``bounds='group'``. Means include the outliers; missing values stay.
    ``slot`` is the leading part of ``order`` that cuts a group into task-sized cells.
    """
    if bounds not in ("bucket", "group"):
        raise ValueError(f"unknown bounds {bounds!r}: bucket or group")
    names = df.columns
    df, group = keyed.with_key(df, keys)

    def starts(n: Column) -> list[Column]:
        size = F.floor(n / F.lit(buckets)).cast("bigint")
        return [size * i for i in range(1, buckets)]

    def some(n: Column, first: Column, end: Column) -> Column:
        size = F.floor(n / F.lit(buckets))
        part = F.greatest(F.ceil(first / F.greatest(size, F.lit(1))), F.lit(1))  # the first that starts at ``first`` or later
        return (part < buckets) & (size * part >= first) & (size * part < end)

    cuts = keyed.starts_of_parts(df, group, order, slot, starts, some)
    cuts = keyed.settle(cuts) if keys else cuts
    tagged = keyed.join_stats(df, cuts, group).withColumn("_bucket", keyed.part_number(order, buckets)).drop("_starts")
    tagged = keyed.settle(tagged)  # read again for means, fences and the result

    pairs = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns])
    values = tagged.select(*group, "_bucket", F.inline(pairs)).where(F.col("_v").isNotNull())
    spot = [*group, "_bucket", "_col"]
    if bounds == "bucket":
        per_column = keyed.iqr_fences(values, spot, "_v", factor, mean="mean")
    else:
        means = values.groupBy(*spot).agg(F.avg("_v").alias("mean"))
        per_column = means.join(keyed.iqr_fences(values, [*group, "_col"], "_v", factor), [*group, "_col"])
    picks = [
        F.max(F.when(F.col("_col") == c, F.col(part))).alias(f"_{part}_{c}")
        for c in columns
        for part in ("lower", "upper", "mean")
    ]
    stats = keyed.settle(per_column.groupBy(*group, "_bucket").agg(*picks))

    out = tagged.join(stats, [*group, "_bucket"], "left")
    for c in columns:
        outside = (F.col(c) < F.col(f"_lower_{c}")) | (F.col(c) > F.col(f"_upper_{c}"))
        out = out.withColumn(c, F.when(outside, F.col(f"_mean_{c}")).otherwise(F.col(c)))
    return out.select(*names)


def drop_flatline(
    df: DataFrame, column: str = "flow", keys: Sequence[str] = ("day", "detid"), max_repeats: int = 250
) -> DataFrame:
    """Drops every row whose value occurs more than ``max_repeats`` times in its (day, sensor). Missing values stay."""
    spot = [*keys, column]
    counts = df.where(F.col(column).isNotNull()).groupBy(*spot).agg(F.count(F.lit(1)).alias("_m"))
    flat = keyed.settle(counts.where(F.col("_m") > max_repeats).select(*spot))
    return df.join(flat, spot, "left_anti")


def drop_freq_outliers(df: DataFrame, column: str, keys: Sequence[str] = ("detid",), factor: float = 5) -> DataFrame:
    """Drops rows whose value is unusually rare or frequent: the fences are those of the value counts per sensor."""
    spot = [*keys, column]
    counts = keyed.settle(
        df.where(F.col(column).isNotNull()).groupBy(*spot).agg(F.count(F.lit(1)).alias("_m"))
    )
    fences = keyed.iqr_fences(counts, keys, "_m", factor)
    odd = counts.join(fences, list(keys)).where(~F.col("_m").between(F.col("lower"), F.col("upper")))
    return df.join(keyed.settle(odd.select(*spot)), spot, "left_anti")
