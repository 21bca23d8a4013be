"""Row-level cleaning of readings: error filter, index, clipping, scaling, final form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numbers as num


def preprocess(df: DataFrame, error: str = "error", day: str = "day", drop: Sequence[str] = ("error", "speed")) -> DataFrame:
    """Drops rows with ``error`` = 1 (a missing flag is kept), parses the day, names the weekday."""
    good = df.where(~F.col(error).eqNullSafe(1))
    return good.withColumn(day, F.to_date(day)).withColumn("weekday", cal.weekday_name(day)).drop(*drop)


def error_counts(df: DataFrame, error: str = "error") -> DataFrame:
    """Rows per flag value 0 and 1; a value that never occurs counts 0."""
    counts = df.agg(
        F.count_if(F.col(error) == 0).alias("n0"),
        F.count_if(F.col(error) == 1).alias("n1"),
    )
    pairs = F.array(
        F.struct(F.lit(0).alias(error), F.col("n0").alias("n")),
        F.struct(F.lit(1).alias(error), F.col("n1").alias("n")),
    )
    return counts.select(F.inline(pairs))


def traffic_index(
    df: DataFrame, flow: str = "flow", occ: str = "occ", out: str = "traffic", min_occ: float | None = 0.001
) -> DataFrame:
    """``out`` = flow x occupancy; occupancy is first raised to ``min_occ`` (None: left as it is)."""
    if min_occ is not None:
        df = df.withColumn(occ, num.raise_to(occ, min_occ))
    return df.withColumn(out, F.col(flow) * F.col(occ))


def clip_upper(df: DataFrame, column: str = "traffic", threshold: float = 500) -> DataFrame:
    return df.withColumn(column, num.cap_at(column, threshold))


def normalize_minmax(df: DataFrame, column: str = "traffic", low: float = 0, high: float = 99) -> DataFrame:
    """Global min-max scaling to low..high. A constant column gives NULL.

    The two extremes come from one scalar aggregate, so the rows are not shuffled.
    """
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("ends")).scalar()
    low_end, high_end = F.col("_ends.lo"), F.col("_ends.hi")
    share = F.try_divide(F.col(column) - low_end, high_end - low_end)
    scaled = share * F.lit(float(high - low)) + F.lit(float(low))
    return df.withColumn("_ends", ends).withColumn(column, scaled).drop("_ends")


def normalize_lanes(df: DataFrame, column: str = "traffic", lanes: str = "lanes", out: str = "traffic") -> DataFrame:
    """Value per lane; 0 lanes give NULL."""
    return df.withColumn(out, F.try_divide(F.col(column), F.col(lanes).cast("double")))


def final_process(
    df: DataFrame, column: str = "traffic", drop: Sequence[str] = ("lanes", "occ", "flow"), mode: str = "round"
) -> DataFrame:
    """Missing values to 0, then an integer (``round`` half-even or ``truncate``), extra columns dropped."""
    filled = F.coalesce(F.col(column), F.lit(0.0))
    if mode == "round":
        filled = F.rint(filled)
    elif mode != "truncate":
        raise ValueError(f"unknown mode {mode!r}: round or truncate")
    return df.withColumn(column, filled.cast("int")).drop(*drop)


def full_hours(df: DataFrame, interval: str = "interval_s") -> DataFrame:
    return df.where(cal.is_full_hour(interval))


def unfold_week(df: DataFrame, weekday: str = "weekday", interval: str = "interval_s") -> DataFrame:
    """Interval becomes seconds since Monday 00:00; the weekday column goes."""
    return df.withColumn(interval, cal.week_second(weekday, interval)).drop(weekday)


def interval_to_ts(df: DataFrame, interval: str = "interval_s", out: str = "ds") -> DataFrame:
    """Seconds on the folded week become a timestamp; the interval column goes."""
    return df.withColumn(out, cal.folded_timestamp(interval)).drop(interval)


def hour_slice(df: DataFrame, value: int, interval: str = "interval_s") -> DataFrame:
    return df.where(F.col(interval) == value)


def threshold_counts(df: DataFrame, conditions: dict[str, Column], key: str = "detid") -> DataFrame:
    """Rows and distinct keys that meet each named condition; one pass over the data."""
    hits = F.filter(
        F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]), lambda x: x.isNotNull()
    )
    met = df.select(key, F.explode(hits).alias("condition"))
    per_key = met.groupBy("condition", key).agg(F.count(F.lit(1)).alias("_m"))
    counts = per_key.groupBy("condition").agg(
        F.sum("_m").alias("_rows"), F.count(key).alias("_keys")
    )
    names = df.sparkSession.createDataFrame([(n,) for n in conditions], "condition string")
    return names.join(counts, "condition", "left").select(
        "condition",
        F.coalesce("_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("_keys", F.lit(0)).alias("n_keys"),
    )
