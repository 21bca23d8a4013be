"""Sensors that should not be trusted: odd mean, hardly any variation, too little data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import keyed

FLAGS = ("mean_out_of_bound", "IQR_to_small", "not_enough_data")


def sensor_days(df: DataFrame, column: str = "traffic", key: str = "detid", day: str = "day", weekday: str = "weekday") -> DataFrame:
    """Rows, values and their sum per sensor and day: what the means, the day counts and the weekdays are made of."""
    value = F.col(column).cast("double")
    return df.where(F.col(key).isNotNull()).groupBy(key, day, weekday).agg(
        F.count(F.lit(1)).alias("_m"), F.count(value).alias("_values"), F.sum(value).alias("_sum")
    )


def mean_bounds(df: DataFrame, column: str = "traffic", factor: float = 3, key: str = "detid") -> DataFrame:
    """Sensors whose mean lies outside the IQR fences of all sensors' means."""
    return _mean_bounds(keyed.settle(sensor_days(df, column, key)), factor, key)


def _mean_bounds(days: DataFrame, factor: float, key: str) -> DataFrame:
    means = days.groupBy(key).agg(F.try_divide(F.sum("_sum"), F.sum("_values")).alias("mean_value"))
    fence = keyed.iqr_fences(means, (), "mean_value", factor).select(F.struct("lower", "upper")).scalar()
    outside = (F.col("mean_value") < F.col("_fence.lower")) | (F.col("mean_value") > F.col("_fence.upper"))
    return means.withColumn("_fence", fence).where(outside).select(key)


def small_spread(
    df: DataFrame, column: str = "traffic", min_iqr: float = 5, min_range: float = 20, key: str = "detid"
) -> DataFrame:
    """Sensors with both a small inter-quartile range and a small total range."""
    spread = iqr_range(df, [key], column)
    return spread.where((F.col("iqr") < min_iqr) & (F.col("total_range") < min_range)).select(key)


def iqr_range(df: DataFrame, keys: Sequence[str] = ("detid",), column: str = "traffic") -> DataFrame:
    """Inter-quartile and total range per key."""
    keys = list(keys)
    # the ends of the range are known from the scan that finds the quartiles
    q = keyed.exact_quantiles(df, keys, column, {"q0": 0.0, "q1": 0.25, "q3": 0.75, "q4": 1.0})
    return q.select(*keys, (F.col("q3") - F.col("q1")).alias("iqr"), (F.col("q4") - F.col("q0")).alias("total_range"))


def daily_counts(df: DataFrame, key: str = "detid", day: str = "day") -> DataFrame:
    return df.groupBy(key, day).agg(F.count(F.lit(1)).alias("n_rows"))


def valid_days(df: DataFrame, min_daily: int, key: str = "detid", day: str = "day") -> DataFrame:
    """Per sensor: days with at least ``min_daily`` rows."""
    return daily_counts(df, key, day).groupBy(key).agg(F.count_if(F.col("n_rows") >= min_daily).alias("valid_days"))


def not_enough(
    df: DataFrame,
    min_days: int = 14,
    min_daily: int = 250,
    key: str = "detid",
    day: str = "day",
    weekday: str = "weekday",
) -> DataFrame:
    """Sensors with too few well-filled days, or without some weekday (counted over all their days)."""
    days = df.where(F.col(key).isNotNull()).groupBy(key, day, weekday).agg(F.count(F.lit(1)).alias("_m"))
    return _not_enough(days, min_days, min_daily, key, weekday)


def _not_enough(days: DataFrame, min_days: int, min_daily: int, key: str, weekday: str = "weekday") -> DataFrame:
    per_key = days.groupBy(key).agg(
        F.count_if(F.col("_m") >= min_daily).alias("valid_days"),
        F.count_distinct(weekday).alias("weekdays"),
    )
    return per_key.where((F.col("valid_days") < min_days) | (F.col("weekdays") < 7)).select(key)


def detect_anomalies(
    df: DataFrame,
    column: str = "traffic",
    factor: float = 3,
    min_iqr: float = 5,
    min_range: float = 20,
    min_days: int = 14,
    min_daily: int = 250,
    key: str = "detid",
) -> DataFrame:
    """One row per flagged sensor with the three flags. Two scans of the rows: sums per sensor and day, and the quartiles' cells."""
    days = keyed.settle(sensor_days(df, column, key))
    found = {
        "mean_out_of_bound": _mean_bounds(days, factor, key),
        "IQR_to_small": small_spread(df, column, min_iqr, min_range, key),
        "not_enough_data": _not_enough(days, min_days, min_daily, key),
    }
    union = None
    for flag, sensors in found.items():
        marked = sensors.select(key, *[F.lit(flag == f).alias(f) for f in FLAGS])
        union = marked if union is None else union.unionByName(marked)
    return union.groupBy(key).agg(*[F.bool_or(f).alias(f) for f in FLAGS])


def rescue_bad_days(
    df: DataFrame,
    anomalies: DataFrame,
    min_daily: int = 230,
    min_days: int = 10,
    key: str = "detid",
    day: str = "day",
    weekday: str = "weekday",
) -> DataFrame:
    """Takes ``not_enough_data`` back when the well-filled days alone are enough and cover all weekdays."""
    days = df.groupBy(key, day, weekday).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") >= min_daily)
    good = days.groupBy(key).agg(F.count_distinct(day).alias("_days"), F.count_distinct(weekday).alias("_weekdays"))
    enough = good.where((F.col("_days") >= min_days) & (F.col("_weekdays") == 7)).select(key, F.lit(True).alias("_ok"))
    flag = F.col("not_enough_data") & F.col("_ok").isNull()
    return anomalies.join(enough, key, "left").withColumn("not_enough_data", flag).drop("_ok")


def handle_anomalies(df: DataFrame, anomalies: DataFrame, key: str = "detid", **rescue) -> tuple[DataFrame, DataFrame]:
    """Rows of the sensors that stay, and the flags that are left after the rescue."""
    handled = rescue_bad_days(df, anomalies, key=key, **rescue)
    left = keyed.settle(handled.where(F.col(FLAGS[0]) | F.col(FLAGS[1]) | F.col(FLAGS[2])))
    return df.join(left.select(key), key, "left_anti"), left


def anomaly_class(anomalies: DataFrame) -> DataFrame:
    """First matching class per sensor: bound, then small spread, then too little data."""
    name = (
        F.when(F.col("mean_out_of_bound"), F.lit("bound"))
        .when(F.col("IQR_to_small"), F.lit("small"))
        .when(F.col("not_enough_data"), F.lit("data"))
    )
    return anomalies.withColumn("anomaly_class", name)


def class_waterfall(df: DataFrame, anomalies: DataFrame, key: str = "detid") -> DataFrame:
    """Rows and sensors left after removing the classes one after the other.

    A row of class c is still there at every stage before c is removed, so one pass that
    counts each row at its surviving stages replaces a chain of anti joins.
    """
    classes = keyed.settle(anomaly_class(anomalies).select(key, "anomaly_class"))
    last = (
        F.when(F.col("anomaly_class") == "bound", 0)
        .when(F.col("anomaly_class") == "small", 1)
        .when(F.col("anomaly_class") == "data", 2)
        .otherwise(3)
    )
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).join(classes, key, "left")
    stages = per_key.select(key, "_m", F.explode(F.sequence(F.lit(0), last)).alias("stage"))
    return stages.groupBy("stage").agg(F.sum("_m").alias("n_rows"), F.count(key).alias("n_detectors"))
