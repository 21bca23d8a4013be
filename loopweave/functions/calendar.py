"""Column expressions over days, intervals (seconds since midnight) and weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English weekday names, Monday is 0.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAY_S = 86400
HOUR_S = 3600
# Fixed value: the Monday on which a folded week is placed.
FOLD_MONDAY = "2015-05-18"


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def weekday_name(day: str | Column) -> Column:
    return F.date_format(col(day), "EEEE")


def weekday_number(name: str | Column) -> Column:
    """Weekday name to 0..6; an unknown or missing name gives NULL."""
    name = col(name)
    out = F.lit(None).cast("int")
    for number, text in enumerate(WEEKDAYS):
        out = F.when(name == text, F.lit(number)).otherwise(out)
    return out


def bucket_half_even(value: str | Column, ratio: int) -> Column:
    """Nearest multiple of ``ratio``, halves to the even multiple. 84600 s and later give 86400."""
    return (F.rint(col(value) / F.lit(float(ratio))) * F.lit(ratio)).cast("int")


def week_second(weekday: str | Column, interval: str | Column) -> Column:
    """Seconds since Monday 00:00 from a weekday name and an interval."""
    return weekday_number(weekday) * DAY_S + col(interval)


def folded_timestamp(second: str | Column) -> Column:
    """Timestamp (no zone) on the folded week."""
    start = F.lit(f"{FOLD_MONDAY} 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col(second))


def timestamp_hour_interval(ts: str | Column) -> Column:
    return F.hour(col(ts)) * HOUR_S


def clock_interval(ts: str | Column) -> Column:
    """Seconds since midnight of a timestamp, fractions cut."""
    ts = col(ts)
    return F.hour(ts) * HOUR_S + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("int")


def is_full_hour(interval: str | Column) -> Column:
    return col(interval) % HOUR_S == 0
