"""Reproducible, leak-free train/test splits. Every split adds a ``role`` column: train or test.

With ``splits=N`` the rows are repeated N times under ``split_id`` 0..N-1, each with its own draw.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import draw_without_replacement, hash_text
from . import keyed

METHODS = ("Sniper", "Day", "Week")


def _repeat(df: DataFrame, splits: int | None) -> tuple[DataFrame, list[str]]:
    if splits is None:
        return df, []
    return df.withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))), ["split_id"]


def split_sniper(
    df: DataFrame,
    k: int = 2,
    slots: int = 24,
    slot_s: int = 3600,
    seed: int = 27,
    splits: int | None = None,
    key: str = "detid",
    day: str = "day",
    interval: str = "interval_s",
) -> DataFrame:
    """``k`` of ``slots`` intervals per (day, sensor) go to the test set, whether or not rows exist there.

    The draw is a function of the row's own day and sensor: no shuffle and no join.
    """
    df, extra = _repeat(df, splits)
    drawn = draw_without_replacement(slots, k, seed, *[F.col(c) for c in extra], F.col(day), F.col(key))
    slot = F.floor(F.col(interval) / slot_s).cast("bigint")
    hit = (F.col(interval) % slot_s == 0) & F.array_contains(drawn, slot)
    return df.withColumn("role", F.when(hit, F.lit("test")).otherwise(F.lit("train")))


def split_day(df: DataFrame, k: int = 1, seed: int = 27, splits: int | None = None,
              key: str = "detid", day: str = "day", weekday: str = "weekday") -> DataFrame:
    """``k`` random days per sensor go to the test set; the rest must still cover all 7 weekdays."""
    return _split_units(df.withColumn("_unit", F.col(day)), k, 7, seed, splits, key, weekday, _draw_days).drop("_unit")


def split_week(df: DataFrame, k: int = 1, seed: int = 27, splits: int | None = None,
               key: str = "detid", day: str = "day", weekday: str = "weekday") -> DataFrame:
    """``k`` random ISO weeks per sensor go to the test set; the rest must keep at least 5 weekdays. Adds ``week``."""
    weeks = df.withColumn("week", F.weekofyear(day)).withColumn("_unit", F.col("week"))
    return _split_units(weeks, k, 5, seed, splits, key, weekday, _draw_weeks).drop("_unit")


def split(method: str, df: DataFrame, splits: int, seed: int = 27, day: str = "day") -> DataFrame:
    """``splits`` independent splits of one method in one table, without the day column."""
    chosen = {"Sniper": split_sniper, "Day": split_day, "Week": split_week}.get(method)
    if chosen is None:
        raise ValueError(f"unknown split method {method!r}: one of {METHODS}")
    return chosen(df, seed=seed, splits=splits).drop(day)


def unsplittable(split_rows: DataFrame, key: str = "detid") -> DataFrame:
    """Sensors for which no admissible draw exists; all their rows are in the train set."""
    return split_rows.groupBy(key).agg(F.count_if(F.col("role") == "test").alias("_t")).where("_t = 0").select(key)


def _split_units(df, k, min_weekdays, seed, splits, key, weekday, draw_many) -> DataFrame:
    """Test units (days or weeks) are drawn on the distinct (sensor, unit, weekday) table, whose
    size per sensor is bounded by the calendar; only the drawn units are joined to the rows."""
    present = df.where(F.col(key).isNotNull()).select(key, "_unit", weekday).distinct()
    sensor = [key] if splits is None else ["split_id", key]
    if k == 1:
        drawn = _draw_one(present, min_weekdays, seed, key, weekday, splits)
    else:
        drawn = draw_many(_repeat(present, splits)[0], k, min_weekdays, seed, sensor, weekday)
    test = keyed.settle(drawn.select(*sensor, "_unit", F.lit("test").alias("_role")))
    rows, _ = _repeat(df, splits)
    joined = rows.join(test, [*sensor, "_unit"], "left")
    return joined.withColumn("role", F.coalesce("_role", F.lit("train"))).drop("_role")


def _draw_one(units: DataFrame, min_weekdays: int, seed, key: str, weekday: str, splits: int | None) -> DataFrame:
    """The admissible unit with the smallest hash. A unit takes away the weekdays only it has.

    Which units may go doesn't depend on the split: that is found once, and every split draws from the same units.
    """
    by_sensor = Window.partitionBy(key)
    marked = units.select(
        key,
        "_unit",
        F.count(F.lit(1)).over(Window.partitionBy(key, weekday)).alias("_holders"),
        F.size(F.collect_set(weekday).over(by_sensor)).alias("_all"),
    )
    per_unit = marked.groupBy(key, "_unit").agg((F.max("_all") - F.count_if(F.col("_holders") == 1)).alias("_kept"))
    free, extra = _repeat(per_unit.where(F.col("_kept") >= min_weekdays), splits)
    sensor = [*extra, key]
    order = F.struct(hash_text(seed, *[F.col(c) for c in sensor], F.col("_unit")), F.col("_unit"))
    return free.groupBy(*sensor).agg(F.min_by("_unit", order).alias("_unit"))


def _draw_days(units: DataFrame, k: int, min_weekdays: int, seed, sensor: list[str], weekday: str) -> DataFrame:
    """The ``k`` smallest hashes among the days that may go: of each weekday all but the last in hash order.

    A day has one weekday, so a draw of ``k`` days that leaves every weekday exists exactly when there are ``k`` of them.
    """
    hashed = units.withColumn("_h", hash_text(seed, *[F.col(c) for c in sensor], F.col("_unit")))
    in_order = [F.col("_h"), F.col("_unit")]
    by_weekday = Window.partitionBy(*sensor, weekday).orderBy(*[c.desc() for c in in_order])
    spare = hashed.withColumn("_last", F.row_number().over(by_weekday)).withColumn(
        "_all", F.size(F.collect_set(weekday).over(Window.partitionBy(*sensor)))
    )
    free = spare.where((F.col("_last") > 1) & (F.col("_all") >= min_weekdays))
    by_sensor = Window.partitionBy(*sensor)
    ranked = free.select(
        *sensor,
        "_unit",
        F.row_number().over(by_sensor.orderBy(*in_order)).alias("_rank"),
        F.count(F.lit(1)).over(by_sensor).alias("_n"),
    )
    return ranked.where((F.col("_n") >= k) & (F.col("_rank") <= k)).select(*sensor, "_unit")


def first_draw(masks: list[int], k: int, min_weekdays: int) -> list[int]:
    """Places of the first ``k`` units, in lexicographic order, whose removal leaves ``min_weekdays`` weekdays; else none.

    ``masks`` are 7-bit sets of weekdays. A set of units can spare ``k`` of them if it has ``k`` more than the fewest
    that hold enough weekdays, so each unit in turn is taken when the others still can spare the rest.
    """

    def fewest(left: list[int]) -> int:
        need, seen, count = {0}, {0}, 0
        while need:
            if any(m.bit_count() >= min_weekdays for m in need):
                return count
            need = {m | x for m in need for x in set(left)} - seen
            seen |= need
            count += 1
        return len(left) + k + 1

    taken: list[int] = []
    for i in range(len(masks)):
        if len(taken) == k:
            break
        left = [m for j, m in enumerate(masks) if j not in taken and j != i]
        if len(left) - (k - len(taken) - 1) >= fewest(left):
            taken.append(i)
    return taken if len(taken) == k else []


def _draw_weeks(units: DataFrame, k: int, min_weekdays: int, seed, sensor: list[str], weekday: str) -> DataFrame:
    """The first ``k`` weeks in hash order that leave enough weekdays, found exactly on each sensor's calendar (53 weeks at most)."""
    names = Window.partitionBy(*sensor).orderBy(weekday)
    bits = units.withColumn("_bit", F.dense_rank().over(names) - 1)
    masks = bits.groupBy(*sensor, "_unit").agg(F.sum(F.expr("shiftleft(1, _bit)")).cast("int").alias("_mask"))
    order = hash_text(seed, *[F.col(c) for c in sensor], F.col("_unit"))
    week = F.struct(order.alias("h"), F.col("_unit").alias("u"), F.col("_mask").alias("m"))
    gathered = masks.groupBy(*sensor).agg(F.array_sort(F.collect_list(week)).alias("_weeks"))

    schema = T.StructType([*gathered.schema.fields, T.StructField("_places", T.ArrayType(T.IntegerType()))])

    def draw(batches):
        for batch in batches:
            weeks = batch.column("_weeks").to_pylist()
            places = pa.array([first_draw([w["m"] for w in x], k, min_weekdays) for x in weeks], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, places], names=[*batch.schema.names, "_places"])

    placed = gathered.mapInArrow(draw, schema)
    return placed.select(*sensor, F.explode(F.transform("_places", lambda i: F.get(F.col("_weeks"), i)["u"])).alias("_unit"))


def role_ratio(split_rows: DataFrame) -> DataFrame:
    """Test rows per train row."""
    test, train = F.count_if(F.col("role") == "test"), F.count_if(F.col("role") == "train")
    return split_rows.agg(F.try_divide(test.cast("double"), train.cast("double")).alias("ratio"))
