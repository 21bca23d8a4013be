"""Random baseline: a repeatable uniform draw between a sensor's rounded quartiles for every slot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import DAY_S, HOUR_S, WEEKDAYS
from ..functions.draws import uniform_float, uniform_int
from ..operators import keyed
from ..operators.metrics import join_actual, macro_average, regression_metrics

DAY_HOURS = tuple(range(0, DAY_S, HOUR_S))


def week_slots(keys: DataFrame, slot_s: int = 300) -> DataFrame:
    """Every (weekday, interval) slot of a week for each row of ``keys``, by row expansion."""
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    days = keys.select("*", F.explode(names).alias("weekday"))
    return days.select("*", F.explode(F.sequence(F.lit(0), F.lit(DAY_S - slot_s), F.lit(slot_s))).alias("interval_s"))


def fit_random(
    train: DataFrame,
    column: str = "traffic",
    key: str = "detid",
    slot_s: int = 300,
    seed: int = 27,
    kind: str = "int",
    inclusive: bool = True,
) -> DataFrame:
    """Model table (sensor, weekday, interval, traffic).

    ``kind='int'`` draws integers between the rounded quartiles; with ``inclusive=False`` the
    upper one is drawn only when both are equal. ``kind='float'`` draws between min and max.
    """
    if kind == "float":
        range_ = train.where(F.col(column).isNotNull()).groupBy(key).agg(
            F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")
        )
    elif kind == "int":
        q = keyed.exact_quantiles(train, [key], column, {"q1": 0.25, "q3": 0.75})
        range_ = q.select(key, F.rint("q1").cast("bigint").alias("low"), F.rint("q3").cast("bigint").alias("high"))
        if not inclusive:
            range_ = range_.withColumn("high", F.greatest(F.col("low"), F.col("high") - 1))
    else:
        raise ValueError(f"unknown kind {kind!r}: int or float")
    slots = week_slots(keyed.spread(range_), slot_s)
    parts = [F.col(key), F.col("weekday"), F.col("interval_s")]
    draw = uniform_int if kind == "int" else uniform_float
    return slots.select(key, "weekday", "interval_s", draw(F.col("low"), F.col("high"), seed, *parts).alias("traffic"))


def predict_random(model: DataFrame, weekday: str, intervals: Sequence[int] = DAY_HOURS) -> DataFrame:
    """The model's slots of one weekday at the given intervals, all sensors."""
    wanted = model.where((F.col("weekday") == weekday) & F.col("interval_s").isin(list(intervals)))
    return wanted.select("detid", "interval_s", "traffic")


def score_random(test: DataFrame, model: DataFrame) -> DataFrame:
    """Scores per sensor; test rows without a slot in the model are left out.

    Slots that no test row asks for leave the model before it is shuffled; there are at most a week's slots to ask for.
    """
    slots = ["weekday", "interval_s"]
    asked = model.join(F.broadcast(test.select(*slots).distinct()), slots, "left_semi")
    return regression_metrics(join_actual(test, asked))


def eval_random(test: DataFrame, model: DataFrame) -> DataFrame:
    return macro_average(score_random(test, model))
