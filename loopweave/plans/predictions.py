"""Forecasts of every model for every weekday, as one table that the map reads model by model and day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import WEEKDAYS
from ..models import baseline, forest, knn, seasonal
from ..operators import keyed

MODELS = ("random", "knn", "forest", "seasonal")


def week_queries(sensors: DataFrame, intervals: Sequence[int], key: str = "detid") -> DataFrame:
    """(key, weekday, interval_s): every weekday at the given intervals for each sensor."""
    days = keyed.spread(sensors.select(key)).select(key, F.explode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("weekday"))
    return days.select(key, "weekday", F.explode(F.array(*[F.lit(int(i)) for i in intervals])).alias("interval_s"))


def week_predictions(
    train: DataFrame,
    models: Sequence[str] = MODELS,
    intervals: Sequence[int] = baseline.DAY_HOURS,
    knn_settings: DataFrame | None = None,
    forest_settings: DataFrame | None = None,
    bootstrap: bool = True,
    key: str = "detid",
) -> DataFrame:
    """(model, key, weekday, interval_s, traffic) of all models and weekdays in one plan.

    The random model answers all its slots, the others the given intervals. Settings that aren't passed are searched for.
    """

    def random() -> DataFrame:
        return baseline.fit_random(train, key=key).withColumn("traffic", F.col("traffic").cast("double"))

    def neighbours() -> DataFrame:
        best = keyed.settle(knn.tune_knn(train, key)) if knn_settings is None else knn_settings
        return knn.forecast_points(train, week_queries(best, intervals, key), best, key)

    def trees() -> DataFrame:
        best = keyed.settle(forest.tune_forest(train, key)) if forest_settings is None else forest_settings
        return forest.forecast_points(train, week_queries(best, intervals, key), best, bootstrap=bootstrap, key=key)

    def season() -> DataFrame:
        model = keyed.settle(seasonal.fit_seasonal(train, key))
        asked = keyed.never_broadcast(week_queries(model, intervals, key)).withColumn("traffic", F.lit(None).cast("double"))
        return seasonal.forecast_rows(asked, model, key).withColumnRenamed("traffic_pred", "traffic")

    parts = {"random": random, "knn": neighbours, "forest": trees, "seasonal": season}
    unknown = sorted(set(models) - set(parts))
    if unknown or not models:
        raise ValueError(f"unknown models {unknown}: some of {MODELS}")
    union = None
    for name in models:
        part = parts[name]().select(F.lit(name).alias("model"), key, "weekday", F.col("interval_s").cast("int").alias("interval_s"), "traffic")
        union = part if union is None else union.unionByName(part)
    return union
