"""Composite plans: the clean data set and the map query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate, clean, grid, joins, keyed, outliers, quality
from ..scratch import scope
from ..sources.writers import load_predictions


@dataclass(frozen=True)
class Limits:
    """Thresholds of the cleaning plan."""

    max_repeats: int = 250
    clip_factor: float = 3
    clip_buckets: int = 24
    drop_factor: float = 2
    anomaly_factor: float = 3
    min_iqr: float = 5
    min_range: float = 20
    min_days: int = 10
    min_daily: int = 230
    ratio: int = 3600
    cap: float = 200
    rescue: bool = False
    # A second flat-line pass on the index itself.
    flat_index: bool = False


def clean_readings(readings: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Error filter, flat-line days, clipped occupancy and flow, index, index outliers."""
    good = clean.preprocess(readings)
    steady = outliers.drop_flatline(good, "flow", max_repeats=limits.max_repeats)
    # Both columns are clipped on the same rows, so one pass serves both.
    clipped = outliers.clip_outliers(steady, ["occ", "flow"], factor=limits.clip_factor, buckets=limits.clip_buckets)
    indexed = clean.traffic_index(clipped)
    # The later steps scan these rows several times, a few columns each.
    staged = keyed.settle(indexed.select("detid", "day", "weekday", "interval_s", "flow", "occ", "traffic"))
    if limits.flat_index:
        staged = outliers.drop_flatline(staged, "traffic", max_repeats=limits.max_repeats)
    return outliers.drop_outliers(staged, "traffic", factor=limits.drop_factor)


def build_dataset(readings: DataFrame, detectors: DataFrame, limits: Limits = Limits(), attributes=joins.ATTRIBUTES):
    """(clean data set, anomaly table).

    readings: row_id, detid, day, interval_s, flow, occ, error. The data set holds interval_s,
    day, detid, weekday, traffic (0..99) and the detector attributes but lanes.
    """
    # Only the flags and the hourly table outlive the block; the rows staged on the way are deleted at its end.
    with scope(readings.sparkSession) as keep:
        rows = clean_readings(readings, limits)
        flags = keyed.settle(
            quality.detect_anomalies(
                rows, "traffic", limits.anomaly_factor, limits.min_iqr, limits.min_range, limits.min_days, limits.min_daily
            )
        )
        if limits.rescue:
            kept, flags = quality.handle_anomalies(rows, flags)
        else:
            kept = joins.drop_keys(rows, flags, "detid")
        hourly = keep(aggregate.hourly_mean(kept, ratio=limits.ratio))
        flags = keep(flags)
    scaled = clean.normalize_minmax(clean.clip_upper(hourly, "traffic", limits.cap))
    placed = joins.with_detectors(scaled, detectors, columns=attributes)
    return clean.final_process(placed), flags


def weekday_prediction(spark: SparkSession, path: str, model: str, weekday: str, detectors: DataFrame) -> DataFrame:
    """Stored predictions of one model and weekday with the sensors' coordinates."""
    return joins.with_detectors(load_predictions(spark, path, model, weekday), detectors, columns=("lon", "lat"))


def prediction_cube(predictions: DataFrame, detectors: DataFrame, shape: float = 0.01, complete: bool = False) -> DataFrame:
    """Grids of every (model, weekday, interval) in one job, optionally filled over the bounding box."""
    keys = ("model", "weekday", "interval_s")
    placed = joins.with_detectors(keyed.never_broadcast(predictions), detectors, columns=("lon", "lat"))
    observed = grid.grid_mean(placed, keys=keys, shape=shape)
    if not complete:
        return observed
    return grid.advanced_grid(observed, grid.complete_grid(placed, shape, keys), keys, shape)


def flagship(readings: DataFrame, detectors: DataFrame, digits: int | None = 6) -> DataFrame:
    """Hourly index per sensor placed on the grid: mean index and sensor rows per cell."""
    indexed = clean.traffic_index(clean.preprocess(readings))
    hourly = aggregate.hourly_mean(indexed)
    placed = joins.with_detectors(hourly, detectors, columns=("lon", "lat"))
    mean = F.col("mean_traffic_index")
    return grid.grid_mean(placed).select(
        "grid_id",
        (mean if digits is None else F.round(mean, digits)).alias("mean_traffic_index"),
        "detectors_in_grid",
        "lon_rounded",
        "lat_rounded",
    )
