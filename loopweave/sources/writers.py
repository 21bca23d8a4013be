"""Sinks. Tables are Parquet unless asked otherwise, partitioned by what readers filter on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grid as g
from ..operators.split import split


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """The clean data set, or the anomaly table."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: parquet or csv")


def write_city(tables: dict[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """Every table under ``root/name``, partitioned by city so that later reads prune."""
    for name, df in tables.items():
        df.write.mode(mode).partitionBy("citycode").parquet(f"{root}/{name}")


def write_splits(df: DataFrame, method: str, splits: int, path: str, seed: int = 27, mode: str = "errorifexists") -> None:
    """All splits in one job; ``split_id`` and ``role`` are directories."""
    rows = split(method, df, splits, seed).hint("rebalance", "split_id", "role")
    rows.write.mode(mode).partitionBy("split_id", "role").parquet(path)


def read_split(spark: SparkSession, path: str, split_id: int, role: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.where((F.col("split_id") == split_id) & (F.col("role") == role)).drop("split_id", "role")


def write_grid_cube(predictions: DataFrame, path: str, shape: float = 0.01, mode: str = "errorifexists") -> None:
    """Grids of every weekday and interval, one aggregation and one directory per weekday."""
    g.grid_cube(predictions, shape=shape).hint("rebalance", "weekday").write.mode(mode).partitionBy("weekday").parquet(path)


def write_geojson(features: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One GeoJSON feature per line."""
    features.select("value").write.mode(mode).text(path)


def store_predictions(predictions: DataFrame, path: str, mode: str = "append") -> None:
    """Prediction rows with ``model`` and ``weekday``, which become directories.

    Rows are clustered by both; AQE splits a large cluster over as many tasks as its size asks for.
    """
    predictions.hint("rebalance", "model", "weekday").write.mode(mode).partitionBy("model", "weekday").parquet(path)


def load_predictions(spark: SparkSession, path: str, model: str, weekday: str) -> DataFrame:
    """Predictions of one model and weekday; only that directory is read."""
    table = spark.read.parquet(path)
    return table.where((F.col("model") == model) & (F.col("weekday") == weekday))


def store_models(models: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A model table keyed by sensor; the key is a column, so ids need no encoding."""
    models.write.mode(mode).parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
