"""Scans. Schemas are declared, so nothing is read twice to guess types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import clock_interval
from ..functions.numbers import nan_to_null

READINGS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("interval", T.IntegerType()),
        T.StructField("detid", T.StringType()),
        T.StructField("flow", T.DoubleType()),
        T.StructField("occ", T.DoubleType()),
        T.StructField("error", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("speed", T.DoubleType()),
    ]
)
DETECTORS = T.StructType(
    [
        T.StructField("detid", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("pos", T.DoubleType()),
        T.StructField("fclass", T.StringType()),
        T.StructField("road", T.StringType()),
        T.StructField("limit", T.StringType()),
        T.StructField("citycode", T.StringType()),
        T.StructField("lanes", T.DoubleType()),
        T.StructField("linkid", T.LongType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ]
)

RENAMED = {"interval": "interval_s", "long": "lon"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, where: str | None = None, nrows: int | None = None
) -> DataFrame:
    """CSV with a header row; columns are matched to ``schema`` by position.

    ``where`` takes the place of skipping rows by number. ``nrows`` is a development limit.
    NaN becomes NULL, and ``interval``/``long`` become ``interval_s``/``lon``.
    """
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    df = _tidy(df)
    if where:
        df = df.where(where)
    return df.limit(nrows) if nrows is not None else df


def read_table(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Parquet table; a ``where`` on its partition columns prunes directories."""
    df = _tidy(spark.read.parquet(path))
    return df.where(where) if where else df


def _tidy(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        value = nan_to_null(field.name) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else F.col(field.name)
        columns.append(value.alias(RENAMED.get(field.name, field.name)))
    return df.select(*columns)


def extract_city(tables: dict[str, DataFrame], citycode: str, column: str = "citycode") -> dict[str, DataFrame]:
    """The rows of one city in each table."""
    return {name: df.where(F.col(column) == citycode) for name, df in tables.items()}


def weather_rows(landed: DataFrame, ts: str = "date") -> DataFrame:
    """Hourly weather with ``date_string`` and ``interval_s`` from the timestamp column."""
    return landed.select(
        *[c for c in landed.columns if c != ts],
        F.date_format(ts, "yyyy-MM-dd").alias("date_string"),
        clock_interval(ts).alias("interval_s"),
    )


def join_rain_cloud(rain: DataFrame, cloud: DataFrame, on: str = "date") -> DataFrame:
    return rain.join(cloud, on)
