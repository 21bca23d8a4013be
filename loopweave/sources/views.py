"""Sensor tables derived from the general test tables, the same text for Spark and DuckDB.

``events`` give readings, ``customer`` the detectors, ``lineitem`` dense repeated values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLOCK = "(hour(ts)*3600 + minute(ts)*60 + cast(floor(second(ts)) as int))"

READINGS = {
    "row_id": "event_id",
    "detid": "concat('D/', cast(user_id as varchar(20)))",
    "day": "cast(ts as date)",
    "interval_s": f"cast({CLOCK} - {CLOCK} % 300 as int)",
    "flow": "value",
    "occ": "cast(event_id % 101 as double)/100",
    "error": "case event_type when 'error' then 1 when 'signup' then null else 0 end",
    "speed": "cast(null as double)",
}
DETECTORS = {
    "detid": "concat('D/', cast(c_custkey as varchar(20)))",
    "lanes": "cast(1 + c_custkey % 4 as int)",
    "lon": "cast(-130 + 10*((37*c_custkey) % 26) + (case when c_custkey % 4 < 2 then 3 else -4 end) as double)"
    "/cast(1000 as double)",
    "lat": "cast(51452 + 10*((11*c_custkey) % 10) as double)/cast(1000 as double)",
    "fclass": "c_mktsegment",
    "linkid": "cast(c_custkey % 997 as bigint)",
    "pos": "cast(c_custkey % 50 as double)/100",
    "length": "cast(50 + c_custkey % 400 as double)/1000",
}
DENSE = {
    "row_id": "l_orderkey*100 + l_linenumber",
    "detid": "concat('S/', cast(l_suppkey as varchar(20)))",
    "day": "cast(l_shipdate as date)",
    "interval_s": "cast(0 as int)",
    "flow": "l_quantity",
    "price": "l_extendedprice",
}


def _text(table: str, columns: dict[str, str], where: str = "") -> str:
    body = ", ".join(f"{expr} as {name}" for name, expr in columns.items())
    return f"select {body} from {table}{' where ' + where if where else ''}"


READINGS_SQL = _text("events", READINGS)
DETECTORS_SQL = _text("customer", DETECTORS)
DENSE_SQL = _text("lineitem", DENSE)


def _view(spark: SparkSession, sf: str, table: str, columns: dict[str, str]) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/{table}.parquet")
    return rows.select(*[F.expr(expr).alias(name) for name, expr in columns.items()])


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "events", READINGS)


def detectors(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "customer", DETECTORS)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "lineitem", DENSE)
