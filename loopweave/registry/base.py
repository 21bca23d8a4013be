"""Query register: each entry is a Spark query over the given tables and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregate, clean, split
from ..sources import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers ``fn(spark, sf_dir)``. ``oracle`` is the body; the CTEs it names are put in front."""

    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_ctes(oracle)
        return fn

    return add


# -- results on the 1e-6 grid: sums in another order differ in the last bits only ---------------


def r(expr: str, digits: int = 6) -> str:
    """DuckDB: six decimals; the offset keeps exact halves off the rounding edge."""
    return f"(floor(({expr}) * 1e{digits} + 0.501) / 1e{digits})"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Spark: the same rounding on every double column."""
    size = F.lit(float(10**digits))
    return df.select(
        *[
            (F.floor(F.col(f.name) * size + F.lit(0.501)) / size).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


# -- shared inputs ------------------------------------------------------------------------------


def clean_rows(spark, sf):
    return clean.preprocess(views.readings(spark, sf))


def indexed(spark, sf):
    return clean.traffic_index(clean_rows(spark, sf))


def hourly(spark, sf):
    return aggregate.hourly_mean(indexed(spark, sf))


def day_split(spark, sf):
    return split.split_day(hourly(spark, sf), seed=27)


def train_test(spark, sf):
    """Train and test rows of the models; the split is written once."""
    from ..operators.keyed import settle

    rows = settle(day_split(spark, sf).select("detid", "day", "weekday", "interval_s", "traffic", "role"))
    return rows.where("role = 'train'").drop("role"), rows.where("role = 'test'").drop("role")


CTES = {
    "readings": views.READINGS_SQL,
    "detectors": views.DETECTORS_SQL,
    "dense": views.DENSE_SQL,
    "clean": """select row_id, detid, day, interval_s, flow, occ, dayname(day) as weekday
        from readings where error is distinct from 1""",
    "indexed": """select row_id, detid, day, interval_s, weekday, flow,
        case when occ < 0.001 then 0.001::double else occ end as occ,
        flow * case when occ < 0.001 then 0.001::double else occ end as traffic from clean""",
    "hourly": """select cast(round_even(interval_s / 3600, 0) * 3600 as integer) as interval_s, day, detid, weekday,
        avg(traffic) as traffic, avg(flow) as flow, avg(occ) as occ from indexed group by all""",
    "placed": "select h.*, d.lon, d.lat from hourly h left join detectors d using (detid)",
    "test_days": """select detid, day from (
          select *, row_number() over (partition by detid order by md5(concat_ws('|', '27', detid, cast(day as varchar))), day) as rn
          from (select detid, day, max(all_days) - count(*) filter (where holders = 1) as kept
                from (select u.*, count(*) over (partition by detid, weekday) as holders, w.all_days
                      from (select distinct detid, day, weekday from hourly) u
                      join (select detid, count(distinct weekday) as all_days from hourly group by 1) w using (detid))
                group by 1, 2)
          where kept >= 7) where rn = 1""",
    "split_rows": """select h.*, case when t.day is null then 'train' else 'test' end as role
        from hourly h left join test_days t on h.detid = t.detid and h.day = t.day""",
    "train": "select detid, day, weekday, interval_s, traffic from split_rows where role = 'train'",
    "test": "select detid, day, weekday, interval_s, traffic from split_rows where role = 'test'",
}
WEEKDAY_SQL = "list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], {0}) - 1"


def with_ctes(body: str) -> str:
    """Puts the CTEs that ``body`` mentions, and theirs, in front of it."""
    import re

    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    if not needed:
        return body
    listed = ",\n".join(f"{name} as ({sql})" for name, sql in CTES.items() if name in needed)
    for start in ("with recursive ", "with "):
        if body.lstrip().startswith(start):
            return f"{start}{listed},\n{body.lstrip()[len(start):]}"
    return f"with {listed}\n{body}"
