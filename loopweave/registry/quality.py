"""Anomaly flags and the composite cleaning plan.

The test data hold about two readings per sensor and day, so the thresholds are scaled down.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import dataset
from ..sources import views
from .base import indexed, query, r, rounded
from .cleaning import clip_sql, fence_sql

FACTOR, MIN_IQR, MIN_RANGE, MIN_DAYS, MIN_DAILY = 0.9, 30, 270, 15, 2


def flags_sql(table: str, factor=FACTOR, min_iqr=MIN_IQR, min_range=MIN_RANGE, min_days=MIN_DAYS, min_daily=MIN_DAILY):
    """CTE list (without WITH): bound, small, few, flags."""
    return f"""means as (select detid, avg(traffic) as mean_value from {table} group by 1),
      bound as (select detid from means, ({fence_sql('(select 1 as one, mean_value from means)', 'one', 'mean_value', factor)}) f
                where mean_value < f.lower or mean_value > f.upper),
      small as (select detid from {table} group by 1
                having quantile_cont(traffic::double, 0.75) - quantile_cont(traffic::double, 0.25) < {min_iqr}
                   and max(traffic) - min(traffic) < {min_range}),
      few as (select detid from (select detid, day, weekday, count(*) as m from {table} group by 1, 2, 3) group by 1
              having count(*) filter (where m >= {min_daily}) < {min_days} or count(distinct weekday) < 7),
      flags as (select detid, detid in (select detid from bound) as mean_out_of_bound,
                  detid in (select detid from small) as IQR_to_small, detid in (select detid from few) as not_enough_data
                from (select detid from bound union select detid from small union select detid from few))"""


RESCUE_SQL = """rescued as (select f.detid, mean_out_of_bound, IQR_to_small, not_enough_data and g.detid is null as not_enough_data
   from flags f left join (select detid from (select detid, day, weekday, count(*) as m from indexed group by 1, 2, 3) where m >= 1
     group by 1 having count(distinct day) >= 20 and count(distinct weekday) = 7) g using (detid))"""


def flags(spark, sf):
    return quality.detect_anomalies(
        indexed(spark, sf), "traffic", FACTOR, MIN_IQR, MIN_RANGE, MIN_DAYS, MIN_DAILY
    )


@query("anomaly_mean_bound", f"with {flags_sql('indexed')} select detid from bound")
def anomaly_mean_bound(spark, sf):
    return quality.mean_bounds(indexed(spark, sf), factor=FACTOR)


@query("anomaly_small_iqr", f"with {flags_sql('indexed')} select detid from small")
def anomaly_small_iqr(spark, sf):
    return quality.small_spread(indexed(spark, sf), min_iqr=MIN_IQR, min_range=MIN_RANGE)


@query("anomaly_not_enough", f"with {flags_sql('indexed')} select detid from few")
def anomaly_not_enough(spark, sf):
    return quality.not_enough(indexed(spark, sf), MIN_DAYS, MIN_DAILY)


@query("detect_anomalies", f"with {flags_sql('indexed')} select * from flags")
def detect_anomalies(spark, sf):
    return flags(spark, sf)


@query("union_distinct", f"with {flags_sql('indexed')} select detid from bound union select detid from small union select detid from few")
def union_distinct(spark, sf):
    rows = indexed(spark, sf)
    parts = [
        quality.mean_bounds(rows, factor=FACTOR),
        quality.small_spread(rows, min_iqr=MIN_IQR, min_range=MIN_RANGE),
        quality.not_enough(rows, MIN_DAYS, MIN_DAILY),
    ]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query("rescue_bad_days", f"with {flags_sql('indexed')}, {RESCUE_SQL} select * from rescued")
def rescue_bad_days(spark, sf):
    return quality.rescue_bad_days(indexed(spark, sf), flags(spark, sf), min_daily=1, min_days=20)


LEFT_SQL = "left_over as (select * from rescued where mean_out_of_bound or IQR_to_small or not_enough_data)"


@query(
    "handle_anomalies",
    f"""with {flags_sql('indexed')}, {RESCUE_SQL}, {LEFT_SQL}
        select row_id, detid, {r('traffic')} as traffic from indexed where detid not in (select detid from left_over)""",
)
def handle_anomalies(spark, sf):
    rows = indexed(spark, sf)
    kept, _ = quality.handle_anomalies(rows, flags(spark, sf), min_daily=1, min_days=20)
    return rounded(kept.select("row_id", "detid", "traffic"))


@query(
    "handle_anomalies_flags",
    f"with {flags_sql('indexed')}, {RESCUE_SQL}, {LEFT_SQL} select * from left_over",
)
def handle_anomalies_flags(spark, sf):
    return quality.handle_anomalies(indexed(spark, sf), flags(spark, sf), min_daily=1, min_days=20)[1]


@query(
    "anomaly_class_waterfall",
    f"""with {flags_sql('indexed')},
      classed as (select x.detid, case when f.mean_out_of_bound then 0 when f.IQR_to_small then 1 when f.not_enough_data then 2 else 3 end as last
                  from indexed x left join flags f using (detid))
      select s.stage, count(*) as n_rows, count(distinct detid) as n_detectors
      from classed join (values (0), (1), (2), (3)) s(stage) on s.stage <= last group by 1""",
)
def anomaly_class_waterfall(spark, sf):
    return quality.class_waterfall(indexed(spark, sf), flags(spark, sf))


# -- the whole cleaning plan --------------------------------------------------------------------

LIMITS = dataset.Limits(
    max_repeats=1, clip_factor=1.3, drop_factor=1.7, anomaly_factor=1.1, min_iqr=30, min_range=270, min_days=8, min_daily=2
)

PLAN_SQL = f"""with steady as (select * exclude (m) from (
        select *, count(flow) over (partition by day, detid, flow) as m from clean) where m <= {LIMITS.max_repeats} or flow is null),
      clipped as (select s.detid, s.day, s.interval_s, s.weekday, a.v as occ, b.v as flow from steady s
        join ({clip_sql('steady', 'day, interval_s, row_id', 'occ', LIMITS.clip_factor, False)}) a using (row_id)
        join ({clip_sql('steady', 'day, interval_s, row_id', 'flow', LIMITS.clip_factor, False)}) b using (row_id)),
      speed as (select detid, day, interval_s, weekday, flow, greatest(occ, 0.001::double) as occ,
        flow * greatest(occ, 0.001::double) as traffic from clipped),
      dropped as (select s.* from speed s join ({fence_sql('speed', 'detid', 'traffic', LIMITS.drop_factor)}) f using (detid)
        where s.traffic between f.lower and f.upper),
      {flags_sql('dropped', LIMITS.anomaly_factor, LIMITS.min_iqr, LIMITS.min_range, LIMITS.min_days, LIMITS.min_daily)}"""

DATASET_SQL = f"""{PLAN_SQL},
      hour_rows as (select cast(round_even(interval_s / 3600, 0) * 3600 as integer) as interval_s, day, detid, weekday,
        least(avg(traffic), {LIMITS.cap}) as traffic from dropped where detid not in (select detid from flags) group by 1, 2, 3, 4),
      ends as (select min(traffic) as lo, max(traffic) as hi from hour_rows)
      select h.interval_s, h.day, h.detid, h.weekday,
        cast(round_even(coalesce((traffic - lo) / nullif(hi - lo, 0) * 99, 0), 0) as integer) as traffic,
        {r('d.lon')} as lon, {r('d.lat')} as lat, {r('d.pos')} as pos, {r('d.length')} as length, d.fclass
      from ends, hour_rows h left join detectors d using (detid)"""


@query("build_dataset", DATASET_SQL)
def build_dataset(spark, sf):
    data, _ = dataset.build_dataset(views.readings(spark, sf), views.detectors(spark, sf), LIMITS)
    return rounded(data)


@query("build_dataset_anomalies", f"{PLAN_SQL} select * from flags")
def build_dataset_anomalies(spark, sf):
    return dataset.build_dataset(views.readings(spark, sf), views.detectors(spark, sf), LIMITS)[1]


@query("clean_readings", f"{PLAN_SQL} select detid, day, interval_s, {r('traffic')} as traffic from dropped")
def clean_readings(spark, sf):
    rows = dataset.clean_readings(views.readings(spark, sf), LIMITS)
    return rounded(rows.select("detid", "day", "interval_s", F.col("traffic")))
