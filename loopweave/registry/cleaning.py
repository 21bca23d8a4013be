"""Row-level operators, joins and outlier filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import clean, joins, outliers
from ..sources import readers, views
from .base import WEEKDAY_SQL, clean_rows, hourly, indexed, query, r, rounded


@query("preprocess", f"select row_id, detid, day, interval_s, {r('flow')} as flow, {r('occ')} as occ, weekday from clean")
def preprocess(spark, sf):
    return rounded(clean_rows(spark, sf))


@query(
    "error_counts",
    """select v.error, cast(count(x.row_id) as bigint) as n
       from (values (0), (1)) v(error) left join readings x on x.error = v.error group by 1""",
)
def error_counts(spark, sf):
    return clean.error_counts(views.readings(spark, sf))


@query(
    "traffic_index",
    f"select row_id, detid, {r('flow')} as flow, {r('occ')} as occ, {r('traffic')} as traffic from indexed",
)
def traffic_index(spark, sf):
    return rounded(indexed(spark, sf).select("row_id", "detid", "flow", "occ", "traffic"))


@query("traffic_index_unclipped", f"select row_id, {r('occ')} as occ, {r('flow * occ')} as traffic from clean")
def traffic_index_unclipped(spark, sf):
    rows = clean.traffic_index(clean_rows(spark, sf), min_occ=None)
    return rounded(rows.select("row_id", "occ", "traffic"))


@query("clip_upper", f"select row_id, detid, {r('case when traffic > 200 then 200 else traffic end')} as traffic from indexed")
def clip_upper(spark, sf):
    return rounded(clean.clip_upper(indexed(spark, sf), "traffic", 200).select("row_id", "detid", "traffic"))


@query(
    "normalize_minmax",
    f"""select row_id, {r('(traffic - lo) / nullif(hi - lo, 0) * 99')} as traffic
        from indexed, (select min(traffic) as lo, max(traffic) as hi from indexed)""",
)
def normalize_minmax(spark, sf):
    return rounded(clean.normalize_minmax(indexed(spark, sf)).select("row_id", "traffic"))


@query(
    "normalize_lanes",
    f"""select x.row_id, d.lanes, {r('x.traffic / nullif(d.lanes, 0)')} as traffic_per_lane
        from indexed x left join detectors d using (detid)""",
)
def normalize_lanes(spark, sf):
    rows = joins.with_detectors(indexed(spark, sf), views.detectors(spark, sf), columns=("lanes",))
    return rounded(clean.normalize_lanes(rows, out="traffic_per_lane").select("row_id", "lanes", "traffic_per_lane"))


@query(
    "final_process",
    "select row_id, detid, day, interval_s, weekday, cast(round_even(coalesce(traffic, 0), 0) as integer) as traffic from indexed",
)
def final_process(spark, sf):
    return clean.final_process(indexed(spark, sf))


@query("final_process_truncate", "select row_id, cast(trunc(coalesce(traffic, 0)) as integer) as traffic from indexed")
def final_process_truncate(spark, sf):
    return clean.final_process(indexed(spark, sf), mode="truncate").select("row_id", "traffic")


@query("full_hours", "select row_id, detid, interval_s from clean where interval_s % 3600 = 0")
def full_hours(spark, sf):
    return clean.full_hours(clean_rows(spark, sf)).select("row_id", "detid", "interval_s")


@query(
    "unfold_week",
    f"select row_id, detid, cast(({WEEKDAY_SQL.format('weekday')}) * 86400 + interval_s as integer) as interval_s from clean",
)
def unfold_week(spark, sf):
    return clean.unfold_week(clean_rows(spark, sf)).select("row_id", "detid", "interval_s")


@query("weekday_map", f"select row_id, weekday, cast({WEEKDAY_SQL.format('weekday')} as integer) as number from clean")
def weekday_map(spark, sf):
    return clean_rows(spark, sf).select("row_id", "weekday", cal.weekday_number("weekday").alias("number"))


@query(
    "interval_to_ts",
    f"""select row_id, strftime(timestamp '2015-05-18' + to_seconds(({WEEKDAY_SQL.format('weekday')}) * 86400 + interval_s),
        '%Y-%m-%d %H:%M:%S') as ds from clean""",
)
def interval_to_ts(spark, sf):
    rows = clean.interval_to_ts(clean.unfold_week(clean_rows(spark, sf)))
    return rows.select("row_id", F.date_format("ds", "yyyy-MM-dd HH:mm:ss").alias("ds"))


@query(
    "ts_to_interval",
    f"""select row_id, cast(hour(timestamp '2015-05-18' + to_seconds(({WEEKDAY_SQL.format('weekday')}) * 86400 + interval_s))
        * 3600 as integer) as interval_s from clean""",
)
def ts_to_interval(spark, sf):
    rows = clean.interval_to_ts(clean.unfold_week(clean_rows(spark, sf)))
    return rows.select("row_id", cal.timestamp_hour_interval("ds").alias("interval_s"))


@query("hour_slice", f"select detid, day, interval_s, {r('traffic')} as traffic from hourly where interval_s = 28800")
def hour_slice(spark, sf):
    return rounded(clean.hour_slice(hourly(spark, sf), 28800).select("detid", "day", "interval_s", "traffic"))


@query(
    "interval_in",
    f"""select detid, day, interval_s, {r('traffic')} as traffic from hourly
        where interval_s in ({', '.join(str(h * 3600) for h in range(24))})""",
)
def interval_in(spark, sf):
    rows = hourly(spark, sf).where(F.col("interval_s").isin([h * 3600 for h in range(24)]))
    return rounded(rows.select("detid", "day", "interval_s", "traffic"))


@query(
    "threshold_filter",
    """select c.condition, cast(count(x.row_id) as bigint) as n_rows, cast(count(distinct x.detid) as bigint) as n_keys
       from (values ('low'), ('high'), ('zero')) c(condition)
       left join indexed x on (c.condition = 'low' and traffic <= 1) or (c.condition = 'high' and traffic >= 170)
         or (c.condition = 'zero' and traffic = 0) group by 1""",
)
def threshold_filter(spark, sf):
    t = F.col("traffic")
    return clean.threshold_counts(indexed(spark, sf), {"low": t <= 1, "high": t >= 170, "zero": t == 0})


@query("key_filter", f"select row_id, day, interval_s, {r('traffic')} as traffic from indexed where detid = 'D/7' and weekday = 'Monday'")
def key_filter(spark, sf):
    rows = indexed(spark, sf).where((F.col("detid") == "D/7") & (F.col("weekday") == "Monday"))
    return rounded(rows.select("row_id", "day", "interval_s", "traffic"))


@query(
    "time_between",
    f"""select row_id from (select row_id, ({WEEKDAY_SQL.format('weekday')}) * 86400 + interval_s as s from clean)
        where timestamp '2015-05-18' + to_seconds(s) between timestamp '2015-05-19' and timestamp '2015-05-20'""",
)
def time_between(spark, sf):
    rows = clean.interval_to_ts(clean.unfold_week(clean_rows(spark, sf)))
    start = F.lit("2015-05-19 00:00:00").cast("timestamp_ntz")
    return rows.where(F.col("ds").between(start, start + F.make_dt_interval(F.lit(1)))).select("row_id")


@query("select_rename", f"select row_id, detid, interval_s as ds, {r('flow')} as y from readings")
def select_rename(spark, sf):
    rows = views.readings(spark, sf).drop("day", "occ", "error", "speed")
    return rounded(rows.withColumnRenamed("interval_s", "ds").withColumnRenamed("flow", "y"))


@query(
    "src_weather",
    """select row_id, strftime(ts, '%Y-%m-%d') as date_string,
       cast(hour(ts)*3600 + minute(ts)*60 + floor(second(ts)) as integer) as interval_s
       from (select event_id as row_id, ts from events)""",
)
def src_weather(spark, sf):
    landed = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("row_id"), F.col("ts").alias("date"))
    return readers.weather_rows(landed)


@query("src_city_extract", "select c_custkey, c_name, c_mktsegment as citycode from customer where c_mktsegment = 'BUILDING'")
def src_city_extract(spark, sf):
    table = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", F.col("c_mktsegment").alias("citycode"))
    return readers.extract_city({"detectors": table}, "BUILDING")["detectors"]


# -- joins --------------------------------------------------------------------------------------


@query(
    "join_detectors_left",
    f"""select h.detid, h.day, h.interval_s, {r('h.traffic')} as traffic, d.lanes, {r('d.lon')} as lon, {r('d.lat')} as lat,
        {r('d.pos')} as pos, {r('d.length')} as length, d.fclass from hourly h left join detectors d using (detid)""",
)
def join_detectors_left(spark, sf):
    rows = joins.with_detectors(hourly(spark, sf), views.detectors(spark, sf))
    return rounded(rows.drop("weekday", "flow", "occ"))


@query("join_pred_coords", f"select detid, day, interval_s, {r('traffic')} as traffic, {r('lon')} as lon, {r('lat')} as lat from placed")
def join_pred_coords(spark, sf):
    rows = joins.with_detectors(hourly(spark, sf), views.detectors(spark, sf), columns=("lon", "lat"))
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "lon", "lat"))


@query(
    "join_detectors_inner",
    f"select x.row_id, x.detid, d.fclass, {r('x.traffic')} as traffic from indexed x join detectors d using (detid)",
)
def join_detectors_inner(spark, sf):
    rows = joins.with_detectors(indexed(spark, sf), views.detectors(spark, sf), columns=("fclass",), how="inner")
    return rounded(rows.select("row_id", "detid", "fclass", "traffic"))


def weather(spark, sf):
    """Hourly weather: rain and cloud cover from two kinds of events."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    hour = events.select(F.to_date("ts").alias("day"), (F.hour("ts") * 3600).alias("interval_s"), "event_type", "value")
    return hour.groupBy("day", "interval_s").agg(
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("rain"),
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("cloud_cover"),
    )


WEATHER_SQL = """select cast(ts as date) as day, cast(hour(ts) * 3600 as integer) as interval_s,
  avg(value) filter (where event_type = 'view') as rain, avg(value) filter (where event_type = 'click') as cloud_cover
  from events group by 1, 2"""


@query(
    "join_weather",
    f"""select h.detid, h.day, h.interval_s, {r('h.traffic')} as traffic, {r('w.rain')} as rain, {r('w.cloud_cover')} as cloud_cover
        from hourly h join ({WEATHER_SQL}) w on h.day = w.day and h.interval_s = w.interval_s""",
)
def join_weather(spark, sf):
    rows = joins.with_weather(hourly(spark, sf), weather(spark, sf))
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "rain", "cloud_cover"))


@query(
    "join_rain_cloud",
    f"""select a.date, {r('a.rain')} as rain, {r('b.cloud_cover')} as cloud_cover
        from (select date_trunc('hour', ts) as date, avg(value) as rain from events where event_type = 'view' group by 1) a
        join (select date_trunc('hour', ts) as date, avg(value) as cloud_cover from events where event_type = 'click' group by 1) b
        using (date)""",
)
def join_rain_cloud(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("date", F.date_trunc("hour", "ts"))

    def mean_of(kind, name):
        return events.where(F.col("event_type") == kind).groupBy("date").agg(F.avg("value").alias(name))

    return rounded(readers.join_rain_cloud(mean_of("view", "rain"), mean_of("click", "cloud_cover")))


BUSY_SQL = "select detid from detectors where fclass = 'BUILDING'"


@query("semi_isin", f"select row_id, detid from clean where detid in ({BUSY_SQL})")
def semi_isin(spark, sf):
    listed = views.detectors(spark, sf).where("fclass = 'BUILDING'")
    return joins.keep_keys(clean_rows(spark, sf), listed, "detid").select("row_id", "detid")


@query("anti_isin", f"select row_id, detid from clean where detid not in ({BUSY_SQL})")
def anti_isin(spark, sf):
    listed = views.detectors(spark, sf).where("fclass = 'BUILDING'")
    return joins.drop_keys(clean_rows(spark, sf), listed, "detid").select("row_id", "detid")


FIRST_SQL = """select detid, row_id, traffic from (
    select *, row_number() over (partition by detid order by day, interval_s, row_id) as rn from indexed) where rn = 1"""


@query("dedup_then_join", f"select f.detid, f.row_id, {r('d.lon')} as lon, {r('d.lat')} as lat from ({FIRST_SQL}) f left join detectors d using (detid)")
def dedup_then_join(spark, sf):
    first = joins.first_per_key(indexed(spark, sf), ["detid"], outliers.READING_ORDER)
    rows = joins.with_detectors(first, views.detectors(spark, sf), columns=("lon", "lat"))
    return rounded(rows.select("detid", "row_id", "lon", "lat"))


@query("dedup_first", f"select detid, row_id, {r('traffic')} as traffic from ({FIRST_SQL})")
def dedup_first(spark, sf):
    first = joins.first_per_key(indexed(spark, sf), ["detid"], outliers.READING_ORDER)
    return rounded(first.select("detid", "row_id", "traffic"))


# -- outlier filters ----------------------------------------------------------------------------


def fence_sql(table: str, keys: str, column: str, factor: float) -> str:
    q1, q3 = (f"quantile_cont({column}::double, {p})" for p in (0.25, 0.75))
    return (
        f"select {keys}, {q1} - {factor}::double * ({q3} - {q1}) as lower, "
        f"{q3} + {factor}::double * ({q3} - {q1}) as upper from {table} group by {keys}"
    )


@query(
    "drop_outliers",
    f"""select x.row_id, x.detid, {r('x.traffic')} as traffic from indexed x
        join ({fence_sql('indexed', 'detid', 'traffic', 2)}) f using (detid) where x.traffic between f.lower and f.upper""",
)
def drop_outliers(spark, sf):
    rows = outliers.drop_outliers(indexed(spark, sf), "traffic", factor=2)
    return rounded(rows.select("row_id", "detid", "traffic"))


@query(
    "drop_outliers_global",
    f"""select x.row_id, {r('x.price')} as price from dense x,
        ({fence_sql('(select 1 as one, price from dense)', 'one', 'price', 0.5)}) f where x.price between f.lower and f.upper""",
)
def drop_outliers_global(spark, sf):
    rows = outliers.drop_outliers(views.dense(spark, sf), "price", keys=(), factor=0.5)
    return rounded(rows.select("row_id", "price"))


def clip_sql(table: str, order: str, column: str, factor: float, group_bounds: bool) -> str:
    scope = "detid" if group_bounds else "detid, bucket"
    join = "using (detid)" if group_bounds else "using (detid, bucket)"
    return f"""
    select row_id, detid, bucket, case when v < lower or v > upper then mean else v end as v from (
      with numbered as (select row_id, detid, {column}::double as v,
          row_number() over (partition by detid order by {order}) - 1 as pos,
          count(*) over (partition by detid) as n from {table}),
        bucketed as (select row_id, detid, v, case when n < 24 then 23 else least(pos // (n // 24), 23) end as bucket from numbered),
        fences as ({fence_sql('bucketed', scope, 'v', factor)}),
        means as (select detid, bucket, avg(v) as mean from bucketed group by all)
      select b.*, f.lower, f.upper, m.mean from bucketed b join fences f {join} join means m using (detid, bucket))"""


@query(
    "clip_outliers",
    f"""select a.row_id, a.detid, {r('a.v')} as occ, {r('b.v')} as flow
        from ({clip_sql('clean', 'day, interval_s, row_id', 'occ', 0.3717, False)}) a
        join ({clip_sql('clean', 'day, interval_s, row_id', 'flow', 0.3717, False)}) b using (row_id)""",
)
def clip_outliers(spark, sf):
    rows = outliers.clip_outliers(clean_rows(spark, sf), ["occ", "flow"], factor=0.3717)
    return rounded(rows.select("row_id", "detid", "occ", "flow"))


@query(
    "clip_outliers_dense",
    f"select row_id, detid, {r('v')} as price from ({clip_sql('dense', 'day, row_id', 'price', 0.7, False)})",
)
def clip_outliers_dense(spark, sf):
    rows = outliers.clip_outliers(
        views.dense(spark, sf).select("row_id", "detid", "day", "price"), ["price"], factor=0.7, order=("day", "row_id"), slot=("day",)
    )
    return rounded(rows.select("row_id", "detid", "price"))


@query(
    "clip_outliers_v0",
    f"select row_id, detid, {r('v')} as price from ({clip_sql('dense', 'day, row_id', 'price', 0.4, True)})",
)
def clip_outliers_v0(spark, sf):
    rows = outliers.clip_outliers(
        views.dense(spark, sf).select("row_id", "detid", "day", "price"), ["price"], factor=0.4, order=("day", "row_id"), slot=("day",), bounds="group"
    )
    return rounded(rows.select("row_id", "detid", "price"))


@query(
    "drop_flatline",
    """select row_id, detid, day, cast(flow as bigint) as flow from (
         select *, count(flow) over (partition by extract(year from day), detid, flow) as m from dense) where m <= 4 or flow is null""",
)
def drop_flatline(spark, sf):
    # The test data hold few rows per day, so a year stands for the day and 4 for 250.
    rows = views.dense(spark, sf).withColumn("year", F.year("day"))
    kept = outliers.drop_flatline(rows, "flow", keys=("year", "detid"), max_repeats=4)
    return kept.select("row_id", "detid", "day", F.col("flow").cast("bigint").alias("flow"))


@query(
    "drop_freq_outliers",
    """with counts as (select detid, flow, count(*) as m from dense where flow is not null group by all),
       fences as (select detid, quantile_cont(m::double, 0.25) - 0.8::double * (quantile_cont(m::double, 0.75) - quantile_cont(m::double, 0.25)) as lower,
                  quantile_cont(m::double, 0.75) + 0.8::double * (quantile_cont(m::double, 0.75) - quantile_cont(m::double, 0.25)) as upper
                  from counts group by 1)
       select x.row_id, x.detid, cast(x.flow as bigint) as flow from dense x join counts c on x.detid = c.detid and x.flow = c.flow
       join fences f on x.detid = f.detid where c.m between f.lower and f.upper""",
)
def drop_freq_outliers(spark, sf):
    kept = outliers.drop_freq_outliers(views.dense(spark, sf), "flow", factor=0.8)
    return kept.select("row_id", "detid", F.col("flow").cast("bigint").alias("flow"))
