"""Aggregates and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, joins, keyed, metrics, quality
from ..sources import views
from .base import clean_rows, day_split, hourly, indexed, query, r, rounded, train_test


@query(
    "hourly_mean",
    f"select interval_s, day, detid, weekday, {r('traffic')} as traffic, {r('flow')} as flow, {r('occ')} as occ from hourly",
)
def hourly_mean(spark, sf):
    return rounded(hourly(spark, sf))


@query(
    "quartiles",
    f"""select detid, {r('quantile_cont(traffic::double, 0.25)')} as q1, {r('quantile_cont(traffic::double, 0.5)')} as q2,
        {r('quantile_cont(traffic::double, 0.75)')} as q3 from indexed group by 1""",
)
def quartiles(spark, sf):
    q = keyed.exact_quantiles(indexed(spark, sf), ["detid"], "traffic", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return rounded(q)


@query(
    "quartiles_dense",
    f"""select detid, {r('quantile_cont(price::double, 0.25)')} as q1, {r('quantile_cont(price::double, 0.75)')} as q3,
        {r('quantile_cont(flow::double, 0.1)')} as flow_p10, {r('quantile_cont(flow::double, 0.9)')} as flow_p90
        from dense group by 1""",
)
def quartiles_dense(spark, sf):
    rows = views.dense(spark, sf)
    price = keyed.exact_quantiles(rows, ["detid"], "price", {"q1": 0.25, "q3": 0.75})
    flow = keyed.exact_quantiles(rows, ["detid"], "flow", {"flow_p10": 0.1, "flow_p90": 0.9})
    return rounded(price.join(flow, "detid"))


@query("detector_mean", f"select detid, {r('avg(traffic)')} as mean_traffic from indexed group by 1")
def detector_mean(spark, sf):
    return rounded(indexed(spark, sf).groupBy("detid").agg(F.avg("traffic").alias("mean_traffic")))


@query(
    "iqr_range",
    f"""select detid, {r('quantile_cont(traffic::double, 0.75) - quantile_cont(traffic::double, 0.25)')} as iqr,
        {r('max(traffic) - min(traffic)')} as total_range from indexed group by 1""",
)
def iqr_range(spark, sf):
    return rounded(quality.iqr_range(indexed(spark, sf)))


@query("daily_counts", "select detid, day, count(*) as n_rows from clean group by all")
def daily_counts(spark, sf):
    return quality.daily_counts(clean_rows(spark, sf))


@query(
    "valid_days",
    "select detid, count(*) filter (where n >= 3) as valid_days from (select detid, day, count(*) as n from clean group by all) group by 1",
)
def valid_days(spark, sf):
    return quality.valid_days(clean_rows(spark, sf), 3)


@query("weekday_nunique", "select detid, count(distinct weekday) as n_weekdays from clean group by 1")
def weekday_nunique(spark, sf):
    return clean_rows(spark, sf).groupBy("detid").agg(F.count_distinct("weekday").alias("n_weekdays"))


@query("value_counts", "select error, count(*) as n from readings where error is not null group by 1")
def value_counts(spark, sf):
    return aggregate.value_counts(views.readings(spark, sf), "error")


@query("value_counts_by_key", "select detid, cast(flow as bigint) as flow, count(*) as n from dense group by all")
def value_counts_by_key(spark, sf):
    counts = aggregate.value_counts(views.dense(spark, sf), "flow", ["detid"])
    return counts.withColumn("flow", F.col("flow").cast("bigint"))


def summary_sql(table: str, keys: str) -> str:
    """Mode by rank: most frequent rounded value, the smallest one on a tie."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    using = f"using ({keys})" if keys else "on true"
    group = f"group by {keys}" if keys else ""
    return f"""
      with counts as (select {lead}round_even(traffic, 0) as v, count(*) as m from {table} group by all),
        modes as (select * from (select *, row_number() over ({part} order by m desc, v) as rn from counts) where rn = 1),
        ends as (select {lead}min(traffic) as lo, avg(traffic) as mean, max(traffic) as hi from {table} {group})
      select {lead}{r('lo')} as min_value, {r('mean')} as mean_value, {r('v')} as mode_value, {r('hi')} as max_value
      from ends join modes {using}"""


@query("summary_stats", summary_sql("hourly", ""))
def summary_stats(spark, sf):
    return rounded(aggregate.summary(hourly(spark, sf)))


@query(
    "summary_by_class",
    "with classed as (select h.*, d.fclass from hourly h join detectors d using (detid)), "
    + summary_sql("classed", "fclass").strip()[5:],
)
def summary_by_class(spark, sf):
    rows = joins.with_detectors(hourly(spark, sf), views.detectors(spark, sf), columns=("fclass",), how="inner")
    return rounded(aggregate.summary(rows, keys=["fclass"]))


DESCRIBED = ("flow", "occ", "traffic")


@query(
    "describe",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as n, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std,
        {r(f'min({c})')} as min, {r(f'max({c})')} as max, {r(f'quantile_cont({c}::double, 0.25)')} as q25,
        {r(f'quantile_cont({c}::double, 0.5)')} as q50, {r(f'quantile_cont({c}::double, 0.75)')} as q75 from indexed"""
        for c in DESCRIBED
    ),
)
def describe(spark, sf):
    return rounded(aggregate.describe(indexed(spark, sf), DESCRIBED))


READING_COLUMNS = ("row_id", "detid", "day", "interval_s", "flow", "occ", "error", "speed")
READING_TYPES = ("bigint", "string", "date", "int", "double", "double", "int", "double")


@query(
    "null_counts",
    " union all ".join(
        f"""select '{c}' as "column", count(*) - count({c}) as n_null from readings""" for c in READING_COLUMNS
    ),
)
def null_counts(spark, sf):
    return aggregate.null_counts(views.readings(spark, sf))


@query(
    "frame_info",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as n_not_null, '{t}' as type from readings"""
        for c, t in zip(READING_COLUMNS, READING_TYPES)
    ),
)
def frame_info(spark, sf):
    return aggregate.frame_info(views.readings(spark, sf))


@query(
    "distinct_count",
    """select 'all' as step, count(distinct detid) as n_detid, count(distinct day) as n_day from readings
       union all select 'clean', count(distinct detid), count(distinct day) from clean""",
)
def distinct_count(spark, sf):
    before = aggregate.distinct_counts(views.readings(spark, sf), ["detid", "day"])
    after = aggregate.distinct_counts(clean_rows(spark, sf), ["detid", "day"])
    return before.select(F.lit("all").alias("step"), "*").unionByName(after.select(F.lit("clean").alias("step"), "*"))


@query("distinct_values", "select distinct interval_s from hourly")
def distinct_values(spark, sf):
    return hourly(spark, sf).select("interval_s").distinct()


@query("sorted_unique", "select distinct detid from clean order by detid")
def sorted_unique(spark, sf):
    return clean_rows(spark, sf).select("detid").distinct().orderBy("detid")


@query(
    "split_ratio",
    f"select {r('''count(*) filter (where role = 'test') / count(*) filter (where role = 'train')''')} as ratio from split_rows",
)
def split_ratio(spark, sf):
    from ..operators.split import role_ratio

    return rounded(role_ratio(day_split(spark, sf)))


CORRELATED = ("interval_s", "flow", "occ", "traffic")


@query(
    "corr_matrix",
    " union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, {r(f'corr({a}, {b})')} as r from indexed"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def corr_matrix(spark, sf):
    return rounded(aggregate.corr_matrix(indexed(spark, sf), CORRELATED))


@query(
    "having_multi",
    "select c_custkey, linkid from (select c_custkey, c_custkey % 997 as linkid, count(*) over (partition by c_custkey % 997) as m from customer) where m > 1",
)
def having_multi(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", (F.col("c_custkey") % 997).alias("linkid"))
    return aggregate.having_multi(rows, "linkid")


@query(
    "group_head",
    f"""select detid, row_id, {r('flow')} as flow from (
          select *, row_number() over (partition by detid order by day, interval_s, row_id) as rn from clean) where rn <= 5""",
)
def group_head(spark, sf):
    rows = aggregate.group_head(clean_rows(spark, sf), ["detid"], ["day", "interval_s", "row_id"])
    return rounded(rows.select("detid", "row_id", "flow"))


@query("limit_rows", f"select row_id, detid, {r('flow')} as flow from readings order by row_id limit 100")
def limit_rows(spark, sf):
    return rounded(views.readings(spark, sf).select("row_id", "detid", "flow").orderBy("row_id").limit(100))


@query("sample_key", "select detid from (select distinct detid from clean) order by md5('27|' || detid), detid limit 10")
def sample_key(spark, sf):
    return aggregate.sample_keys(clean_rows(spark, sf), "detid", 10)


@query("union_all", "select row_id, detid, 'low' as part from indexed where traffic <= 1 union all select row_id, detid, 'high' from indexed where traffic >= 170")
def union_all(spark, sf):
    rows = indexed(spark, sf).select("row_id", "detid", "traffic")
    low = rows.where("traffic <= 1").select("row_id", "detid", F.lit("low").alias("part"))
    return low.unionByName(rows.where("traffic >= 170").select("row_id", "detid", F.lit("high").alias("part")))


@query("weekday_profile", f"select detid, weekday, interval_s, {r('avg(traffic)')} as mean_traffic from hourly group by 1, 2, 3")
def weekday_profile(spark, sf):
    return rounded(aggregate.weekday_profile(hourly(spark, sf)))


@query(
    "global_quantile",
    f"""select {r('avg(traffic)')} as mean_traffic, {r('quantile_cont(traffic::double, 0.25)')} as q25,
        {r('quantile_cont(traffic::double, 0.72)')} as q72 from hourly""",
)
def global_quantile(spark, sf):
    rows = hourly(spark, sf)
    q = keyed.exact_quantiles(rows, (), "traffic", {"q25": 0.25, "q72": 0.72})
    ends = q.select(F.struct("q25", "q72")).scalar()
    one = rows.agg(F.avg("traffic").alias("mean_traffic")).withColumn("_q", ends)
    return rounded(one.select("mean_traffic", "_q.q25", "_q.q72"))


# -- metrics: the mean index per sensor, weekday and hour of the train set is the forecast ------

PROFILE = """with pairs as (select t.detid, t.traffic as y, p.p from test t
  join (select detid, weekday, interval_s, avg(traffic) as p from train group by 1, 2, 3) p using (detid, weekday, interval_s)) """
R2 = """case when count(*) < 2 then null when max(y) = min(y) then case when sum((y - p) * (y - p)) = 0 then 1.0 else 0.0 end
  else 1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0) end"""
SCORES = f"{r('avg(abs(y - p))')} as MAE, {r('avg((y - p) * (y - p))')} as MSE, {r(R2)} as R2"


def profile_pairs(spark, sf):
    train, test = train_test(spark, sf)
    profile = aggregate.weekday_profile(train).withColumnRenamed("mean_traffic", "traffic")
    return metrics.join_actual(test, profile)


@query(
    "join_eval",
    f"""select detid, weekday, interval_s, {r('t.traffic')} as traffic_actual, {r('p.p')} as traffic_pred from test t
        join (select detid, weekday, interval_s, avg(traffic) as p from train group by 1, 2, 3) p using (detid, weekday, interval_s)""",
)
def join_eval(spark, sf):
    return rounded(profile_pairs(spark, sf))


@query("regression_metrics", PROFILE + f"select detid, {SCORES} from pairs group by 1")
def regression_metrics(spark, sf):
    return rounded(metrics.regression_metrics(profile_pairs(spark, sf)))


@query("pooled_metrics", PROFILE + f"select {SCORES} from pairs")
def pooled_metrics(spark, sf):
    return rounded(metrics.regression_metrics(profile_pairs(spark, sf), []))


@query(
    "macro_average",
    PROFILE.rstrip()
    + f""", scores as (select avg(abs(y - p)) as a, avg((y - p) * (y - p)) as b, {R2} as c from pairs group by detid)
        select {r('avg(a)')} as avg_MAE, {r('avg(b)')} as avg_MSE, {r('avg(c)')} as avg_R2 from scores""",
)
def macro_average(spark, sf):
    return rounded(metrics.macro_average(metrics.regression_metrics(profile_pairs(spark, sf))))


@query(
    "more_metrics",
    PROFILE
    + f"""select detid, {r('case when max(y) = min(y) then null else 1 - var_pop(y - p) / var_pop(y) end')} as explained_variance,
        {r('sqrt(avg((y - p) * (y - p)))')} as RMSE, {r('quantile_cont(abs(y - p)::double, 0.5)')} as median_ae
        from pairs group by 1""",
)
def more_metrics(spark, sf):
    return rounded(metrics.more_metrics(profile_pairs(spark, sf)))
