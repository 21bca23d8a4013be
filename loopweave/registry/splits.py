"""Train/test splits."""

from __future__ import annotations

from ..operators import split
from .base import day_split, hourly, query, r, rounded


def draw_sql(lead: str) -> str:
    """Two of 24 slots by Floyd's sampling from two hashes."""

    def h(j: int) -> str:
        return f"(('0x' || substr(md5(concat_ws('|', '27', {lead}cast(day as varchar), detid, '{j}')), 1, 8))::bigint)"

    return f"""({h(22)} % 23) as s0, case when {h(23)} % 24 = {h(22)} % 23 then 23 else {h(23)} % 24 end as s1"""


@query(
    "split_sniper",
    f"""select detid, day, interval_s, {r('traffic')} as traffic,
        case when interval_s // 3600 in (s0, s1) then 'test' else 'train' end as role from (select *, {draw_sql('')} from hourly)""",
)
def split_sniper(spark, sf):
    rows = split.split_sniper(hourly(spark, sf), seed=27)
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "role"))


@query("split_day", f"select detid, day, interval_s, {r('traffic')} as traffic, role from split_rows")
def split_day(spark, sf):
    return rounded(day_split(spark, sf).select("detid", "day", "interval_s", "traffic", "role"))


UNITS = """with weeks as (select *, cast(weekofyear(day) as integer) as week from hourly),
  units as (select distinct detid, week, weekday from weeks),
  kept as (select detid, week, max(all_days) - count(*) filter (where holders = 1) as kept
    from (select u.*, count(*) over (partition by detid, weekday) as holders, w.all_days from units u
          join (select detid, count(distinct weekday) as all_days from units group by 1) w using (detid)) group by 1, 2),
  drawn as (select detid, week from (select *, row_number() over (partition by detid
      order by md5(concat_ws('|', '27', detid, cast(week as varchar))), week) as rn from kept where kept >= 5) where rn = 1)"""


@query(
    "split_week",
    UNITS
    + f""" select w.detid, w.day, w.interval_s, {r('w.traffic')} as traffic, w.week,
        case when d.week is null then 'train' else 'test' end as role
        from weeks w left join drawn d on w.detid = d.detid and w.week = d.week""",
)
def split_week(spark, sf):
    rows = split.split_week(hourly(spark, sf), seed=27)
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "week", "role"))


TWO_DAYS = """with days as (select distinct detid, day, weekday, md5(concat_ws('|', '27', detid, cast(day as varchar))) as h from hourly),
  spare as (select *, row_number() over (partition by detid, weekday order by h desc, day desc) as last,
      (select count(distinct weekday) from days x where x.detid = days.detid) as all_days from days),
  free as (select *, row_number() over (partition by detid order by h, day) as rn, count(*) over (partition by detid) as n
      from spare where last > 1 and all_days = 7),
  drawn as (select detid, day from free where n >= 2 and rn <= 2)"""
TWO_WEEKS = """with weeks as (select *, cast(weekofyear(day) as integer) as week from hourly),
  units as (select distinct detid, week, weekday from weeks),
  ranked as (select detid, week, row_number() over (partition by detid order by md5(concat_ws('|', '27', detid, cast(week as varchar))), week) as rn
      from (select distinct detid, week from units)),
  pairs as (select a.detid, a.week as w1, b.week as w2, a.rn as r1, b.rn as r2 from ranked a join ranked b on a.detid = b.detid and a.rn < b.rn),
  good as (select p.* from pairs p join units u on u.detid = p.detid and u.week not in (p.w1, p.w2)
      group by all having count(distinct u.weekday) >= 5),
  best as (select *, row_number() over (partition by detid order by r1, r2) as pick from good),
  drawn as (select detid, unnest([w1, w2]) as week from best where pick = 1)"""


@query(
    "split_week_two",
    TWO_WEEKS
    + f""" select w.detid, w.day, w.interval_s, {r('w.traffic')} as traffic, w.week,
        case when d.week is null then 'train' else 'test' end as role
        from weeks w left join drawn d on w.detid = d.detid and w.week = d.week""",
)
def split_week_two(spark, sf):
    rows = split.split_week(hourly(spark, sf), k=2, seed=27)
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "week", "role"))


@query(
    "split_day_two",
    TWO_DAYS
    + f""" select h.detid, h.day, h.interval_s, {r('h.traffic')} as traffic, case when d.day is null then 'train' else 'test' end as role
        from hourly h left join drawn d on h.detid = d.detid and h.day = d.day""",
)
def split_day_two(spark, sf):
    rows = split.split_day(hourly(spark, sf), k=2, seed=27)
    return rounded(rows.select("detid", "day", "interval_s", "traffic", "role"))


@query("unsplittable", "select detid from split_rows group by 1 having count(*) filter (where role = 'test') = 0")
def unsplittable(spark, sf):
    return split.unsplittable(day_split(spark, sf))


SPLIT_LEAD = "cast(split_id as varchar), "


@query(
    "split_dispatch",
    f"""select split_id, detid, weekday, interval_s, {r('traffic')} as traffic,
        case when interval_s // 3600 in (s0, s1) then 'test' else 'train' end as role
        from (select *, {draw_sql(SPLIT_LEAD)} from hourly, (select cast(range as integer) as split_id from range(3)))""",
)
def split_dispatch(spark, sf):
    rows = split.split("Sniper", hourly(spark, sf), 3, seed=27)
    return rounded(rows.select("split_id", "detid", "weekday", "interval_s", "traffic", "role"))


def dispatch_sql(unit: str, least: int, splits: int = 3) -> str:
    """``drawn``: per split and sensor the first admissible unit in hash order."""
    return f"""with rows_ as (select *, {unit} as unit from hourly),
      units as (select distinct detid, unit, weekday from rows_),
      kept as (select detid, unit, max(all_days) - count(*) filter (where holders = 1) as kept
        from (select u.*, count(*) over (partition by detid, weekday) as holders, w.all_days from units u
              join (select detid, count(distinct weekday) as all_days from units group by 1) w using (detid)) group by 1, 2),
      drawn as (select split_id, detid, unit from (select split_id, detid, unit, row_number() over (partition by split_id, detid
          order by md5(concat_ws('|', '27', cast(split_id as varchar), detid, cast(unit as varchar))), unit) as rn
        from kept, (select cast(range as integer) as split_id from range({splits})) where kept >= {least}) where rn = 1)
      select x.split_id, h.detid, h.weekday, h.interval_s, {r('h.traffic')} as traffic, case when d.unit is null then 'train' else 'test' end as role
      from rows_ h cross join (select cast(range as integer) as split_id from range({splits})) x
      left join drawn d on d.split_id = x.split_id and d.detid = h.detid and d.unit = h.unit"""


@query("split_dispatch_day", dispatch_sql("day", 7))
def split_dispatch_day(spark, sf):
    rows = split.split("Day", hourly(spark, sf), 3, seed=27)
    return rounded(rows.select("split_id", "detid", "weekday", "interval_s", "traffic", "role"))


@query("split_dispatch_week", dispatch_sql("cast(weekofyear(day) as integer)", 5))
def split_dispatch_week(spark, sf):
    rows = split.split("Week", hourly(spark, sf), 3, seed=27)
    return rounded(rows.select("split_id", "detid", "weekday", "interval_s", "traffic", "role"))
