"""Encodings, models, forecasts and their scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import WEEKDAYS, weekday_number
from ..models import baseline, forest, knn, knn_pooled, polynomial, seasonal
from ..operators import features, keyed
from ..operators.metrics import macro_average, regression_metrics
from ..plans import dataset, predictions
from ..sources import views
from .aggregates import R2, SCORES
from .base import WEEKDAY_SQL, clean_rows, hourly, query, r, rounded, train_test

W = WEEKDAY_SQL.format("weekday")

# -- encodings ----------------------------------------------------------------------------------


@query(
    "label_encode",
    """select c.row_id, c.detid, k.code from clean c join (
         select detid, cast(row_number() over (order by detid) - 1 as bigint) as code from (select distinct detid from clean)) k using (detid)""",
)
def label_encode(spark, sf):
    return features.label_encode(clean_rows(spark, sf).select("row_id", "detid"), "detid")


@query(
    "label_encode_test",
    """select t.detid, t.day, t.interval_s, k.code from test t left join (
         select detid, cast(row_number() over (order by detid) - 1 as bigint) as code
         from (select distinct detid from train)) k using (detid)""",
)
def label_encode_test(spark, sf):
    train, test = train_test(spark, sf)
    codes = features.label_codes(train, "detid")
    return features.label_encode(test.select("detid", "day", "interval_s"), "detid", codes)


@query(
    "factorize",
    """select c.row_id, c.detid, k.code from clean c join (
         select detid, cast(row_number() over (order by first) - 1 as bigint) as code
         from (select detid, min(row_id) as first from clean group by 1)) k using (detid)""",
)
def factorize(spark, sf):
    return features.factorize(clean_rows(spark, sf).select("row_id", "detid"), "detid", "row_id", block=1000)


@query(
    "onehot_encode",
    "select row_id, "
    + ", ".join(f"""case when weekday = '{d}' then 1.0::double else 0.0::double end as "weekday_{d}" """ for d in WEEKDAYS)
    + " from clean",
)
def onehot_encode(spark, sf):
    return features.onehot_encode(clean_rows(spark, sf).select("row_id", "weekday"), "weekday")


@query("cross_slots", "select x.c_custkey, cast(s.range * 3600 as integer) as week_second from customer x, range(168) s")
def cross_slots(spark, sf):
    keys = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey")
    slots = baseline.week_slots(keys, 3600)
    second = weekday_number("weekday") * 86400 + F.col("interval_s")
    return slots.select("c_custkey", second.cast("int").alias("week_second"))


# -- random baseline ----------------------------------------------------------------------------

HASH = "('0x' || substr(md5(concat_ws('|', '27', detid, weekday, cast(interval_s as varchar))), 1, 8))::bigint"
SLOTS = f"""slots as (select w.weekday, cast(s.range * 300 as integer) as interval_s
  from (values {', '.join(f"('{d}')" for d in WEEKDAYS)}) w(weekday), range(288) s)"""
RANGES = """ranges as (select detid, cast(round_even(quantile_cont(traffic::double, 0.25), 0) as bigint) as low,
  cast(round_even(quantile_cont(traffic::double, 0.75), 0) as bigint) as high from train group by 1)"""
MODEL = f"""{SLOTS}, {RANGES}, model as (select detid, weekday, interval_s, low + {HASH} % (high - low + 1) as traffic from ranges, slots)"""


@query("model_random", f"with {MODEL} select * from model")
def model_random(spark, sf):
    return baseline.fit_random(train_test(spark, sf)[0])


@query(
    "model_random_exclusive",
    f"""with {SLOTS}, {RANGES} select detid, weekday, interval_s,
        low + {HASH} % (greatest(low, high - 1) - low + 1) as traffic from ranges, slots""",
)
def model_random_exclusive(spark, sf):
    return baseline.fit_random(train_test(spark, sf)[0], inclusive=False)


@query(
    "model_random_float",
    f"""with {SLOTS}, ends as (select detid, min(traffic) as low, max(traffic) as high from train group by 1)
        select detid, weekday, interval_s, {r(f'low + (high - low) * ({HASH}) / 4294967296')} as traffic from ends, slots""",
)
def model_random_float(spark, sf):
    return rounded(baseline.fit_random(train_test(spark, sf)[0], kind="float"))


@query(
    "predict_random",
    f"with {MODEL} select detid, interval_s, traffic from model where weekday = 'Tuesday' and interval_s % 3600 = 0",
)
def predict_random(spark, sf):
    return baseline.predict_random(baseline.fit_random(train_test(spark, sf)[0]), "Tuesday")


RANDOM_PAIRS = f"""{MODEL}, pairs as (select t.detid, t.traffic as y, m.traffic as p from test t join model m using (detid, weekday, interval_s))"""


@query("score_random", f"with {RANDOM_PAIRS} select detid, {SCORES} from pairs group by 1")
def score_random(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(baseline.score_random(test, baseline.fit_random(train)))


@query(
    "eval_random",
    f"""with {RANDOM_PAIRS}, scores as (select avg(abs(y - p)) as a, avg((y - p) * (y - p)) as b, {R2} as c from pairs group by detid)
        select {r('avg(a)')} as avg_MAE, {r('avg(b)')} as avg_MSE, {r('avg(c)')} as avg_R2 from scores""",
)
def eval_random(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(baseline.eval_random(test, baseline.fit_random(train)))


# -- nearest neighbours per sensor: the oracle compares every pair ------------------------------


def setting_sql(k: int, p: int, weights: str, rn: str = "rn") -> str:
    if weights == "uniform":
        return f"avg(y) filter (where {rn} <= {k})"
    d = f"d{p}"
    return (
        f"coalesce(avg(y) filter (where {rn} <= {k} and {d} = 0), "
        f"sum(y / nullif({d}, 0)) filter (where {rn} <= {k}) / sum(1 / nullif({d}, 0)) filter (where {rn} <= {k}))"
    )


SETTINGS = knn.settings()
ALL_SETTINGS = ", ".join(f"{setting_sql(*s)} as s{i}" for i, s in enumerate(SETTINGS))


def near_sql(train: str, queries: str, keys: str, match: str) -> str:
    outer = keys.replace("q.", "")
    return f"""select {outer}, w, h, y, rn, d1, d2 from (
      select {keys}, q.w, q.h, t.y, abs(t.h - q.h) + abs(t.w - q.w) as d1,
        sqrt(((t.h - q.h)::double * (t.h - q.h) + (t.w - q.w) * (t.w - q.w))) as d2,
        row_number() over (partition by {keys}, q.w, q.h order by abs(t.h - q.h) + abs(t.w - q.w), t.day, t.h) as rn
      from {queries} q join {train} t on {match}) where rn <= 10"""


FOLDED = f"""folded as (select detid, day, interval_s as h, cast({W} as integer) as w, traffic as y,
    (pos >= (n // 5) + least(1, n % 5))::int + (pos >= 2 * (n // 5) + least(2, n % 5))::int
    + (pos >= 3 * (n // 5) + least(3, n % 5))::int + (pos >= 4 * (n // 5) + least(4, n % 5))::int as fold
  from (select *, row_number() over (partition by detid order by day, interval_s) - 1 as pos,
        count(*) over (partition by detid) as n from train))"""
CV = f"""{FOLDED}, near as ({near_sql('folded', '(select distinct detid, fold, w, h from folded)', 'q.detid, q.fold', 'q.detid = t.detid and q.fold <> t.fold')}),
  shots as (select detid, fold, w, h, {ALL_SETTINGS} from near group by detid, fold, w, h),
  per_fold as (select detid, fold, {', '.join(f'avg(abs(f.y - s{i})) as s{i}' for i in range(len(SETTINGS)))}
    from folded f join shots using (detid, fold, w, h) group by detid, fold),
  means as (select detid, {', '.join(f'avg(s{i}) as s{i}' for i in range(len(SETTINGS)))} from per_fold group by detid),
  scores as ({' union all '.join(f"select detid, {i} as position, {k} as k, {p} as p, '{w}' as weights, s{i} as mae from means" for i, (k, p, w) in enumerate(SETTINGS))}),
  best as (select detid, k, p, weights, mae from (
    select *, row_number() over (partition by detid order by round(mae, 9), position) as rn from scores) where rn = 1)"""


@query("cv_knn", f"with {CV} select detid, position, k, p, weights, {r('mae')} as mae from scores")
def cv_knn(spark, sf):
    return rounded(knn.cv_scores(train_test(spark, sf)[0]))


@query("model_knn", f"with {CV} select detid, k, p, weights, {r('mae')} as mae from best")
def model_knn(spark, sf):
    return rounded(knn.tune_knn(train_test(spark, sf)[0]))


CHOSEN = "case " + " ".join(
    f"when best.k = {k} and best.p = {p} and best.weights = '{w}' then s{i}" for i, (k, p, w) in enumerate(SETTINGS)
) + " end"


def forecast_sql(queries: str) -> str:
    return f"""points as (select detid, day, interval_s as h, cast({W} as integer) as w, traffic as y from train),
      asked as ({queries}),
      hits as ({near_sql('points', '(select distinct detid, w, h from asked)', 'q.detid', 'q.detid = t.detid')}),
      fans as (select detid, w, h, {ALL_SETTINGS} from hits group by detid, w, h),
      forecast as (select detid, w, h, {CHOSEN} as traffic from fans join best using (detid))"""


TUESDAY = "select detid, 1 as w, cast(s.range * 3600 as integer) as h from best, range(24) s"


@query(
    "predict_knn",
    f"with {CV}, {forecast_sql(TUESDAY)} select detid, h as interval_s, {r('traffic')} as traffic from forecast",
)
def predict_knn(spark, sf):
    train, _ = train_test(spark, sf)
    best = keyed.settle(knn.tune_knn(train))
    return rounded(knn.predict_knn(train, best, "Tuesday", baseline.DAY_HOURS))


TESTED = f"select detid, cast({W} as integer) as w, interval_s as h, traffic as y from test"


@query(
    "eval_knn",
    f"""with {CV}, {forecast_sql(TESTED)}, pairs as (select a.detid, a.y, f.traffic as p from asked a join forecast f using (detid, w, h))
        select detid, {SCORES} from pairs group by 1""",
)
def eval_knn(spark, sf):
    train, test = train_test(spark, sf)
    best = keyed.settle(knn.tune_knn(train))
    return rounded(knn.eval_knn(train, test, best))


# -- nearest neighbours over all sensors --------------------------------------------------------

CODES = "codes as (select detid, cast(row_number() over (order by detid) - 1 as bigint) as code from (select distinct detid from train))"


def pooled_near_sql(train: str, queries: str, keys: str, match: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""select {lead}code, w, h, y, rn1, rn2, d1, d2 from (
      select *, row_number() over (partition by {lead}code, w, h order by d1, tcode, day, th) as rn1,
        row_number() over (partition by {lead}code, w, h order by d2, tcode, day, th) as rn2 from (
        select {'q.' + keys + ', ' if keys else ''}q.code, q.w, q.h, t.y, t.code as tcode, t.day, t.h as th,
          (abs(t.code - q.code) + abs(t.h - q.h) + abs(t.w - q.w))::double as d1,
          sqrt(((t.code - q.code)::double * (t.code - q.code) + (t.h - q.h)::double * (t.h - q.h) + (t.w - q.w) * (t.w - q.w))) as d2
        from {queries} q join {train} t on {match})) where rn1 <= 10 or rn2 <= 10"""


POOLED = f"""{CODES}, points as (select code, day, interval_s as h, cast({W} as integer) as w, traffic as y from train join codes using (detid)),
  asked as (select detid, code, weekday, interval_s, interval_s as h, cast({W} as integer) as w, traffic as y from test join codes using (detid)),
  hits as ({pooled_near_sql('points', '(select distinct code, w, h from asked)', '', 'true')}),
  shots as (select code, w, h, {setting_sql(10, 1, 'distance', 'rn1')} as p1, {setting_sql(5, 2, 'uniform', 'rn2')} as p2 from hits group by 1, 2, 3)"""


@query(
    "model_knn4d",
    f"with {POOLED} select detid, weekday, interval_s, {r('y')} as traffic_actual, {r('p1')} as traffic_pred from asked join shots using (code, w, h)",
)
def model_knn4d(spark, sf):
    train, test = train_test(spark, sf)
    codes = keyed.settle(features.label_codes(train, "detid"))
    return rounded(knn_pooled.forecast_pooled_knn(train, test, codes))


@query(
    "eval_knn4d",
    f"with {POOLED}, pairs as (select y, p2 as p from asked join shots using (code, w, h)) select {SCORES} from pairs",
)
def eval_knn4d(spark, sf):
    train, test = train_test(spark, sf)
    codes = keyed.settle(features.label_codes(train, "detid"))
    return rounded(knn_pooled.eval_pooled_knn(train, test, codes, 5, 2, "uniform"))


POOLED_FOLDED = f"""{CODES}, folded as (select code, day, h, w, y,
    (pos >= (n // 5) + least(1, n % 5))::int + (pos >= 2 * (n // 5) + least(2, n % 5))::int
    + (pos >= 3 * (n // 5) + least(3, n % 5))::int + (pos >= 4 * (n // 5) + least(4, n % 5))::int as fold
  from (select code, day, interval_s as h, cast({W} as integer) as w, traffic as y,
        row_number() over (order by code, day, interval_s) - 1 as pos, count(*) over () as n from train join codes using (detid)))"""


@query(
    "cv_knn4d",
    f"""with {POOLED_FOLDED},
      hits as ({pooled_near_sql('folded', '(select distinct fold, code, w, h from folded)', 'fold', 'q.fold <> t.fold')}),
      shots as (select fold, code, w, h, {', '.join(f"{setting_sql(*s, f'rn{s[1]}')} as s{i}" for i, s in enumerate(SETTINGS))} from hits group by 1, 2, 3, 4),
      per_fold as (select fold, {', '.join(f'avg(abs(y - s{i})) as s{i}' for i in range(len(SETTINGS)))} from folded join shots using (fold, code, w, h) group by 1),
      means as (select {', '.join(f'avg(s{i}) as s{i}' for i in range(len(SETTINGS)))} from per_fold)
      {' union all '.join(f"select {i} as position, {k} as k, {p} as p, '{w}' as weights, {r(f's{i}')} as mae from means" for i, (k, p, w) in enumerate(SETTINGS))}""",
)
def cv_knn4d(spark, sf):
    train, _ = train_test(spark, sf)
    codes = keyed.settle(features.label_codes(train, "detid"))
    return rounded(knn_pooled.tune_pooled_knn(train, codes))


def pooled_cv_sql(codes: str, name: str) -> str:
    """The 16 scores (position, k, p, weights, mae) from rows ``name`` of (code, day, h, w, y)."""
    return f"""folded as (select *, (pos >= (n // 5) + least(1, n % 5))::int + (pos >= 2 * (n // 5) + least(2, n % 5))::int
        + (pos >= 3 * (n // 5) + least(3, n % 5))::int + (pos >= 4 * (n // 5) + least(4, n % 5))::int as fold
        from (select *, row_number() over (order by code, day, h) - 1 as pos, count(*) over () as n from {name})),
      cv_hits as ({pooled_near_sql('folded', '(select distinct fold, code, w, h from folded)', 'fold', 'q.fold <> t.fold')}),
      cv_shots as (select fold, code, w, h, {', '.join(f"{setting_sql(*s, f'rn{s[1]}')} as s{i}" for i, s in enumerate(SETTINGS))} from cv_hits group by 1, 2, 3, 4),
      per_fold as (select fold, {', '.join(f'avg(abs(y - s{i})) as s{i}' for i in range(len(SETTINGS)))} from folded join cv_shots using (fold, code, w, h) group by 1),
      means as (select {', '.join(f'avg(s{i}) as s{i}' for i in range(len(SETTINGS)))} from per_fold),
      scores as ({' union all '.join(f"select {i} as position, {k} as k, {p} as p, '{w}' as weights, s{i} as mae from means" for i, (k, p, w) in enumerate(SETTINGS))}),
      best as (select * from scores order by round(mae, 9), position limit 1)"""


def tuned_pooled_sql(factor: int) -> str:
    """Test rows with the forecast of the best setting, codes ``factor`` apart."""
    code = f"cast({factor} * (row_number() over (order by detid) - 1) as bigint)"
    return f"""with codes as (select detid, {code} as code from (select distinct detid from train)),
      points as (select code, day, interval_s as h, cast({W} as integer) as w, traffic as y from train join codes using (detid)),
      {pooled_cv_sql('codes', 'points')},
      asked as (select detid, code, weekday, interval_s, interval_s as h, cast({W} as integer) as w, traffic as y from test join codes using (detid)),
      hits as ({pooled_near_sql('points', '(select distinct code, w, h from asked)', '', 'true')}),
      shots as (select code, w, h, {', '.join(f"{setting_sql(*s, f'rn{s[1]}')} as s{i}" for i, s in enumerate(SETTINGS))} from hits group by 1, 2, 3),
      pairs as (select detid, weekday, interval_s, y, {CHOSEN} as p, best.k as k, best.p as power, best.weights as weights
        from asked join shots using (code, w, h), best)"""


def _tuned_pooled(spark, sf, factor: int):
    train, test = train_test(spark, sf)
    codes = keyed.settle(features.label_codes(train, "detid").withColumn("code", F.col("code") * factor))
    k, p, weights = knn_pooled.best_pooled_setting(knn_pooled.tune_pooled_knn(train, codes))
    forecast = knn_pooled.forecast_pooled_knn(train, test, codes, k, p, weights)
    setting = {"k": k, "power": p, "weights": weights}
    return forecast.withColumns({c: F.lit(v) for c, v in setting.items()})


PAIR_SQL = f"select detid, weekday, interval_s, {r('y')} as traffic_actual, {r('pairs.p')} as traffic_pred, k, power, weights from pairs"


@query("model_knn4d_tuned", f"{tuned_pooled_sql(1)} {PAIR_SQL}")
def model_knn4d_tuned(spark, sf):
    return rounded(_tuned_pooled(spark, sf, 1))


@query("model_knn4d_far_codes", f"{tuned_pooled_sql(1000)} {PAIR_SQL}")
def model_knn4d_far_codes(spark, sf):
    return rounded(_tuned_pooled(spark, sf, 1000))


@query("eval_knn4d_tuned", f"{tuned_pooled_sql(1)} select {SCORES} from pairs")
def eval_knn4d_tuned(spark, sf):
    return rounded(regression_metrics(_tuned_pooled(spark, sf, 1), []))


# -- polynomial fits: the oracle builds orthogonal polynomials per sensor -----------------------


def _orthogonal(degree: int) -> str:
    """Three-term recurrence p(k+1) = (x - a) p(k) - b p(k-1); fit = sum of projections."""
    parts = ["o0 as (select detid, interval_s / 86400 as x, traffic::double as y, 0::double as prev, 1::double as cur, 0::double as fit, 1::double as last_norm from hourly)"]
    for k in range(degree + 1):
        parts.append(
            f"""n{k} as (select detid, sum(cur * cur) as norm, sum(x * cur * cur) as shift, sum(y * cur) as proj from o{k} group by 1)"""
        )
        parts.append(
            f"""o{k + 1} as (select o.detid, x, y, cur as prev,
              case when norm < 1e-9 then 0 else (x - shift / norm) * cur - {'0' if k == 0 else 'norm / last_norm * prev'} end as cur,
              fit + case when norm < 1e-9 then 0 else proj / norm * cur end as fit,
              case when norm < 1e-9 then 1 else norm end as last_norm from o{k} o join n{k} n using (detid))"""
        )
    return ", ".join(parts)


def poly_scores_sql(degree: int) -> str:
    return f"""with {_orthogonal(degree)}, pairs as (select detid, y, fit as p from o{degree + 1})
      select detid, {r('sqrt(avg((y - p) * (y - p)))')} as RMSE, {r(R2)} as R2 from pairs group by 1"""


def _poly_scores(spark, sf, degree):
    rows = hourly(spark, sf).select("detid", "interval_s", "traffic")
    return rounded(polynomial.score_polynomial(rows, polynomial.fit_polynomial(rows, degree)))


@query("poly_features", poly_scores_sql(4))
def poly_features(spark, sf):
    return _poly_scores(spark, sf, 4)


@query("poly_cubic", poly_scores_sql(3))
def poly_cubic(spark, sf):
    return _poly_scores(spark, sf, 3)


@query("poly_quadratic", poly_scores_sql(2))
def poly_quadratic(spark, sf):
    return _poly_scores(spark, sf, 2)


# -- forest -------------------------------------------------------------------------------------


TEST_SPOTS = f"select detid, w, h from cells union select detid, cast({W} as integer), interval_s from test"
WEEK_SPOTS = "select detid, w, h from cells union select detid, cast(d.range as integer), cast(s.range * 3600 as integer) from (select distinct detid from cells), range(7) d, range(24) s"


def tree_sql(depth: int, spots: str = TEST_SPOTS) -> str:
    """A single tree per sensor, level by level: ``n{depth}`` gives the node of each point of ``spots``.

    Equal gains: weekday before interval, then the lower threshold.
    """
    parts = [
        f"""cells as (select detid, cast({W} as integer) as w, interval_s as h, count(*) as m, sum(traffic) as sy from train group by all)""",
        f"spots as ({spots})",
        "n0 as (select detid, w, h, 0 as node from spots)",
    ]
    for d in range(depth):
        parts.append(
            f"""v{d} as (select c.*, node, sy / m as y, min(sy / m) over part as low, max(sy / m) over part as high
              from cells c join n{d} using (detid, w, h) window part as (partition by detid, node)),
            f{d} as (select detid, node, 0 as f, w as x, sum(m) as m, sum(sy) as s from v{d} where high > low group by all
              union all select detid, node, 1, h, sum(m), sum(sy) from v{d} where high > low group by all),
            g{d} as (select *, sum(m) over upto as lm, sum(s) over upto as ls, sum(m) over part as tm, sum(s) over part as ts, lead(x) over upto as next
              from f{d} window part as (partition by detid, node, f), upto as (partition by detid, node, f order by x)),
            s{d} as (select detid, node, f, (x + next) / 2.0 as cut from g{d} where next is not null qualify row_number() over (
              partition by detid, node order by round(ls * ls / lm + (ts - ls) * (ts - ls) / (tm - lm), 6) desc, f, x) = 1),
            n{d + 1} as (select n.detid, w, h, case when f is null then case when node < 0 then node else -1 - node end
                else 2 * node + case when case when f = 0 then w else h end > cut then 2 else 1 end end as node
              from n{d} n left join s{d} using (detid, node))"""
        )
    return ", ".join(parts)


TREE_DEPTH = 3


@query(
    "forest_tree",
    f"""with {tree_sql(TREE_DEPTH)},
      value as (select detid, node, sum(sy) / sum(m) as p from cells join n{TREE_DEPTH} using (detid, w, h) group by all)
      select t.detid, t.weekday, t.interval_s, {r('t.traffic')} as traffic_actual, {r('p')} as traffic_pred
      from test t join n{TREE_DEPTH} n on n.detid = t.detid and n.w = cast({WEEKDAY_SQL.format('t.weekday')} as integer) and n.h = t.interval_s
      join value v on v.detid = n.detid and v.node = n.node""",
)
def forest_tree(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(forest.forecast_forest(train, test, forest.one_tree(train, TREE_DEPTH), bootstrap=False))


@query("cv_forest")
def cv_forest(spark, sf):
    return rounded(forest.cv_scores(train_test(spark, sf)[0]))


def tuned_forest(spark, sf):
    train, test = train_test(spark, sf)
    return train, test, keyed.settle(forest.tune_forest(train))


@query("model_forest")
def model_forest(spark, sf):
    train, test, best = tuned_forest(spark, sf)
    return forest.forecast_forest(train, test, best)


@query("predict_forest")
def predict_forest(spark, sf):
    train, _, best = tuned_forest(spark, sf)
    return forest.predict_forest(train, best, "Tuesday", baseline.DAY_HOURS)


@query("eval_forest")
def eval_forest(spark, sf):
    train, test, best = tuned_forest(spark, sf)
    return forest.eval_forest(train, test, best)


# -- additive seasonal model --------------------------------------------------------------------


@query(
    "seasonal_slots",
    f"""select detid, cast(({W}) * 86400 + interval_s as integer) as second, count(*) as m, {r('sum(traffic)')} as sy,
        {r('sum(traffic * traffic)')} as syy from train group by 1, 2""",
)
def seasonal_slots(spark, sf):
    return rounded(seasonal.week_slots_sums(train_test(spark, sf)[0], ["detid"]))


def design_sql(weekdays: bool = False, code: bool = False) -> str:
    """The terms of a second of the week as a list."""
    t = "(second / 604800.0)"
    parts = ["1.0::double", t]
    parts += [f"greatest({t} - {seasonal._knot(i)!r}, 0.0)" for i in range(seasonal.CHANGEPOINTS)]
    parts += [f"{f}(second / 86400.0 * 2 * pi() * {j})" for j in range(1, seasonal.FOURIER_ORDER + 1) for f in ("sin", "cos")]
    parts += [f"case when (second // 86400) % 7 = {d} then 1.0 else 0.0 end" for d in range(6)] if weekdays else []
    return "[" + ", ".join(parts + (["code::double"] if code else [])) + "]::double[]"


def fit_sql(priors, weekdays: bool = False, pooled: bool = False) -> str:
    """``fitted`` (detid, prior, coef, sigma, n) by elimination: each step of the recursion clears a column of the normal
    equations; after the last column a step works out noise and weights and sets them up anew."""
    bends, season = seasonal.CHANGEPOINTS, 2 * seasonal.FOURIER_ORDER + 6 * weekdays + pooled
    size = 2 + bends + season
    turn = size + 1
    trend, other = 1 / seasonal.TREND_PRIOR**2, 1 / seasonal.SEASON_PRIOR**2
    key, rows = ("0 as detid", "train join codes using (detid)") if pooled else ("detid", "train")
    code = "code" if pooled else "0 as code"

    def matrix(variance: str, sizes: str) -> str:
        weights = f"list_concat([{trend!r}, {trend!r}], list_transform({sizes}, lambda b: 1 / (prior * b)), [{', '.join([repr(other)] * season)}])"
        return f"""list_transform(g, lambda line, i: list_append(list_transform(line, lambda v, j:
          v / ({variance}) + case when i = j then ({weights})[i] else 0.0 end), r[i] / ({variance})))"""

    sse = "greatest(s - 2 * list_inner_product(coef, r) + list_sum(list_transform(g, lambda line, i: coef[i] * list_inner_product(line, coef))), 0.0)"
    variance = f"greatest(2 * sse / (n + sqrt(n * n + {4 / seasonal.NOISE_PRIOR**2!r} * sse)), {seasonal.LEAST_VARIANCE!r})"
    return f"""wide as (select {key}, {code}, cast(({W}) * 86400 + interval_s as integer) as second, count(*)::double as m, sum(traffic) as sy,
        sum(traffic * traffic) as syy from {rows} group by all),
      designs as (select *, {design_sql(weekdays, pooled)} as x from wide),
      products as (select detid, i, j, sum(m * x[i] * x[j]) as v from designs, range(1, {size + 1}) a(i), range(1, {size + 1}) b(j) group by all),
      lines as (select detid, i, list(v order by j) as line from products group by all),
      grams as (select detid, list(line order by i) as g from lines group by all),
      sides as (select detid, i, sum(sy * x[i]) as v from designs, range(1, {size + 1}) a(i) group by all),
      rights as (select detid, list(v order by i) as r from sides group by all),
      sums as (select detid, sum(m) as n, sum(syy) as syy from designs group by all),
      spans as (select *, case when syy = 0 then 1.0 else sqrt(syy / n) end as scale,
        {f"case when g[{size}][{size}] = 0 then 1.0 else sqrt(g[{size}][{size}] / n) end" if pooled else "1.0"} as span
        from grams join rights using (detid) join sums using (detid)),
      normal as (select detid, n, scale, span, syy / scale / scale as s,
        list_transform(g, lambda line, i: list_transform(line, lambda v, j: v / case when {pooled} and i = {size} then span else 1 end / case when {pooled} and j = {size} then span else 1 end)) as g,
        list_transform(r, lambda v, i: v / scale / case when {pooled} and i = {size} then span else 1 end) as r from spans),
      turns(detid, prior, step, a, coef, variance) using key (detid, prior) as (
        select detid, prior, 0, {matrix(repr(seasonal.NOISE_PRIOR**2), f"list_transform(range({bends}), lambda z: prior)")}, []::double[], 0::double
        from normal, (select unnest([{', '.join(map(repr, priors))}]::double[]) as prior)
        union
        select detid, prior, step + 1,
          case when step % {turn} < {size} then list_transform(a, lambda line, i: case when i = k then p else
              list_transform(line, lambda v, j: v - line[k] * p[j]) end)
            else {matrix("var", f"list_transform(coef[3:{2 + bends}], lambda c: greatest(abs(c), {seasonal.LEAST_BEND!r}))")} end,
          coef, case when step % {turn} = {size} then var else variance end
        from (select *, {variance} as var from (select *, case when step % {turn} = {size} then {sse} else 0.0 end as sse from (
          select detid, prior, step, a, variance, n, s, g, r, step % {turn} + 1 as k, list_transform(a[step % {turn} + 1], lambda v: v / a[step % {turn} + 1][step % {turn} + 1]) as p,
            case when step % {turn} = {size} then list_transform(a, lambda line: line[{size + 1}]) else t.coef end as coef
          from turns t join normal using (detid) where step < {seasonal.TURNS * turn})))),
      fitted as (select detid, prior, list_transform(coef, lambda c, i: c * scale / case when {pooled} and i = {size} then span else 1 end) as coef, sqrt(variance) * scale as sigma, n
        from turns join normal using (detid))"""


def value_sql(weekdays: bool = False, code: bool = False) -> str:
    return f"list_inner_product({design_sql(weekdays, code)}, coef)"


# Both sides solve the same equations by other eliminations; four decimals lie well above the difference.
SOLVED = 4
BAND = f"{r('p', SOLVED)} as traffic, {r(f'p - {seasonal.BAND_Z} * sigma', SOLVED)} as yhat_lower, {r(f'p + {seasonal.BAND_Z} * sigma', SOLVED)} as yhat_upper"
SOLVED_SCORES = SCORES.replace("1e6", f"1e{SOLVED}")
PER_SENSOR = f"with recursive {fit_sql([seasonal.PRIOR_PER_SENSOR])}"
SECONDS = f"(select *, cast(({W}) * 86400 + interval_s as integer) as second from test)"


@query(
    "model_seasonal",
    f"""{PER_SENSOR}, terms as (select detid, prior, unnest(range(len(coef)))::integer as term, unnest(coef) as coef, sigma, n from fitted)
        select detid, prior, term, {r('coef', SOLVED)} as coef, {r('sigma', SOLVED)} as sigma, n::bigint as n from terms""",
)
def model_seasonal(spark, sf):
    model = seasonal.fit_seasonal(train_test(spark, sf)[0])
    return rounded(model.select("detid", "prior", F.posexplode("coef").alias("term", "coef"), "sigma", "n"), SOLVED)


@query(
    "predict_seasonal",
    f"""{PER_SENSOR}, asked as (select detid, coef, sigma, cast(s.range * 3600 as integer) as interval_s, cast(86400 + s.range * 3600 as integer) as second
          from fitted, range(24) s), shown as (select *, {value_sql()} as p from asked)
        select detid, interval_s, {BAND} from shown""",
)
def predict_seasonal(spark, sf):
    return rounded(seasonal.predict_seasonal(seasonal.fit_seasonal(train_test(spark, sf)[0]), "Tuesday"), SOLVED)


@query(
    "eval_seasonal",
    f"""{PER_SENSOR}, pairs as (select detid, traffic as y, {value_sql()} as p from {SECONDS} join fitted using (detid))
        select detid, {SOLVED_SCORES} from pairs group by 1""",
)
def eval_seasonal(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(seasonal.eval_seasonal(test, seasonal.fit_seasonal(train)), SOLVED)


@query(
    "tune_seasonal",
    f"""with recursive {fit_sql(seasonal.PRIORS)}, pairs as (select detid, prior, traffic as y, {value_sql()} as p from {SECONDS} join fitted using (detid))
        select detid, prior, {SOLVED_SCORES} from pairs group by 1, 2""",
)
def tune_seasonal(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(seasonal.tune_seasonal(train, test), SOLVED)


POOLED_SEASONAL = f"""with recursive {CODES}, {fit_sql([seasonal.PRIOR_POOLED], pooled=True)},
  shown as (select detid, weekday, interval_s, traffic as y, {value_sql(code=True)} as p, sigma
    from {SECONDS} join codes using (detid), (select coef, sigma from fitted))"""


@query(
    "model_seasonal_pooled",
    f"""{POOLED_SEASONAL} select detid, weekday, interval_s, {r('y', SOLVED)} as traffic_actual, {r('p', SOLVED)} as traffic_pred,
        {r(f'p - {seasonal.BAND_Z} * sigma', SOLVED)} as yhat_lower, {r(f'p + {seasonal.BAND_Z} * sigma', SOLVED)} as yhat_upper from shown""",
)
def model_seasonal_pooled(spark, sf):
    return rounded(_pooled_forecast(spark, sf), SOLVED)


def _pooled_forecast(spark, sf):
    train, test = train_test(spark, sf)
    codes = keyed.settle(features.label_codes(train, "detid"))
    return seasonal.forecast_pooled(test, seasonal.fit_pooled(train, codes), codes)


@query("eval_seasonal_pooled", f"{POOLED_SEASONAL} select {SOLVED_SCORES} from shown")
def eval_seasonal_pooled(spark, sf):
    return rounded(seasonal.eval_pooled(_pooled_forecast(spark, sf)), SOLVED)


@query(
    "future_frame",
    f"""select detid, cast(last + s.range * 3600 as integer) as second,
        strftime(timestamp '2015-05-18' + to_seconds(last + s.range * 3600), '%Y-%m-%d %H:%M:%S') as ds
        from (select detid, max(({W}) * 86400 + interval_s) as last from train group by 1), range(1, 301) s""",
)
def future_frame(spark, sf):
    frame = seasonal.future_frame(train_test(spark, sf)[0])
    return frame.select("detid", "second", F.date_format("ds", "yyyy-MM-dd HH:mm:ss").alias("ds"))


def future_sql(weekdays: bool) -> str:
    return f"""with recursive {fit_sql([seasonal.PRIOR_PER_SENSOR], weekdays)},
      ends as (select detid, max(({W}) * 86400 + interval_s) as last from train group by 1),
      ahead as (select detid, last + s.range * 3600 as second, coef, sigma from ends join fitted using (detid), range(1, 301) s),
      shown as (select *, {value_sql(weekdays)} as p from ahead)
      select detid, strftime(timestamp '2015-05-18' + to_seconds(second), '%Y-%m-%d %H:%M:%S') as ds, {BAND} from shown"""


def _future(spark, sf, weekdays: bool):
    train, _ = train_test(spark, sf)
    shown = seasonal.predict_future(
        seasonal.fit_seasonal(train, weekday_effect=weekdays), seasonal.future_frame(train), weekday_effect=weekdays
    )
    return rounded(shown.withColumn("ds", F.date_format("ds", "yyyy-MM-dd HH:mm:ss")), SOLVED)


@query("predict_future", future_sql(False))
def predict_future(spark, sf):
    return _future(spark, sf, False)


@query("predict_future_weekdays", future_sql(True))
def predict_future_weekdays(spark, sf):
    return _future(spark, sf, True)


# -- predictions on the map ---------------------------------------------------------------------

NAMES = f"list_value({', '.join(repr(d) for d in WEEKDAYS)})"
WEEK_ASKED = "select detid, cast(d.range as integer) as w, cast(s.range * 3600 as integer) as h from best, range(7) d, range(24) s"
#: ``predicted``: all models, weekdays and slots; the forest is a single tree, which SQL can grow.
PREDICTED = f"""with recursive {MODEL}, {CV.replace('with ', '')}, {forecast_sql(WEEK_ASKED)}, {tree_sql(TREE_DEPTH, WEEK_SPOTS)}, {fit_sql([seasonal.PRIOR_PER_SENSOR])},
  leaf as (select detid, node, sum(sy) / sum(m) as p from cells join n{TREE_DEPTH} using (detid, w, h) group by all),
  seconds as (select detid, coef, cast(d.range as integer) as w, cast(s.range * 3600 as integer) as h, cast(d.range * 86400 + s.range * 3600 as integer) as second
    from fitted, range(7) d, range(24) s),
  predicted as (
    select 'random' as model, detid, weekday, interval_s, traffic::double as traffic from model
    union all select 'knn', detid, {NAMES}[w + 1], h, traffic from forecast
    union all select 'forest', n.detid, {NAMES}[n.w + 1], n.h, p from n{TREE_DEPTH} n join leaf using (detid, node) where n.h % 3600 = 0 and n.h < 86400
    union all select 'seasonal', detid, {NAMES}[w + 1], h, {value_sql()} from seconds)"""


def week_predictions(spark, sf):
    """All models and weekdays; the forest is one tree of fixed depth, so that an oracle can follow."""
    train, _ = train_test(spark, sf)
    return predictions.week_predictions(train, forest_settings=forest.one_tree(train, TREE_DEPTH), bootstrap=False)


@query(
    "prediction_cube_all",
    f"""{PREDICTED}, coords as (select p.*, d.lon, d.lat from predicted p join detectors d using (detid))
        select model, weekday, interval_s, cast(round_even(lon * 100, 0) as integer) as cell_x,
          cast(round_even(lat * 100, 0) as integer) as cell_y, {r('avg(traffic)', SOLVED)} as mean_traffic_index,
          count(detid) as detectors_in_grid from coords group by 1, 2, 3, 4, 5""",
)
def prediction_cube_all(spark, sf):
    cube = dataset.prediction_cube(week_predictions(spark, sf), views.detectors(spark, sf))
    return rounded(cube.drop("grid_id", "lon_rounded", "lat_rounded"), SOLVED)



@query(
    "prediction_cube",
    f"""with {MODEL}, hours as (select * from model where interval_s % 3600 = 0),
        coords as (select h.*, d.lon, d.lat from hours h join detectors d using (detid))
        select 'random' as model, weekday, interval_s, cast(round_even(lon * 100, 0) as integer) as cell_x,
          cast(round_even(lat * 100, 0) as integer) as cell_y, {r('avg(traffic)')} as mean_traffic_index,
          count(detid) as detectors_in_grid from coords group by 2, 3, 4, 5""",
)
def prediction_cube(spark, sf):
    model = baseline.fit_random(train_test(spark, sf)[0]).where("interval_s % 3600 = 0")
    cube = dataset.prediction_cube(model.withColumn("model", F.lit("random")), views.detectors(spark, sf))
    return rounded(cube.drop("grid_id", "lon_rounded", "lat_rounded"))


@query(
    "macro_average_knn",
    f"""with {CV}, {forecast_sql(TESTED)}, pairs as (select a.detid, a.y, f.traffic as p from asked a join forecast f using (detid, w, h)),
        scored as (select avg(abs(y - p)) as a, avg((y - p) * (y - p)) as b, {R2} as c from pairs group by detid)
        select {r('avg(a)')} as avg_MAE, {r('avg(b)')} as avg_MSE, {r('avg(c)')} as avg_R2 from scored""",
)
def macro_average_knn(spark, sf):
    train, test = train_test(spark, sf)
    best = keyed.settle(knn.tune_knn(train))
    return rounded(macro_average(knn.eval_knn(train, test, best)))
