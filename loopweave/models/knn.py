"""Nearest-neighbour regression on (interval, weekday), per sensor or pooled over sensors.

Features sit on a small calendar lattice, so distances are computed between lattice points,
never between raw rows:

* equal train rows are cut to the first K of each lattice point (by row order), the only
  ones that can ever be among K neighbours; Spark prunes them before the shuffle;
* queries are the distinct lattice points that need a forecast;
* the rows left of a sensor, a few thousand at most, are gathered and met by its queries in one
  join. The smallest interval reach that holds K rows comes from their distances. A row adds at most
  ``WEEKDAY_STEP`` to its interval distance, so the K nearest rows lie within that much more, and
  only those are ranked. Intervals may be any seconds apart; on a grid of more than
  ``WEEKDAY_STEP`` seconds nothing is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import weekday_number
from ..operators import keyed
from ..operators.metrics import regression_metrics

# The parameter grid that is searched.
NEIGHBOURS = (3, 5, 7, 10)
WEIGHTS = ("uniform", "distance")
POWERS = (1, 2)
FOLDS = 5

# Fixed value: the largest distance in weekday.
WEEKDAY_STEP = 6

ROW_ORDER = ("day", "interval_s")


def settings() -> list[tuple[int, int, str]]:
    """(k, p, weights) in the order that settles ties: the earlier one wins."""
    return [(k, p, w) for k in NEIGHBOURS for p in POWERS for w in WEIGHTS]


def _lattice(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.where(F.col("traffic").isNotNull()).select(
        *keys, weekday_number("weekday").alias("w"), F.col("interval_s").cast("int").alias("h"), "day", F.col("traffic").alias("y")
    )


def _shortlist(points: DataFrame, cell: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows per lattice point."""
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("day"))
    return points.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _reach(gaps: Column, k: int) -> Column:
    """Smallest distance within which ``gaps`` (an array, a distance per row) holds ``k`` rows, else the largest."""
    return F.get(F.sort_array(gaps), F.least(F.lit(k), F.size(gaps)) - 1)


def fans(points: DataFrame, queries: DataFrame, keys: Sequence[str], k: int = max(NEIGHBOURS), fold: str | None = None) -> DataFrame:
    """Forecasts of each query point (keys, w, h) from its 1st..k-th nearest train rows.

    ``points``: keys, w, h, day, y. Output: keys, w, h, ``k`` (each of ``NEIGHBOURS``), and per
    distance p the uniform mean ``u{p}`` and the distance-weighted mean ``e{p}``.
    With ``fold``, a column of both that comes along as a key, rows of the query's own fold are no neighbours.
    """
    shared, folds = list(keys), [fold] if fold else []
    short = _shortlist(points, [*shared, *folds, "w", "h"], k)
    # At most k rows per lattice point of the week and fold, whatever the sensor's row count. All that follows happens
    # where the sensor's list is: neither the rows in reach nor the pairs are shuffled, nor rows once per fold they serve.
    row = F.struct(F.col("w").alias("tw"), F.col("h").alias("th"), "day", "y", *[F.col(c).alias("tf") for c in folds])
    held = short.groupBy(*shared).agg(F.collect_list(row).alias("rows"))
    keys = [*shared, *folds]
    # Queries are often expanded from a table of sensors and look as small as that.
    asked = keyed.never_broadcast(queries.groupBy(*keys, "h").agg(F.collect_set("w").alias("ws"))).join(held, shared)
    if fold:
        asked = asked.withColumn("rows", F.filter("rows", lambda x: x["tf"] != F.col(fold)))
    gaps = F.transform("rows", lambda x: F.abs(x["th"] - F.col("h")))
    near = asked.withColumn("reach", _reach(gaps, k))
    within = F.filter("rows", lambda x: F.abs(x["th"] - F.col("h")) <= F.col("reach") + WEEKDAY_STEP)
    pairs = near.select(*keys, "h", "ws", F.explode(within).alias("t")).select(*keys, "h", "t.tw", "t.th", "t.day", "t.y", F.explode("ws").alias("w"))
    dh, dw = F.abs(F.col("th") - F.col("h")), F.abs(F.col("tw") - F.col("w"))
    measured = pairs.select(
        *keys, "w", "h", "day", "th", "y",
        (dh + dw).cast("double").alias("d1"),
        F.sqrt((dh.cast("bigint") * dh + dw * dw).cast("double")).alias("d2"),
    )
    spot = Window.partitionBy(*keys, "w", "h")
    if _far_apart(points, queries):
        # a step in interval outweighs any weekday, so both distances sort the rows alike: one ranking serves both
        one = measured.select(*keys, "w", "h", *running_means(spot.orderBy("d1", "day", "th"), POWERS, "rn1", "u1"))
        ranked = one.where(F.col("rn1") <= k).withColumns({"rn2": F.col("rn1"), "u2": F.col("u1")})
        return best_steps(ranked, [*keys, "w", "h"], k)
    ranked = measured.select(
        *keys, "w", "h",
        *running_means(spot.orderBy("d1", "day", "th"), (1,), "rn1", "u1"),
        *running_means(spot.orderBy("d2", "day", "th"), (2,), "rn2", "u2"),
    )
    return best_steps(ranked, [*keys, "w", "h"], k)


def _far_apart(points: DataFrame, queries: DataFrame) -> bool:
    """Whether different intervals lie more than ``WEEKDAY_STEP`` apart; one row from at most a day's seconds."""
    h = F.sort_array(F.collect_set("h"))
    gaps = F.zip_with(F.slice("_h", 2, F.size("_h")), F.slice("_h", 1, F.size("_h") - 1), lambda a, b: a - b)
    both = points.select("h").unionByName(queries.select("h")).distinct().agg(h.alias("_h"))
    least = both.where(F.size("_h") > 1).select(F.array_min(gaps).alias("gap")).first()
    return least is None or least["gap"] > WEEKDAY_STEP


def best_steps(ranked: DataFrame, spot: Sequence[str], k: int) -> DataFrame:
    """One row per spot and number of neighbours, from the running means of both rankings."""
    steps = [
        F.sort_array(F.collect_list(F.when(F.col(f"rn{p}") <= k, F.struct(f"rn{p}", f"u{p}", f"e{p}")))).alias(f"steps{p}")
        for p in POWERS
    ]
    gathered = ranked.where((F.col("rn1") <= k) | (F.col("rn2") <= k)).groupBy(*spot).agg(*steps)
    return gathered.select(
        *spot,
        F.inline(
            F.transform(
                F.array(*[F.lit(n) for n in NEIGHBOURS if n <= k]),
                lambda n: F.struct(
                    n.alias("k"),
                    *[step_at(f"steps{p}", n)[f"{c}{p}"].alias(f"{c}{p}") for p in POWERS for c in ("u", "e")],
                ),
            )
        ),
    )


def running_means(order, powers: Sequence[int], rank: str, uniform: str) -> list[Column]:
    """Rank and the means over the rows up to it: plain, and weighted by 1/d for each distance.

    As soon as rows at distance 0 are among them, only those count for the weighted mean.
    """
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = [F.row_number().over(order).alias(rank), F.avg("y").over(upto).alias(uniform)]
    for p in powers:
        d = F.col(f"d{p}")
        share = F.try_divide(F.lit(1.0), d)
        exact = F.avg(F.when(d == 0, F.col("y"))).over(upto)
        weighted = F.try_divide(F.sum(share * F.col("y")).over(upto), F.sum(share).over(upto))
        out.append(F.coalesce(exact, weighted).alias(f"e{p}"))
    return out


def step_at(steps: str, n: Column) -> Column:
    """The n-th step, or the last one when there are fewer train rows."""
    return F.get(F.col(steps), F.least(n, F.size(steps)) - 1)


def setting_value(p: Column, weights: Column) -> Column:
    """Column of ``fans`` that belongs to a setting."""
    uniform = weights == "uniform"
    return (
        F.when((p == 1) & uniform, F.col("u1"))
        .when(p == 1, F.col("e1"))
        .when(uniform, F.col("u2"))
        .otherwise(F.col("e2"))
    )


def cv_table(points: DataFrame, forecasts: DataFrame, spot: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Mean fold MAE of every setting: keys, ``position``, ``k``, ``p``, ``weights``, ``mae``.

    ``spot`` (with ``fold``) identifies a lattice point; rows of one point share the forecast,
    so equal values are counted first.
    """
    truths = points.groupBy(*spot, "y").agg(F.count(F.lit(1)).alias("m"))
    columns = {"u1": (1, "uniform"), "e1": (1, "distance"), "u2": (2, "uniform"), "e2": (2, "distance")}
    errors = [(F.sum(F.col("m") * F.abs(F.col("y") - F.col(c))) / F.sum("m")).alias(c) for c in columns]
    per_fold = keyed.never_broadcast(truths).join(forecasts, list(spot)).groupBy(*keys, "fold", "k").agg(*errors)
    means = per_fold.groupBy(*keys, "k").agg(*[F.avg(c).alias(c) for c in columns])
    cells = F.array(
        *[
            F.struct(F.lit(p).alias("p"), F.lit(w).alias("weights"), F.col(c).alias("mae"))
            for c, (p, w) in columns.items()
        ]
    )
    long = means.select(*keys, "k", F.inline(cells))
    place = F.lit(None).cast("int")
    for i, (k, p, w) in enumerate(settings()):
        place = F.when((F.col("k") == k) & (F.col("p") == p) & (F.col("weights") == w), F.lit(i)).otherwise(place)
    return long.select(*keys, place.alias("position"), "k", "p", "weights", "mae")


def fold_rows(train: DataFrame, key: str = "detid", folds: int = FOLDS) -> DataFrame:
    """Adds ``fold``: contiguous blocks of each sensor's rows in row order, the first n % folds one row longer."""

    def starts(n: Column) -> list[Column]:
        size, extra = F.floor(n / folds).cast("bigint"), n % folds
        return [size * i + F.least(F.lit(i), extra) for i in range(1, folds)]

    rows = train.where(F.col("traffic").isNotNull())
    cuts = keyed.starts_of_parts(rows, [key], ROW_ORDER, [F.col(c) for c in ROW_ORDER], starts)
    return rows.join(cuts, key).withColumn("fold", keyed.part_number(ROW_ORDER, folds)).drop("_starts")


def serve_other_folds(points: DataFrame, cell: Sequence[str], folds: int, k: int) -> DataFrame:
    """Train rows of every fold: a fold's own rows are no neighbours, so each row serves the other folds."""
    small = _shortlist(points, [*cell, "fold"], k)
    others = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(folds - 1)), F.col("fold"))).alias("fold")
    return small.select(*cell, "day", "y", others)


def cv_scores(train: DataFrame, key: str = "detid", folds: int = FOLDS) -> DataFrame:
    """Mean fold MAE per sensor for all settings: key, ``position``, ``k``, ``p``, ``weights``, ``mae``."""
    points = _lattice(keyed.settle(fold_rows(train, key, folds)), [key, "fold"])
    spot = [key, "fold", "w", "h"]
    forecasts = fans(points, points.select(*spot).distinct(), [key], fold="fold")
    return cv_table(points, forecasts, spot, [key])


def tune_knn(train: DataFrame, key: str = "detid", folds: int = FOLDS) -> DataFrame:
    """Best setting per sensor: smallest mean MAE (9 decimals), the first listed setting on a tie."""
    order = F.struct(F.round("mae", 9), F.col("position"))
    best = F.min_by(F.struct("k", "p", "weights", "mae"), order).alias("best")
    return cv_scores(train, key, folds).groupBy(key).agg(best).select(key, "best.*")


def forecast_points(train: DataFrame, queries: DataFrame, best: DataFrame, key: str = "detid") -> DataFrame:
    """Forecast of each query (key, weekday, interval_s) with its sensor's setting; sensors without a model get none."""
    asked = queries.select(key, "weekday", "interval_s", weekday_number("weekday").alias("w"), F.col("interval_s").cast("int").alias("h"))
    asked = asked.distinct()
    valued = fans(_lattice(train, [key]), asked.select(key, "w", "h"), [key]).join(
        best.select(key, "k", "p", "weights"), [key, "k"]
    )
    chosen = valued.select(key, "w", "h", setting_value(F.col("p"), F.col("weights")).alias("traffic"))
    return keyed.never_broadcast(asked).join(chosen, [key, "w", "h"]).select(key, "weekday", "interval_s", "traffic")


def predict_knn(train: DataFrame, best: DataFrame, weekday: str, intervals: Sequence[int], key: str = "detid") -> DataFrame:
    """Forecast of one weekday at the given intervals for every sensor with a model."""
    hours = F.explode(F.array(*[F.lit(int(i)) for i in intervals])).alias("interval_s")
    queries = best.select(key, F.lit(weekday).alias("weekday"), hours)
    return forecast_points(train, queries, best, key).select(key, "interval_s", "traffic")


def eval_knn(train: DataFrame, test: DataFrame, best: DataFrame, key: str = "detid") -> DataFrame:
    """MAE, MSE and R2 per sensor; sensors without a model are left out."""
    forecasts = keyed.settle(forecast_points(train, test, best, key))
    scored = test.select(key, "weekday", "interval_s", F.col("traffic").alias("traffic_actual")).join(
        forecasts.withColumnRenamed("traffic", "traffic_pred"), [key, "weekday", "interval_s"]
    )
    return regression_metrics(scored, [key])
