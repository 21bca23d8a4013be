"""One nearest-neighbour model over all sensors: features are sensor code, weekday and interval.

Sensor codes are integers, far apart or not. Neighbours are looked up in rank space: the sensors that
report at an hour are numbered 0.. in order of their codes, and a query stands at the number of them
with a smaller code. A sensor ``REACH`` ranks off has k others before it whose rows are all nearer,
whatever the weekday, so a query joins at most twice that many ranks of an hour, by equality.

The numbers come from one sort of (hour, code) into ranges: running counts inside each range plus the
ranges' counts, so no task holds an hour.

Which hours matter is settled in two steps, since codes may lie farther apart than hours. The
nearest hours that together hold k rows give a distance within which k rows are known to lie: the
best of the hours with k rows of their own, and at most the farthest row of all of them. Every
hour within that distance is then looked up, once for each code. The first rows of all these hours
on both sides bound each of the two distances once more, and only ranks within those bounds are
searched; all other rows are farther.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import weekday_number
from ..operators import keyed
from ..operators.metrics import regression_metrics
from .knn import (
    FOLDS,
    NEIGHBOURS,
    WEEKDAY_STEP,
    _shortlist,
    best_steps,
    cv_table,
    running_means,
    serve_other_folds,
    setting_value,
)

ROW_ORDER = ("code", "day", "interval_s")

# Besides the middle and the last, the rows on each side of a code whose distance is looked up.
NEAREST_STEPS = (1, 2, 3)


def coded_rows(rows: DataFrame, codes: DataFrame, key: str = "detid") -> DataFrame:
    """Rows with the train set's sensor code; sensors the train set does not know are left out."""
    return rows.where(F.col("traffic").isNotNull()).join(codes.select(key, "code"), key)


def _lattice(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return rows.select(
        *extra, "code", weekday_number("weekday").alias("w"), F.col("interval_s").cast("int").alias("h"), "day", F.col("traffic").alias("y")
    )


def pooled_fans(points: DataFrame, queries: DataFrame, keys: Sequence[str] = (), k: int = max(NEIGHBOURS)) -> DataFrame:
    """Forecasts of each query (keys, code, w, h) from its nearest rows, as ``knn.fans`` gives them.

    The two distances rank differently here: d1 adds the steps, d2 is Euclidean.
    """
    points, group = keyed.with_key(points, keys)
    queries, _ = keyed.with_key(queries, keys)
    short = _shortlist(points, [*group, "code", "w", "h"], k)
    # One row per sensor and hour: the sensor dimension, not the readings.
    present = keyed.settle(short.groupBy(*group, "h", "code").agg(F.count(F.lit(1)).alias("n")))

    per_hour = present.groupBy(*group, "h").agg(F.sum("n").alias("n"))
    hours = keyed.settle(per_hour.groupBy(*group).agg(F.collect_list(F.struct("h", "n")).alias("hours")))
    asked = keyed.settle(queries.groupBy(*group, "code", "h").agg(F.collect_set("w").alias("ws")))
    reach = keyed.join_stats(asked.drop("ws"), hours, group).withColumn("reach", _hours_reach(F.col("hours"), F.col("h"), k))
    near = F.filter("hours", lambda x: F.abs(x["h"] - F.col("h")) <= F.col("reach"))
    nearby = reach.select(*group, "code", "h", F.explode(near).alias("t"))
    nearby = keyed.settle(nearby.select(*group, "code", "h", F.col("t.h").alias("th"), F.col("t.n").alias("held")))
    places = _places(present, nearby, group)
    lookups = keyed.settle(_surroundings(places, group, k))
    apart = F.abs(F.col("th") - F.col("h")) + F.col("radius")
    known = nearby.join(lookups, [*group, "th", "code"]).groupBy(*group, "code", "h").agg(
        F.least(F.max(apart), F.min(F.when(F.col("held") >= k, apart))).alias("within")
    )
    asked = keyed.settle(asked.join(known, [*group, "code", "h"]))
    spots = asked.groupBy(*group, "code").agg(F.collect_list(F.struct("h", "within")).alias("spots"))
    reached = F.filter("hours", lambda x: F.exists("spots", lambda s: F.abs(x["h"] - s["h"]) <= s["within"]))
    targets = keyed.join_stats(spots, hours, group).select(*group, "code", F.explode(reached).alias("t")).select(*group, "code", F.col("t.h").alias("th"))
    farther = keyed.settle(targets.join(lookups, [*group, "th", "code"], "left_anti"))
    if not farther.isEmpty():
        lookups = lookups.unionByName(keyed.settle(_surroundings(_places(present, farther, group), group, k)))

    # A code's hours come as one list, so that its queries are not shuffled once for each of them.
    hour = [c for c in lookups.columns if c not in (*group, "code", "radius")]
    looks = lookups.groupBy(*group, "code").agg(F.collect_list(F.struct(*hour)).alias("looks"))
    in_room = _rooms(keyed.never_broadcast(asked).join(keyed.never_broadcast(looks), [*group, "code"]), [*group, "code", "h", "ws"], k)
    low = F.greatest(F.lit(0), F.col("rank") - _ranks_in_room("below", k // 2, k))
    high = F.least(F.col("rank") + _ranks_in_room("above", k - k // 2, k) - 1, F.col("sensors") - 1)
    ranks = F.explode(F.when(low <= high, F.sequence(low, high))).alias("rank")
    spread = in_room.select(*group, "code", "h", "ws", "th", "room", ranks)
    numbers = places.where("seen").select(*group, "th", F.col("code").alias("tcode"), "rank")
    train = short.select(*group, F.col("code").alias("tcode"), F.col("w").alias("tw"), F.col("h").alias("th"), "day", "y")
    train = train.join(numbers, [*group, "th", "tcode"])
    inside = keyed.never_broadcast(spread).join(train, [*group, "th", "rank"]).where(F.abs(F.col("tcode") - F.col("code")) <= F.col("room"))
    # weekdays are told apart after the shuffle
    met = inside.select(*group, "code", "h", "ws", "tcode", "tw", "th", "day", "y").repartition(*group, "code", "h")
    pairs = met.select("*", F.explode("ws").alias("w"))
    dc, dw, dh = (F.abs(F.col(a) - F.col(b)) for a, b in (("tcode", "code"), ("tw", "w"), ("th", "h")))
    d1 = (dc + dw + dh).cast("double")
    d2 = F.sqrt((dc * dc + dw * dw + dh.cast("bigint") * dh).cast("double"))
    spot = Window.partitionBy(*group, "code", "w", "h")
    measured = pairs.select(*group, "code", "w", "h", "y", "tcode", "day", "th", d1.alias("d1"), d2.alias("d2"))
    rows = ("tcode", "day", "th")
    ranked = measured.select(
        *group, "code", "w", "h",
        *running_means(spot.orderBy("d1", *rows), (1,), "rn1", "u1"),
        *running_means(spot.orderBy("d2", *rows), (2,), "rn2", "u2"),
    )
    out = best_steps(ranked, [*group, "code", "w", "h"], k)
    return out.select(*keys, "code", "w", "h", "k", "u1", "e1", "u2", "e2")


def _rooms(df: DataFrame, kept: list[str], k: int) -> DataFrame:
    """The hours of ``looks`` that can hold one of the k nearest rows of a query, each with its ``room``: of that hour only codes
    in this distance can matter. k rows lie ``within`` a distance, by both measures; the first rows of all hours may tell more."""

    def kth(distance: Callable[[Column, Column], Column]) -> Column:
        def to(x: Column, side: str) -> Column:
            return distance(x[side].cast("double"), F.abs(x["th"] - F.col("h")).cast("double"))

        steps = [f"{side}_{j}" for side in ("below", "above") for j in NEAREST_STEPS]
        firsts = F.flatten(F.transform("looks", lambda x: F.array(*[to(x, c) for c in steps])))
        return F.least(F.col("within").cast("double"), F.get(F.sort_array(F.array_compact(firsts)), F.lit(k - 1)))

    sums = kth(lambda dc, dh: dc + dh + WEEKDAY_STEP)
    roots = kth(lambda dc, dh: F.sqrt(dc * dc + dh * dh + WEEKDAY_STEP**2))
    # expanded before the rooms are reckoned: inside a lambda the bounds would be worked out for each hour again
    hours = df.select(*kept, "within", sums.alias("_sums"), roots.alias("_roots"), "looks").select(*kept, "within", "_sums", "_roots", F.inline("looks"))
    off = F.abs(F.col("th") - F.col("h")).cast("double")
    edge = F.col("_roots") + 1  # the unit on top covers rounding
    room = F.greatest(F.col("_sums") + 1 - off, F.sqrt(F.greatest(edge * edge - off * off, F.lit(0.0))))
    in_reach = hours.where(off <= F.col("within")).withColumn("room", F.floor(room)).drop("within", "_sums", "_roots")
    return in_reach.where((F.col("below_1") <= F.col("room")) | (F.col("above_1") <= F.col("room")))


def _hours_reach(hours: Column, h: Column, k: int) -> Column:
    """Smallest interval distance within which ``hours`` (array of h, n) holds ``k`` rows, else the largest."""
    near = F.sort_array(F.transform(hours, lambda x: F.struct(F.abs(x["h"] - h).alias("gap"), x["n"].alias("n"))))
    start = F.struct(F.lit(0).cast("bigint").alias("got"), F.lit(0).alias("gap"))

    def step(state, x):
        more = F.struct((state["got"] + x["n"]).alias("got"), x["gap"].alias("gap"))
        return F.when(state["got"] >= k, state).otherwise(more)

    return F.aggregate(near, start, step)["gap"]


def _places(present: DataFrame, targets: DataFrame, group: list[str]) -> DataFrame:
    """Rank of every sensor and query code among the sensors of each hour: group, ``th``, code, ``n``, ``seen``, ``asked``, ``rank``,
    ``first`` (rows of sensors with smaller codes), and of the hour ``sensors``, ``rows`` and its ``lowest`` and ``highest`` code."""
    no, yes = F.lit(False), F.lit(True)
    sensors = present.select(*group, F.col("h").alias("th"), "code", "n", yes.alias("seen"), no.alias("asked"))
    queries = targets.select(*group, "th", "code", F.lit(0).cast("bigint").alias("n"), no.alias("seen"), yes.alias("asked"))
    order = [*group, "th", "code"]
    merged = sensors.unionByName(queries).groupBy(*order).agg(F.sum("n").alias("n"), F.max("seen").alias("seen"), F.max("asked").alias("asked"))
    ranged = keyed.settle(merged.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = F.col("seen").cast("bigint")
    counts = {"_before": mark, "_rows": F.col("n")}
    placed = ranged.select("*", *[(F.sum(c).over(within) - c).alias(name) for name, c in counts.items()])
    for name, c in counts.items():
        offsets = keyed.range_offsets(ranged, c).drop("_total")
        placed = placed.join(offsets, "_range").withColumn(name, F.col(name) + F.col("_offset")).drop("_offset")
    placed = keyed.settle(placed.drop("_range"))
    code = F.when(F.col("seen"), F.col("code"))
    hours = placed.groupBy(*group, "th").agg(
        F.min("_before").alias("_base"), F.sum(mark).alias("sensors"), F.min("_rows").alias("_base_rows"), F.sum("n").alias("rows"),
        F.min(code).alias("lowest"), F.max(code).alias("highest"),
    )
    ranks = {"rank": F.col("_before") - F.col("_base"), "first": F.col("_rows") - F.col("_base_rows")}
    return placed.join(hours, [*group, "th"]).withColumns(ranks).drop("_before", "_base", "_rows", "_base_rows")


def _surroundings(places: DataFrame, group: list[str], k: int) -> DataFrame:
    """Per (hour, query code) its ``rank``, the hour's ``sensors``, the distances in code to the first three, a middle and the k-th row
    below and above (``below_1`` ...; null past the end), the ranks these rows' sensors have (``at_below_1`` ...), and ``radius``: a
    distance in code and weekday within which k rows of that hour lie, or all of them. Rows of the query's own code count as above."""
    last = F.col("first") + F.col("n") - 1
    rows = places.where("seen").select(*group, "th", F.col("code").alias("_at"), F.col("rank").alias("_place"), F.explode(F.sequence("first", last)).alias("_row"))
    half = k // 2
    steps = {f"below_{j}": -j for j in {*NEAREST_STEPS, half, k}} | {f"above_{j}": j - 1 for j in {*NEAREST_STEPS, k - half, k}}
    wanted = F.array(*[F.struct(F.lit(name).alias("_step"), (F.col("first") + by).alias("_row")) for name, by in steps.items()])
    held = F.filter(wanted, lambda x: (x["_row"] >= 0) & (x["_row"] < F.col("rows")))
    asked = places.where("asked").select(*group, "th", "code", "rank", "sensors", "lowest", "highest", F.inline(held))
    found = asked.join(rows, [*group, "th", "_row"]).groupBy(*group, "th", "code").agg(
        *[F.any_value(c).alias(c) for c in ("rank", "sensors", "lowest", "highest")],
        *[F.max(F.when(F.col("_step") == name, F.abs(F.col("_at") - F.col("code")))).alias(name) for name in steps],
        *[F.max(F.when(F.col("_step") == name, F.col("_place"))).alias(f"at_{name}") for name in steps],
    )
    far = F.greatest(F.col("code") - F.col("lowest"), F.col("highest") - F.col("code"))
    below, above = F.col(f"below_{half}"), F.col(f"above_{k - half}")
    both = F.when(below.isNotNull() & above.isNotNull(), F.greatest(below, above))
    radius = F.coalesce(F.least(both, F.col(f"below_{k}"), F.col(f"above_{k}")), far) + WEEKDAY_STEP
    return found.select(*group, "th", "code", "rank", "sensors", *steps, *[f"at_{name}" for name in steps], radius.alias("radius"))


def _ranks_in_room(side: str, middle: int, k: int) -> Column:
    """How many sensors on a side can have a row within ``room``: those before the sensor of the first looked up row beyond it."""
    out = None
    for j in sorted({*NEAREST_STEPS, middle, k}):
        at = F.col(f"at_{side}_{j}")
        nearer = at - F.col("rank") if side == "above" else F.col("rank") - at - 1
        beyond = F.col(f"{side}_{j}") > F.col("room")
        out = F.when(beyond, nearer) if out is None else out.when(beyond, nearer)
    return out.otherwise(k + WEEKDAY_STEP + (side == "above"))


def forecast_pooled_knn(
    train: DataFrame, rows: DataFrame, codes: DataFrame, k: int = 10, p: int = 1, weights: str = "distance", key: str = "detid"
) -> DataFrame:
    """Test rows with ``traffic_actual`` and ``traffic_pred``. ``k`` is one of ``NEIGHBOURS``."""
    if k not in NEIGHBOURS:
        raise ValueError(f"k is {k}, not one of {NEIGHBOURS}")
    asked = coded_rows(rows, codes, key)
    spread = pooled_fans(_lattice(coded_rows(train, codes, key)), _lattice(asked).select("code", "w", "h").distinct())
    value = setting_value(F.lit(p), F.lit(weights))
    valued = spread.where(F.col("k") == k).select("code", "w", "h", value.alias("traffic_pred"))
    points = asked.withColumn("w", weekday_number("weekday")).withColumn("h", F.col("interval_s"))
    return points.join(valued, ["code", "w", "h"]).select(
        key, "weekday", "interval_s", F.col("traffic").alias("traffic_actual"), "traffic_pred"
    )


def eval_pooled_knn(train, test, codes, k=10, p=1, weights="distance", key="detid") -> DataFrame:
    """MAE, MSE and R2 over all test rows."""
    return regression_metrics(forecast_pooled_knn(train, test, codes, k, p, weights, key), [])


def tune_pooled_knn(train: DataFrame, codes: DataFrame, folds: int = FOLDS, key: str = "detid") -> DataFrame:
    """Mean fold MAE of every setting; folds are contiguous in sensor-major row order."""
    rows, group = keyed.with_key(keyed.settle(coded_rows(train, codes, key)), ())

    def starts(n: Column) -> list[Column]:
        size, extra = F.floor(n / folds).cast("bigint"), n % folds
        return [size * i + F.least(F.lit(i), extra) for i in range(1, folds)]

    cuts = keyed.starts_of_parts(rows, group, ROW_ORDER, [F.col("code")], starts)
    folded = keyed.settle(keyed.join_stats(rows, cuts, group).withColumn("fold", keyed.part_number(ROW_ORDER, folds)).drop("_starts", *group))
    points = _lattice(folded, ["fold"])
    serving = serve_other_folds(points, ["code", "w", "h"], folds, max(NEIGHBOURS))
    spot = ["fold", "code", "w", "h"]
    return cv_table(points, pooled_fans(serving, points.select(*spot).distinct(), ["fold"]), spot, [])


def best_pooled_setting(scores: DataFrame) -> tuple[int, int, str]:
    """(k, p, weights) with the smallest mean MAE (9 decimals), the first listed on a tie; of the 16 rows of ``tune_pooled_knn``."""
    best = scores.orderBy(F.round("mae", 9), "position").first()
    return best["k"], best["p"], best["weights"]
