"""Hand-made fixtures for the rules that are easy to get wrong."""

import datetime
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loopweave.operators import aggregate, clean, features, grid, joins, metrics, outliers, quality, split

DAY0 = datetime.date(2024, 1, 1)


def readings(spark, n_days=21, sensors=("a", "b"), step=3600, noise=0):
    rng = np.random.default_rng(noise)
    rows = []
    for s in sensors:
        for d in range(n_days):
            for t in range(0, 86400, step):
                rows.append((len(rows), s, DAY0 + datetime.timedelta(days=d), t, float(rng.integers(0, 100)), 0.5))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["row_id", "detid", "day", "interval_s", "traffic", "occ"]))
    return df.withColumn("weekday", F.date_format("day", "EEEE"))


# -- cleaning -----------------------------------------------------------------------------------


def test_preprocess_keeps_missing_error_flags(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 1, 5.0), (2, "2024-01-02", 0, 5.0), (3, "2024-01-03", None, 5.0)],
        "row_id int, day string, error int, speed double",
    )
    out = clean.preprocess(df)
    assert out.columns == ["row_id", "day", "weekday"]
    assert [(r["row_id"], r["weekday"]) for r in out.orderBy("row_id").collect()] == [(2, "Tuesday"), (3, "Wednesday")]
    assert {r["error"]: r["n"] for r in clean.error_counts(df).collect()} == {0: 1, 1: 1}


def test_minmax_range_and_constant_column(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "traffic double")
    got = [r["traffic"] for r in clean.normalize_minmax(df).collect()]
    assert got == [0.0, 49.5, 99.0, None]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "traffic double")
    assert [r["traffic"] for r in clean.normalize_minmax(flat).collect()] == [None, None]


def test_lanes_zero_is_null(spark):
    df = spark.createDataFrame([(4.0, 2), (4.0, 0)], "traffic double, lanes int")
    assert [r["traffic"] for r in clean.normalize_lanes(df).collect()] == [2.0, None]


def test_final_process_rounds_half_even(spark):
    df = spark.createDataFrame([(0.5, 1.0), (1.5, 1.0), (2.5, 1.0), (None, 1.0)], "traffic double, occ double")
    assert [r["traffic"] for r in clean.final_process(df).collect()] == [0, 2, 2, 0]
    assert [r["traffic"] for r in clean.final_process(df, mode="truncate").collect()] == [0, 1, 2, 0]
    with pytest.raises(ValueError):
        clean.final_process(df, mode="up")


# -- outliers -----------------------------------------------------------------------------------


def test_drop_outliers_drops_missing_and_keyless_rows(spark):
    rows = [("a", float(v)) for v in range(20)] + [("a", 1000.0), ("a", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "detid string, traffic double")
    assert sorted(r["traffic"] for r in outliers.drop_outliers(df).collect()) == [float(v) for v in range(20)]


@pytest.mark.parametrize("bounds", ["bucket", "group"])
def test_clip_outliers_equals_a_loop(spark, bounds):
    rng = np.random.default_rng(1)
    sizes = {"hot": 700, "b": 50, "tiny": 7}
    rows = []
    for key, n in sizes.items():
        for i in range(n):
            value = float(rng.normal(50, 10)) if rng.random() > 0.05 else 900.0
            rows.append((len(rows), key, DAY0 + datetime.timedelta(days=i // 48), (i % 48) * 300, value))
    rows[3] = rows[3][:4] + (None,)
    table = pd.DataFrame(rows, columns=["row_id", "detid", "day", "interval_s", "flow"])
    df = spark.createDataFrame(rows, "row_id int, detid string, day date, interval_s int, flow double")
    got = {r["row_id"]: r["flow"] for r in outliers.clip_outliers(df.repartition(5), ["flow"], factor=1.5, bounds=bounds).collect()}
    changed = 0
    for _, group in table.groupby("detid"):
        values = group["flow"].to_numpy(dtype=float)
        size = len(values) // 24
        part = np.full(len(values), 23) if size == 0 else np.minimum(np.arange(len(values)) // size, 23)
        for p in np.unique(part):
            mine = values[part == p]
            base = values if bounds == "group" else mine
            q1, q3 = np.nanquantile(base, 0.25), np.nanquantile(base, 0.75)
            low, high, mean = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), np.nanmean(mine)
            for row_id, value in zip(group["row_id"][part == p], mine):
                want = None if np.isnan(value) else (mean if value < low or value > high else value)
                changed += want is not None and want != value
                assert got[row_id] == (None if want is None else pytest.approx(want, rel=1e-12))
    assert changed > 10


def test_flatline_counts_per_day_and_keeps_missing_values(spark):
    rows = [("a", DAY0, 7.0)] * 4 + [("a", DAY0, 8.0)] * 3 + [("a", DAY0, None)] * 9
    df = spark.createDataFrame(rows, "detid string, day date, flow double")
    kept = [r["flow"] for r in outliers.drop_flatline(df, max_repeats=3).collect()]
    assert sorted(kept, key=str) == sorted([8.0] * 3 + [None] * 9, key=str)


def test_frequency_filter(spark):
    rows = [("a", float(v)) for v in range(10) for _ in range(5)] + [("a", 99.0)] * 60 + [("a", None)]
    df = spark.createDataFrame(rows, "detid string, v double")
    kept = [r["v"] for r in outliers.drop_freq_outliers(df, "v").collect()]
    assert 99.0 not in kept and kept.count(None) == 1 and len(kept) == 51


# -- anomalies ----------------------------------------------------------------------------------


def test_small_spread_needs_both_conditions(spark):
    rows = [("flat", 10.0 + 0.1 * i) for i in range(10)] + [("spiky", 10.0)] * 9 + [("spiky", 500.0)]
    df = spark.createDataFrame(rows, "detid string, traffic double")
    assert [r["detid"] for r in quality.small_spread(df).collect()] == ["flat"]


def test_not_enough_counts_weekdays_over_all_days(spark):
    df = readings(spark, n_days=14).where("detid = 'a' or weekday <> 'Sunday'")
    found = quality.not_enough(df, min_days=12, min_daily=24)
    assert [r["detid"] for r in found.collect()] == ["b"]


def test_rescue_uses_well_filled_days_only(spark):
    df = readings(spark, n_days=14).where("detid = 'a' or day > date'2024-01-03' or interval_s < 7200")
    flags = spark.createDataFrame(
        [("a", False, False, True), ("b", False, False, True)],
        "detid string, mean_out_of_bound boolean, IQR_to_small boolean, not_enough_data boolean",
    )
    kept, left = quality.handle_anomalies(df, flags, min_daily=20, min_days=12)
    assert [r["detid"] for r in left.collect()] == ["b"]
    assert {r["detid"] for r in kept.select("detid").distinct().collect()} == {"a"}


# -- splits -------------------------------------------------------------------------------------


@pytest.mark.parametrize("method", ["Sniper", "Day", "Week"])
def test_splits_partition_the_rows_and_repeat(spark, method):
    df = readings(spark, n_days=28, step=7200)
    out = split.split(method, df, 2, seed=5)
    roles = out.groupBy("split_id", "row_id").count()
    assert roles.where("count <> 1").count() == 0 and roles.count() == 2 * df.count()
    again = split.split(method, df, 2, seed=5)
    columns = ["split_id", "row_id", "role"]
    assert out.select(columns).exceptAll(again.select(columns)).isEmpty()
    tests = out.where("role = 'test'")
    assert tests.where("split_id = 0").count() > 0
    assert {r["row_id"] for r in tests.where("split_id = 0").collect()} != {r["row_id"] for r in tests.where("split_id = 1").collect()}


def test_day_split_keeps_all_weekdays(spark):
    df = readings(spark, n_days=9)
    for k in (1, 2):
        out = split.split_day(df, k=k, seed=1)
        cover = out.where("role = 'train'").groupBy("detid").agg(F.count_distinct("weekday").alias("n"))
        assert [r["n"] for r in cover.collect()] == [7, 7]
        days = out.where("role = 'test'").groupBy("detid").agg(F.count_distinct("day").alias("n"))
        assert [r["n"] for r in days.collect()] == [k, k]


def test_sensor_without_admissible_day_is_reported(spark):
    df = readings(spark, n_days=7)
    out = split.split_day(df)
    assert out.where("role = 'test'").isEmpty()
    assert split.unsplittable(out).count() == 2


def test_week_split(spark):
    out = split.split_week(readings(spark, n_days=21), seed=3)
    per = out.where("role = 'test'").groupBy("detid").agg(F.count_distinct("week").alias("n"))
    assert [r["n"] for r in per.collect()] == [1, 1]


def test_sniper_never_draws_the_last_bucket(spark):
    df = readings(spark, n_days=5).withColumn("interval_s", F.col("interval_s") + 3600)
    out = split.split_sniper(df)
    assert out.where("interval_s = 86400 and role = 'test'").isEmpty()
    most = out.where("role = 'test'").groupBy("detid", "day").count().agg(F.max("count")).first()[0]
    assert most <= 2


def test_unknown_split_method(spark):
    with pytest.raises(ValueError):
        split.split("Month", readings(spark, 1), 1)


# -- grid ---------------------------------------------------------------------------------------


def test_cells_at_the_meridian_share_one_id(spark):
    df = spark.createDataFrame(
        [("a", -0.004, 51.5, 10.0), ("b", 0.003, 51.5, 20.0), ("c", None, 51.5, 99.0)],
        "detid string, lon double, lat double, traffic double",
    )
    row = grid.grid_mean(df).collect()
    assert len(row) == 1 and row[0]["grid_id"] == "0.0_51.5"
    assert row[0]["mean_traffic_index"] == 15.0 and row[0]["detectors_in_grid"] == 2
    assert grid.rows_without_place(df).first()[0] == 1


def test_floor_grid_and_coarse_round(spark):
    df = spark.createDataFrame([("a", 0.074, 0.126, 1.0)], "detid string, lon double, lat double, traffic double")
    floor = grid.grid_mean(df, shape=0.05, snap="floor").first()
    assert (floor["cell_x"], floor["cell_y"], floor["grid_id"]) == (1, 2, "0.05_0.1")
    assert grid.grid_mean(df, shape=0.05).first()["grid_id"] == "0.1_0.1"


def test_fill_is_simultaneous_and_leaves_known_cells(spark):
    # A row of seven cells, only the first known: each round reaches one cell further.
    rows = [(x, 0, 8.0 if x == 0 else None, 1 if x == 0 else None) for x in range(7)]
    df = spark.createDataFrame(rows, "cell_x int, cell_y int, mean_traffic_index double, detectors_in_grid int")
    out = {r["cell_x"]: r["mean_traffic_index"] for r in grid.fill_neighbours(df).collect()}
    assert out == {0: 8.0, 1: 8.0, 2: 8.0, 3: 8.0, 4: 5.5, 5: 5.5, 6: 5.5}


def test_complete_grid_includes_both_borders(spark):
    df = spark.createDataFrame([(0.0, 51.0), (0.03, 51.02)], "lon double, lat double")
    cells = {(r["cell_x"], r["cell_y"]) for r in grid.complete_grid(df).collect()}
    assert cells == {(x, y) for x in range(4) for y in range(5100, 5103)}


def test_polygons_and_colours(spark):
    one = spark.range(1)
    ring = one.select(grid.cell_polygon(F.lit(10.0), F.lit(20.0), "rectangle", 1.0).alias("p")).first()["p"]
    assert [(p["lat"], p["lon"]) for p in ring] == [(9, 19), (9, 21), (11, 21), (11, 19)]
    octagon = one.select(grid.cell_polygon(F.lit(0.0), F.lit(0.0), "octagon", 1.0).alias("p")).first()["p"]
    assert len(octagon) == 8 and all(abs(p["lat"] ** 2 + p["lon"] ** 2 - 1) < 1e-12 for p in octagon)
    assert one.select(grid.cell_polygon(F.lit(0.0), F.lit(0.0), "circle").alias("p")).first()["p"] is None
    values = [0.0, 49.5, 99.0, -5.0, 500.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    assert [r[0] for r in df.select(grid.colour("v")).collect()] == ["#008000", "#ffff00", "#ff0000", "#008000", "#ff0000"]


def test_geojson_rings_are_closed(spark):
    df = spark.createDataFrame([("a", 0.0, 51.5, 10.0)], "detid string, lon double, lat double, traffic double")
    feature = json.loads(grid.geojson_cells(grid.grid_mean(df)).first()["value"])
    ring = feature["geometry"]["coordinates"][0]
    assert feature["type"] == "Feature" and ring[0] == ring[-1] and len(ring) == 5
    assert feature["properties"]["grid_id"] == "0.0_51.5"


# -- joins, aggregates, encodings, metrics ------------------------------------------------------


def test_anti_join_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "detid string")
    keys = spark.createDataFrame([("a",), (None,)], "detid string")
    assert sorted(str(r["detid"]) for r in joins.drop_keys(df, keys, "detid").collect()) == ["None", "b"]
    assert [r["detid"] for r in joins.keep_keys(df, keys, "detid").collect()] == ["a"]


def test_duplicate_detectors_fan_out_unless_reduced(spark):
    df = spark.createDataFrame([("a", 1)], "detid string, x int")
    dim = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "detid string, lon double")
    assert joins.with_detectors(df, dim, columns=("lon",)).count() == 2
    first = joins.first_per_key(dim, ["detid"], ["lon"])
    assert joins.with_detectors(df, first, columns=("lon",)).first()["lon"] == 1.0


def test_summary_takes_the_smallest_mode(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 1.2, 3.0, 2.9, 8.0)], "traffic double")
    assert tuple(aggregate.summary(df).first()) == (1.0, pytest.approx(3.22), 1.0, 8.0)


def test_label_codes_of_the_train_set(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "detid string")
    test = spark.createDataFrame([("c",), ("x",)], "detid string")
    codes = features.label_codes(train, "detid")
    got = {r["detid"]: r["code"] for r in features.label_encode(test, "detid", codes).collect()}
    assert got == {"c": 2, "x": None}


def test_factorize_and_onehot(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (5, None)], "row_id int, c string")
    got = {r["row_id"]: r["code"] for r in features.factorize(df, "c", "row_id", block=2).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 5: None}
    hot = features.onehot_encode(df, "c").orderBy("row_id").collect()
    assert [(r["c_a"], r["c_b"]) for r in hot] == [(0, 1), (1, 0), (0, 1), (0, 0)]
    vectors = features.onehot_vector(df.where("c is not null"), "c").orderBy("row_id").collect()
    assert [int(r["onehot"].toArray().argmax()) for r in vectors] == [1, 0, 1]


def test_r2_rules(spark):
    rows = [("perfect", 2.0, 2.0)] * 2 + [("constant", 2.0, 3.0)] * 2 + [("single", 1.0, 5.0)]
    rows += [("bad", 1.0, 3.0), ("bad", 2.0, 2.0), ("bad", 3.0, 1.0)]
    df = spark.createDataFrame(rows, "detid string, traffic_actual double, traffic_pred double")
    got = {r["detid"]: r["R2"] for r in metrics.regression_metrics(df).collect()}
    assert got == {"perfect": 1.0, "constant": 0.0, "single": None, "bad": -3.0}


def test_day_draw_needs_no_luck(spark):
    """Nine days, two of them spare, two wanted: every sensor has exactly one admissible draw and gets it."""
    import datetime

    from loopweave.operators import split

    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(9)]
    rows = [(f"D/{s}", d, d.strftime("%A"), 0) for s in range(60) for d in days]
    df = spark.createDataFrame(rows, "detid string, day date, weekday string, interval_s int")
    out = split.split_day(df, k=2)
    assert split.unsplittable(out).count() == 0
    test = out.where("role = 'test'").groupBy("detid").count().collect()
    assert len(test) == 60 and all(r["count"] == 2 for r in test)
    left = out.where("role = 'train'").groupBy("detid").agg({"weekday": "count"}).collect()
    assert all(r[1] == 7 for r in left)


def test_week_draw_is_the_first_that_works():
    import itertools
    import random

    from loopweave.operators.split import first_draw

    rng = random.Random(1)
    for _ in range(300):
        masks = [rng.choice([1, 2, 4, 8, 16, 32, 64, 3, 12, 31, 96, 127]) for _ in range(rng.randrange(1, 8))]
        for k in (2, 3):
            good = [c for c in itertools.combinations(range(len(masks)), k) if _held(masks, c) >= 5]
            assert first_draw(masks, k, 5) == (list(min(good)) if good else [])


def _held(masks, gone):
    total = 0
    for i, m in enumerate(masks):
        if i not in gone:
            total |= m
    return total.bit_count()
