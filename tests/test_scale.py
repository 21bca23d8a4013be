"""Join sides that grow by expanding rows, and how few rows the neighbour searches move."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loopweave.functions.calendar import WEEKDAYS
from loopweave.models import baseline, forest, knn, knn_pooled, seasonal
from loopweave.operators import keyed
from loopweave.plans import dataset, predictions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _model(spark):
    ranges = spark.createDataFrame([("a", 1, 5), ("b", 2, 9)], "detid string, low bigint, high bigint")
    return baseline.week_slots(ranges).select("detid", "weekday", "interval_s", F.col("low").alias("traffic"))


def test_expanded_model_is_not_broadcast_to_test_rows(spark):
    test = spark.createDataFrame([("a", "Monday", 3600, 4.0), ("b", "Sunday", 7200, 2.0)], "detid string, weekday string, interval_s int, traffic double")
    scores = baseline.score_random(test, _model(spark))
    assert "SortMergeJoin" in _plan(scores)
    assert sorted((r["detid"], r["MAE"]) for r in scores.collect()) == [("a", 3.0), ("b", 0.0)]


def test_future_frame_is_not_broadcast(spark):
    train = spark.createDataFrame([("a", "Monday", h * 3600, 10.0 + h) for h in range(24)], "detid string, weekday string, interval_s int, traffic double")
    shown = seasonal.predict_future(seasonal.fit_seasonal(train), seasonal.future_frame(train))
    assert "BroadcastExchange" not in _plan(shown)
    assert shown.count() == 300


def test_predictions_of_a_week_are_not_broadcast_to_detectors(spark):
    places = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0)], "detid string, lon double, lat double")
    cube = dataset.prediction_cube(_model(spark).withColumn("model", F.lit("random")), places)
    assert "BroadcastExchange" not in _plan(cube)
    assert cube.count() == 7 * 288


def _week(spark):
    """Train rows of two sensors over two weeks, and the 168 hours of a week asked of each."""
    rows = [(d, str(np.datetime64("2024-01-01") + i), WEEKDAYS[i % 7], h * 3600, 10.0 + h + i) for d in "ab" for i in range(14) for h in (3, 9)]
    train = spark.createDataFrame(rows, "detid string, day string, weekday string, interval_s int, traffic double")
    sensors = spark.createDataFrame([("a", 3, 1, "uniform"), ("b", 5, 2, "distance")], "detid string, k int, p int, weights string")
    train, sensors = keyed.settle(train), keyed.settle(sensors)  # small files: Spark knows it
    return train, sensors, predictions.week_queries(sensors, baseline.DAY_HOURS)


def _broadcast(df) -> list[str]:
    """The part of the plan below each broadcast."""
    lines, parts = _plan(df).split("\n"), []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            below = [j for j in range(i + 1, len(lines)) if len(lines[j]) - len(lines[j].lstrip(" :+-")) < depth]
            parts.append("\n".join(lines[i : min(below, default=len(lines))]))
    return parts


def test_week_of_queries_is_not_broadcast_by_neighbours(spark):
    train, sensors, asked = _week(spark)
    found = knn.forecast_points(train, asked, sensors)
    assert not [x for x in _broadcast(found) if "Generate" in x]
    assert found.count() == 2 * 168


def test_week_of_queries_is_not_broadcast_by_trees(spark):
    train, _, asked = _week(spark)
    found = forest.forecast_points(train, asked, forest.one_tree(train, 3), bootstrap=False)
    assert not [x for x in _broadcast(found) if "Generate" in x or "Aggregate" in x and "collect" in x]
    assert found.count() == 2 * 168


def test_truths_of_folds_are_not_broadcast(spark):
    train, _, _ = _week(spark)
    rows = knn.fold_rows(train)
    points = knn._lattice(rows, ["detid", "fold"])
    spot = ["detid", "fold", "w", "h"]
    scores = knn.cv_table(points, knn.fans(points, points.select(*spot).distinct(), ["detid"], fold="fold"), spot, ["detid"])
    assert not [x for x in _broadcast(scores) if "y#" in x.split("\n")[1]]
    assert scores.count() == 2 * 16


def test_pairs_of_neighbours_are_not_shuffled(spark):
    rows = [("a", w, h * 3600, f"2024-01-{w + 1:02d}", float(h)) for w in range(7) for h in range(24)]
    points = spark.createDataFrame(rows, "detid string, w int, h int, day string, y double")
    plan = _plan(knn.fans(points, points.select("detid", "w", "h"), ["detid"]))
    assert "Window" in plan.split("Generate explode(ws")[0]
    assert "Exchange" not in plan.split("Generate explode(ws")[0]


def _present(spark, step):
    seen = spark.createDataFrame([(0, 0, step * c, 5) for c in range(31)], "_all int, h int, code bigint, n bigint")
    asked = spark.createDataFrame([(0, 0, step * 15), (0, 0, step * 40), (0, 0, -step)], "_all int, th int, code bigint")
    return knn_pooled._surroundings(knn_pooled._places(seen, asked, ["_all"]), ["_all"], 10)


def test_radius_counts_rows_on_both_sides(spark):
    """Five rows a sensor: ten rows lie within one sensor's distance, not within ten sensors'."""
    got = {r["code"]: r["radius"] for r in _present(spark, 1000).collect()}
    assert got == {15000: 1000 + 6, 40000: 11000 + 6, -1000: 2000 + 6}


def test_pooled_neighbours_against_all_pairs(spark):
    for step, seed in ((1, 1), (700, 2), (5000, 3)):
        rng = np.random.default_rng(seed)
        code, w, h = rng.integers(0, 60, 500) * step, rng.integers(0, 7, 500), rng.integers(0, 6, 500) * 3600
        code[code > 40 * step] += 200 * step
        rows = pd.DataFrame({"code": code, "w": w, "h": h, "day": [f"2024-{i // 28 % 12 + 1:02d}-{i % 28 + 1:02d}" for i in range(500)], "y": rng.normal(50, 9, 500)})
        rows = rows.drop_duplicates(["code", "w", "h", "day"])
        asked = pd.DataFrame({"code": rng.integers(-20, 320, 60) * step, "w": rng.integers(0, 7, 60), "h": rng.integers(0, 7, 60) * 3600}).drop_duplicates()
        points = spark.createDataFrame(rows).select(F.col("code").cast("bigint"), F.col("w").cast("int"), F.col("h").cast("int"), "day", "y")
        queries = spark.createDataFrame(asked).select(F.col("code").cast("bigint"), F.col("w").cast("int"), F.col("h").cast("int"))
        got = {(r["code"], r["w"], r["h"], r["k"]): (r["u1"], r["u2"]) for r in knn_pooled.pooled_fans(points, queries).collect()}
        assert len(got) == len(asked) * len(knn.NEIGHBOURS)
        for q in asked.itertuples(index=False):
            dc, dw, dh = abs(rows["code"] - q.code), abs(rows["w"] - q.w), abs(rows["h"] - q.h)
            for i, d in enumerate((dc + dw + dh, np.sqrt(1.0 * dc**2 + dw**2 + 1.0 * dh**2))):
                order = rows.assign(d=d).sort_values(["d", "code", "day", "h"])["y"].to_numpy()
                for k in knn.NEIGHBOURS:
                    assert abs(got[(q.code, q.w, q.h, k)][i] - order[:k].mean()) < 1e-9


def test_queries_far_from_all_sensors_meet_few_rows(spark, monkeypatch):
    """Held-out sensors lie far from all others, and then every hour of the day lies within reach: few rows of each can be near."""
    rows = [(1_000_000 + 1000 * c, w, h * 3600, f"2024-01-{w + 1:02d}", float(c + h + w)) for c in range(12) for h in range(24) for w in (1, 4)]
    points = keyed.settle(spark.createDataFrame(rows, "code bigint, w int, h int, day string, y double"))
    asked = [(1000 * c, 2, h * 3600) for c in range(4) for h in range(24)]
    met, steps = [], knn_pooled.best_steps
    monkeypatch.setattr(knn_pooled, "best_steps", lambda ranked, *a: met.append(ranked.count()) or steps(ranked, *a))
    found = knn_pooled.pooled_fans(points, spark.createDataFrame(asked, "code bigint, w int, h int"))
    got = {(r["code"], r["h"], r["k"]): (r["u1"], r["u2"]) for r in found.collect()}
    assert len(got) == len(asked) * len(knn.NEIGHBOURS)
    for code, w, h in asked:
        near1 = sorted((abs(c - code) + abs(tw - w) + abs(th - h), c, day, th, y) for c, tw, th, day, y in rows)
        near2 = sorted((np.sqrt(float((c - code) ** 2 + (tw - w) ** 2 + (th - h) ** 2)), c, day, th, y) for c, tw, th, day, y in rows)
        for k in knn.NEIGHBOURS:
            assert np.allclose(got[code, h, k], [np.mean([x[-1] for x in near[:k]]) for near in (near1, near2)])
    assert met[0] < 40 * len(asked)


def test_expanded_ranks_are_not_broadcast(spark, monkeypatch):
    train, _, _ = _week(spark)
    codes = keyed.settle(spark.createDataFrame([("a", 0), ("b", 1000)], "detid string, code bigint"))
    points = keyed.settle(knn_pooled._lattice(knn_pooled.coded_rows(train, codes)))
    plans, steps = [], knn_pooled.best_steps
    monkeypatch.setattr(knn_pooled, "best_steps", lambda ranked, *a: plans.append(_broadcast(ranked)) or steps(ranked, *a))
    assert knn_pooled.pooled_fans(points, points.select("code", "w", "h").distinct()).count() == 2 * 14 * 4
    assert not [x for x in plans[0] if "sequence(" in x or "inline" in x]
