import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loopweave.functions.calendar import WEEKDAYS
from loopweave.models import baseline, forest, knn, polynomial, seasonal
from loopweave.operators import features, split

SENSORS = ("EAST-1/a", "WEST/2", "c")


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s, level in zip(SENSORS, (20.0, 50.0, 70.0)):
        for d in range(21):
            for h in range(24):
                season = 15 * np.sin(2 * np.pi * h / 24)
                rows.append((s, str(np.datetime64("2024-01-01") + d), h * 3600, level + season + rng.normal(0, 1)))
    pdf = pd.DataFrame(rows, columns=["detid", "day", "interval_s", "traffic"])
    df = spark.createDataFrame(pdf).withColumn("day", F.to_date("day")).withColumn("weekday", F.date_format("day", "EEEE"))
    parts = split.split_day(df, seed=2).cache()
    return parts.where("role = 'train'").drop("role"), parts.where("role = 'test'").drop("role")


def _design(second):
    t = second / 604800
    knots = [seasonal.CHANGEPOINT_RANGE * (i + 1) / (seasonal.CHANGEPOINTS + 1) for i in range(seasonal.CHANGEPOINTS)]
    waves = [f(2 * np.pi * second / 86400 * j) for j in range(1, 5) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(t), t] + [np.maximum(t - k, 0) for k in knots] + waves)


def test_seasonal_fit_is_the_most_probable_one(tables, monkeypatch):
    """No small step in any direction is more probable under the Laplace, normal and half-normal priors."""
    monkeypatch.setattr(seasonal, "TURNS", 300)
    train, _ = tables
    pdf = train.toPandas()
    rng = np.random.default_rng(1)
    for _, group in pdf.groupby("detid"):
        second = (group["weekday"].map({d: i for i, d in enumerate(WEEKDAYS)}) * 86400 + group["interval_s"]).to_numpy()
        x, y = _design(second), group["traffic"].to_numpy()
        for prior in (0.05, 0.5):
            coef, sigma = seasonal._most_probable(np, x.T @ x, x.T @ y, float(y @ y), len(y), prior)
            scale = np.sqrt(np.mean(y * y))

            def cost(c, s):
                size = np.abs(c[2:27])  # changes below LEAST_BEND weigh as squares
                bend = np.where(size > seasonal.LEAST_BEND, size, c[2:27] ** 2 / seasonal.LEAST_BEND / 2 + seasonal.LEAST_BEND / 2)
                residual = y / scale - x @ c
                return len(y) * np.log(s) + residual @ residual / (2 * s * s) + s * s / (2 * 0.25) + bend.sum() / prior + (c[:2] ** 2).sum() / 50 + (c[27:] ** 2).sum() / 200

            c, s = np.array(coef) / scale, sigma / scale
            best = cost(c, s)
            assert all(cost(c + rng.normal(0, 1, 35) * step, s) > best - 1e-6 for step in (1e-1, 1e-2, 1e-3) for _ in range(50))
            assert all(cost(c, s * f) > best - 1e-6 for f in (0.9, 0.99, 1.01, 1.1))


def test_trend_changes_are_sparse_and_noise_is_found(spark):
    """A trend that bends once keeps few changes under a Laplace prior; the band follows the noise."""
    rng = np.random.default_rng(3)
    for noise in (1.0, 4.0):
        second = np.arange(0, 604800, 1800.0)
        y = 40 + 20 * np.maximum(second / 604800 - 0.4, 0) * 5 + rng.normal(0, noise, len(second))
        x = _design(second)
        coef, sigma = seasonal._most_probable(np, x.T @ x, x.T @ y, float(y @ y), len(y), 0.05)
        changes = np.abs(coef[2:27])
        assert (changes > changes.max() / 50).sum() <= 8
        assert 0.8 * noise < sigma < 1.2 * noise


def test_future_follows_weekdays(spark):
    rows = [("a", d, h * 3600, 10.0 + 50 * (d == "Sunday")) for d in WEEKDAYS for h in range(24)]
    train = spark.createDataFrame(rows, "detid string, weekday string, interval_s int, traffic double")
    model = seasonal.fit_seasonal(train, weekday_effect=True)
    ahead = seasonal.predict_future(model, seasonal.future_frame(train, steps=168), weekday_effect=True)
    mean = {r["d"]: r["t"] for r in ahead.groupBy(F.date_format("ds", "EEEE").alias("d")).agg(F.avg("traffic").alias("t")).collect()}
    assert mean["Sunday"] > mean["Wednesday"] + 30


def test_seasonal_forecasts(tables):
    train, test = tables
    model = seasonal.fit_seasonal(train)
    day = seasonal.predict_seasonal(model, "Tuesday").toPandas()
    assert len(day) == 3 * 24 and (day["yhat_lower"] < day["traffic"]).all() and (day["traffic"] < day["yhat_upper"]).all()
    assert set(day["detid"]) == set(SENSORS)
    scores = seasonal.eval_seasonal(test, model).toPandas()
    assert (scores["MAE"] < 2).all() and (scores["R2"] > 0.9).all()
    tuned = seasonal.tune_seasonal(train, test).toPandas()
    assert len(tuned) == 3 * len(seasonal.PRIORS)
    effect = seasonal.fit_seasonal(train, weekday_effect=True)
    assert seasonal.eval_seasonal(test, effect, weekday_effect=True).count() == 3


def test_future_continues_hourly(tables):
    train, _ = tables
    frame = seasonal.future_frame(train)
    assert frame.count() == 900
    ahead = seasonal.predict_future(seasonal.fit_seasonal(train), frame)
    assert ahead.where("traffic is null").isEmpty() and ahead.count() == 900


def test_pooled_seasonal_beats_nothing(tables):
    train, test = tables
    codes = features.label_codes(train, "detid")
    out = seasonal.forecast_pooled(test, seasonal.fit_pooled(train, codes), codes)
    score = seasonal.eval_pooled(out).first()
    assert score["R2"] > 0.8
    pdf = out.toPandas()
    assert ((pdf["yhat_upper"] - pdf["traffic_pred"]) > 0).all()


def test_forest(tables):
    train, test = tables
    best = forest.tune_forest(train, trees=(10, 30), depths=(2, 10), min_split=(2, 10), min_leaf=(1, 4), folds=3).cache()
    rows = best.collect()
    assert {r["detid"] for r in rows} == set(SENSORS) and {r["depth"] for r in rows} == {10}
    scores = forest.eval_forest(train, test, best).toPandas()
    assert set(scores["detid"]) == set(SENSORS) and (scores["MAE"] < 2).all()
    day = forest.predict_forest(train, best, "Monday", baseline.DAY_HOURS)
    assert sorted(day.collect()) == sorted(day.collect()) and day.count() == 72


def _tree(rows, depth, min_split, min_leaf):
    """A plain recursive tree over (w, h, drawn rows, mean); returns its forecast function."""
    size = sum(m for _, _, m, _ in rows)
    value = sum(m * y for _, _, m, y in rows) / size
    best = None
    if depth and size >= min_split and len({y for *_, y in rows}) > 1:
        for f in (0, 1):
            xs = sorted({r[f] for r in rows})
            for a, b in zip(xs, xs[1:]):
                left, right = [r for r in rows if r[f] <= a], [r for r in rows if r[f] > a]
                counts = [sum(m for _, _, m, _ in part) for part in (left, right)]
                if min(counts) >= min_leaf:
                    gain = round(sum(sum(m * y for _, _, m, y in part) ** 2 / n for part, n in zip((left, right), counts)), 6)
                    if best is None or gain > best[0]:
                        best = gain, f, (a + b) / 2, left, right
    if best is None:
        return lambda w, h: value
    _, f, cut, left, right = best
    low, high = (_tree(part, depth - 1, min_split, min_leaf) for part in (left, right))
    return lambda w, h: (low if (w, h)[f] <= cut else high)(w, h)


@pytest.mark.parametrize("min_leaf", [1, 3])
def test_one_fit_answers_all_settings(min_leaf):
    """Trees grown by themselves for each setting give what the nested fit gives."""
    rng = np.random.default_rng(9)
    place = rng.permutation([(w, h) for w in range(7) for h in range(0, 20, 2)])[:45]
    w, h = place.T
    rows = rng.integers(0, 4, 45)
    mean = np.where(rows > 0, np.round(w * 3 + np.sin(h) * 5 + rng.normal(0, 2, 45), 1), 0.0)
    trees, depths, splits = (1, 4), (1, 3, 12), (2, 6)
    got = forest.forest_values(w, h, rows, mean, trees, depths, splits, min_leaf, np.random.default_rng(2))
    n = rows.sum()
    drawn = np.random.default_rng(2).multinomial(n, rows / n, size=4)
    for i, t in enumerate(trees):
        for j, d in enumerate(depths):
            for k, s in enumerate(splits):
                grown = [_tree([x for x in zip(w.tolist(), h.tolist(), draw.tolist(), mean.tolist()) if x[2]], d, s, min_leaf) for draw in drawn[:t]]
                want = [np.mean([tree(*x) for tree in grown]) for x in place.tolist()]
                assert np.allclose(got[i, j, k], want)


@pytest.mark.parametrize("min_leaf", [1, 2, 4])
def test_fits_share_draws_and_forecast_only_what_is_asked(min_leaf):
    rng = np.random.default_rng(4)
    place = rng.permutation([(w, h * 3600) for w in range(7) for h in range(24)])[:60]
    w, h = place.T
    rows = np.where(np.arange(60) % 5 == 0, 0, rng.integers(1, 4, 60))
    mean = np.where(rows > 0, np.round(rng.gamma(1, 30, 60), 2), 0.0)
    n, asked = rows.sum(), np.flatnonzero(rows == 0)
    drawn = forest.draws(rows, 6, np.random.default_rng(5))
    assert (drawn == np.random.default_rng(5).multinomial(n, rows / n, size=6)).all()
    got = forest.forest_values(w, h, rows, mean, (2, 6), (2, 10, 40), (2, 5, 10), min_leaf, drawn, asked)
    assert got.shape == (2, 3, 3, len(asked))
    for j, d in enumerate((2, 10, 40)):
        for k, s in enumerate((2, 5, 10)):
            grown = [_tree([x for x in zip(w.tolist(), h.tolist(), draw.tolist(), mean.tolist()) if x[2]], d, s, min_leaf) for draw in drawn]
            each = np.array([[tree(*x) for x in place[asked].tolist()] for tree in grown])
            assert np.allclose(got[0, j, k], each[:2].mean(0)) and np.allclose(got[1, j, k], each.mean(0))


def test_forest_of_few_rows(spark):
    rows = [("one", "Monday", 0, 5.0), ("null", "Monday", 0, None), ("two", "Monday", 0, 2.0), ("two", "Friday", 0, 4.0), (None, "Monday", 0, 1.0), ("two", None, 0, 9.0)]
    train = spark.createDataFrame([(*r, "2024-01-01") for r in rows], "detid string, weekday string, interval_s int, traffic double, day string")
    asked = spark.createDataFrame([(k, "Friday", 3600) for k in ("one", "null", "two", "other")], "detid string, weekday string, interval_s int")
    got = {r["detid"]: r["traffic"] for r in forest.forecast_points(train, asked, forest.one_tree(train, 2), bootstrap=False).collect()}
    assert got == {"one": 5.0, "two": 4.0}
    bagged = {r["detid"]: r["traffic"] for r in forest.forecast_points(train, asked, forest.one_tree(train, 2).withColumn("trees", F.lit(50))).collect()}
    assert bagged["one"] == 5.0 and 2.0 < bagged["two"] < 4.0
    assert forest.tune_forest(train.limit(0)).count() == 0


def test_polynomial_equals_numpy(spark, tables):
    train, _ = tables
    got = {r["detid"]: r["coef"] for r in polynomial.fit_polynomial(train, 3).collect()}
    for key, group in train.toPandas().groupby("detid"):
        want = np.polyfit(group["interval_s"] / 86400, group["traffic"], 3)[::-1]
        assert np.allclose(got[key], want, rtol=1e-6)


def test_knn_stays_within_its_neighbours(tables):
    train, test = tables
    best = knn.tune_knn(train)
    rows = best.collect()
    assert {r["detid"] for r in rows} == set(SENSORS)
    assert all(r["k"] in knn.NEIGHBOURS and r["weights"] in knn.WEIGHTS for r in rows)
    low, high = train.agg(F.min("traffic"), F.max("traffic")).first()
    out = knn.predict_knn(train, best, "Friday", [0, 3600, 82800]).collect()
    assert len(out) == 9 and all(low <= r["traffic"] <= high for r in out)
    assert knn.eval_knn(train, test, best).where("MAE < 4").count() == 3


def test_knn_with_fewer_rows_than_neighbours_and_unknown_sensor(spark):
    train = spark.createDataFrame(
        [("a", "Monday", 0, "2024-01-01", 2.0), ("a", "Tuesday", 3600, "2024-01-02", 4.0)],
        "detid string, weekday string, interval_s int, day string, traffic double",
    )
    asked = spark.createDataFrame([("a", "Monday", 0), ("x", "Monday", 0)], "detid string, weekday string, interval_s int")
    best = spark.createDataFrame([("a", 5, 1, "uniform")], "detid string, k int, p int, weights string")
    assert [(r["detid"], r["traffic"]) for r in knn.forecast_points(train, asked, best).collect()] == [("a", 3.0)]


def test_random_baseline(tables):
    train, test = tables
    model = baseline.fit_random(train)
    assert model.count() == 3 * 7 * 288
    bounds = train.groupBy("detid").agg(F.percentile("traffic", F.lit(0.25)).alias("a"), F.percentile("traffic", F.lit(0.75)).alias("b"))
    outside = model.join(bounds, "detid").where("traffic < rint(a) or traffic > rint(b)")
    assert outside.isEmpty()
    assert baseline.predict_random(model, "Sunday").count() == 72
    assert baseline.eval_random(test, model).first()["avg_MAE"] > 0
    with pytest.raises(ValueError):
        baseline.fit_random(train, kind="normal")


def test_pooled_neighbours_when_codes_lie_farther_apart_than_hours(spark):
    """Ten rows at hour 0 with far codes, ten at 3600 with near ones: the near ones are nearest."""
    from loopweave.models.knn_pooled import pooled_fans

    rows = [(9990 + i, 0, 0, f"2024-01-{i + 1:02d}", 1.0) for i in range(10)] + [(i, 0, 3600, f"2024-01-{i + 1:02d}", 5.0) for i in range(10)]
    points = spark.createDataFrame(rows, "code long, w int, h int, day string, y double")
    asked = spark.createDataFrame([(0, 0, 0)], "code long, w int, h int")
    got = {r["k"]: r["u1"] for r in pooled_fans(points, asked).collect()}
    assert got[10] == 5.0


def test_week_predictions_hold_every_model_and_weekday(spark, tables):
    from loopweave.plans import predictions

    train, _ = tables
    best = forest.one_tree(train, 3)
    setting = train.select("detid").distinct().select("detid", F.lit(3).alias("k"), F.lit(1).alias("p"), F.lit("uniform").alias("weights"))
    out = predictions.week_predictions(train, knn_settings=setting, forest_settings=best, bootstrap=False)
    counts = {r["model"]: r["count"] for r in out.where("traffic is not null").groupBy("model").count().collect()}
    assert counts == {"random": 3 * 7 * 288, "knn": 3 * 7 * 24, "forest": 3 * 7 * 24, "seasonal": 3 * 7 * 24}
    only = predictions.week_predictions(train, ["forest"], [0, 3600], forest_settings=best, bootstrap=False)
    day = forest.forecast_points(train, predictions.week_queries(best, [0, 3600]), best, bootstrap=False)
    assert sorted(only.drop("model").collect()) == sorted(day.collect())
    with pytest.raises(ValueError):
        predictions.week_predictions(train, ["prophecy"])


@pytest.mark.parametrize("step", [1, 3, 300])
def test_neighbours_on_any_step(spark, step):
    """Intervals closer than a week of weekdays: both distances against all pairs."""
    rng = np.random.default_rng(step)
    rows = [(int(rng.integers(0, 7)), int(rng.integers(0, 25)) * step, f"2024-{i // 28 + 1:02d}-{i % 28 + 1:02d}", float(i)) for i in range(120)]
    points = spark.createDataFrame([("a", *x) for x in rows], "detid string, w int, h int, day string, y double")
    asked = [(w, h * step) for w in (0, 3, 6) for h in (0, 7, 24, 30)]
    got = {(r["w"], r["h"], r["k"]): r for r in knn.fans(points, spark.createDataFrame([("a", *x) for x in asked], "detid string, w int, h int"), ["detid"]).collect()}
    for w, h in asked:
        for p in (1, 2):
            near = sorted((abs(a - w) + abs(b - h) if p == 1 else float(np.hypot(a - w, b - h)), day, b, y) for a, b, day, y in rows)
            for k in knn.NEIGHBOURS:
                assert got[w, h, k][f"u{p}"] == pytest.approx(np.mean([x[3] for x in near[:k]]))
