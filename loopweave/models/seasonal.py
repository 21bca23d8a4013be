"""Additive trend + daily season on the folded week, per sensor or pooled.

The model follows Taylor & Letham (2018), "Forecasting at scale": piecewise linear trend plus
Fourier terms, with a Laplace prior on the changes of the trend, normal priors on the other terms
and a half-normal prior on the noise. The most probable parameters are found by turns: a ridge
solve in which a change weighs by its last size, then the noise in closed form from the residuals.

Features depend on the second of the week only. Spark therefore reduces each sensor to its
week slots (count, sum, sum of squares of the index), at most a few hundred numbers, and
Python solves one small system per sensor from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import DAY_S, HOUR_S, WEEKDAYS, folded_timestamp, week_second
from ..operators.keyed import never_broadcast, spread
from ..operators.metrics import join_actual, regression_metrics

WEEK_S = 7 * DAY_S
FOURIER_ORDER = 4
CHANGEPOINTS = 25
# The trend may bend in the first part of the history only.
CHANGEPOINT_RANGE = 0.8
# Changepoint priors of the two models and of the tuning run, and the normal quantile of an 80 % band.
PRIOR_PER_SENSOR = 0.5
PRIOR_POOLED = 0.01
PRIORS = (0.005, 0.05, 0.5, 1.0, 10.0)
BAND_Z = 1.2816
SEASON_PRIOR = 10.0
TREND_PRIOR = 5.0
NOISE_PRIOR = 0.5
# Turns of the fit; smallest change and noise variance (in units of the index's root mean square) they divide by.
TURNS = 12
LEAST_BEND = 1e-4
LEAST_VARIANCE = 1e-4

MODEL_FIELDS = "coef array<double>, sigma double, n bigint"


def features(second: Column, weekday_effect: bool = False) -> Column:
    """Feature array of a second of the week: 1, trend, bends, daily sine and cosine pairs."""
    t = second / F.lit(float(WEEK_S))
    parts = [F.lit(1.0), t]
    parts += [F.greatest(t - F.lit(_knot(i)), F.lit(0.0)) for i in range(CHANGEPOINTS)]
    angle = second / F.lit(float(DAY_S)) * F.lit(2.0) * F.pi()
    for j in range(1, FOURIER_ORDER + 1):
        parts += [F.sin(angle * j), F.cos(angle * j)]
    if weekday_effect:
        # Sunday is the base; second 604800 is Monday again.
        number = F.floor(second / DAY_S) % 7
        parts += [F.when(number == d, 1.0).otherwise(0.0) for d in range(6)]
    return F.array(*parts)


def _knot(i: int) -> float:
    return CHANGEPOINT_RANGE * (i + 1) / (CHANGEPOINTS + 1)


def week_slots_sums(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, sum and sum of squares of the index per key and second of the week."""
    second = week_second("weekday", "interval_s")
    rows = train.where(second.isNotNull() & F.col("traffic").isNotNull())
    y = F.col("traffic").cast("double")
    return rows.groupBy(*keys, second.alias("second")).agg(
        F.count(F.lit(1)).alias("m"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")
    )


def fit_seasonal(
    train: DataFrame,
    key: str = "detid",
    priors: Sequence[float] = (PRIOR_PER_SENSOR,),
    weekday_effect: bool = False,
) -> DataFrame:
    """Model table: key, ``prior``, coefficients, residual deviation ``sigma`` and row count ``n``."""
    slots = week_slots_sums(train, [key]).withColumn("x", features(F.col("second"), weekday_effect))
    # One entry per slot of the week: bounded by the calendar, whatever the sensor's row count.
    gathered = slots.groupBy(key).agg(F.collect_list(F.struct("x", "m", "sy", "syy")).alias("slots"))
    tasks = gathered.withColumn("prior", F.explode(F.array(*[F.lit(float(p)) for p in priors])))
    return tasks.mapInPandas(_solver(key), f"{_field(train, key)}, prior double, {MODEL_FIELDS}")


def _field(df: DataFrame, key: str) -> str:
    return f"`{key}` {df.schema[key].dataType.simpleString()}"


def _solver(key: str):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            coefs, sigmas, counts = [], [], []
            for slots, prior in zip(batch["slots"], batch["prior"]):
                x = np.array([list(s["x"]) for s in slots], dtype=float)
                m = np.array([s["m"] for s in slots], dtype=float)
                sy = np.array([s["sy"] for s in slots], dtype=float)
                syy = sum(s["syy"] for s in slots)
                coef, sigma = _most_probable(np, (x * m[:, None]).T @ x, x.T @ sy, syy, m.sum(), prior)
                coefs.append(coef)
                sigmas.append(sigma)
                counts.append(int(m.sum()))
            out = batch[[key, "prior"]].copy()
            out["coef"], out["sigma"], out["n"] = coefs, sigmas, counts
            yield out

    return solve


def _most_probable(np, gram, right, syy: float, n: float, prior: float) -> tuple[list[float], float]:
    """Coefficients and noise deviation from the sums of a design: 1, trend, bends, then terms with the season's prior.

    The index is scaled by its root mean square, so priors are unit-free.
    """
    scale = np.sqrt(syy / n) or 1.0
    right, square = right / scale, syy / scale**2
    penalty = np.full(len(right), 1.0 / SEASON_PRIOR**2)
    penalty[:2] = 1.0 / TREND_PRIOR**2
    bends = slice(2, 2 + CHANGEPOINTS)
    size, variance = np.full(CHANGEPOINTS, prior), NOISE_PRIOR**2
    for _ in range(TURNS):
        penalty[bends] = 1.0 / (prior * size)
        coef = np.linalg.solve(gram / variance + np.diag(penalty), right / variance)
        sse = max(float(square - 2 * coef @ right + coef @ gram @ coef), 0.0)
        # the root of -n / s + sse / s^3 - s / NOISE_PRIOR^2, for the variance s^2
        variance = max(2 * sse / (n + np.sqrt(n * n + 4 * sse / NOISE_PRIOR**2)), LEAST_VARIANCE)
        size = np.maximum(np.abs(coef[bends]), LEAST_BEND)
    return [float(c * scale) for c in coef], float(np.sqrt(variance) * scale)


def _value(weekday_effect: bool) -> Column:
    pairs = F.zip_with(features(F.col("second"), weekday_effect), F.col("coef"), lambda a, b: a * b)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)


def _banded(df: DataFrame, value: Column) -> DataFrame:
    df = df.withColumn("traffic", value)
    return df.withColumn("yhat_lower", F.col("traffic") - F.lit(BAND_Z) * F.col("sigma")).withColumn(
        "yhat_upper", F.col("traffic") + F.lit(BAND_Z) * F.col("sigma")
    )


def predict_seasonal(model: DataFrame, weekday: str, key: str = "detid", weekday_effect: bool = False) -> DataFrame:
    """The 24 hours of a weekday for every sensor, with an 80 % band."""
    number = WEEKDAYS.index(weekday)
    hours = F.sequence(F.lit(number * DAY_S), F.lit(number * DAY_S + DAY_S - HOUR_S), F.lit(HOUR_S))
    asked = model.withColumn("second", F.explode(hours))
    shown = _banded(asked, _value(weekday_effect)).withColumn("interval_s", F.col("second") - number * DAY_S)
    return shown.select(key, "interval_s", "traffic", "yhat_lower", "yhat_upper")


def forecast_rows(rows: DataFrame, model: DataFrame, key: str = "detid", weekday_effect: bool = False) -> DataFrame:
    """Rows (key, weekday, interval_s) with ``traffic_actual`` and ``traffic_pred``; sensors without a model are left out."""
    asked = rows.withColumn("second", week_second("weekday", "interval_s")).where(F.col("second").isNotNull())
    joined = asked.join(model, key).withColumn("traffic_pred", _value(weekday_effect))
    extra = ["prior"] if "prior" in model.columns else []
    return joined.select(key, *extra, "weekday", "interval_s", F.col("traffic").alias("traffic_actual"), "traffic_pred")


def eval_seasonal(test: DataFrame, model: DataFrame, key: str = "detid", weekday_effect: bool = False) -> DataFrame:
    return regression_metrics(forecast_rows(test, model, key, weekday_effect), [key])


def tune_seasonal(train: DataFrame, test: DataFrame, priors: Sequence[float] = PRIORS, key: str = "detid") -> DataFrame:
    """Scores per sensor and prior; all priors are fitted from the same slot sums."""
    model = fit_seasonal(train, key, priors)
    return regression_metrics(forecast_rows(test, model, key), [key, "prior"])


def fit_pooled(train: DataFrame, codes: DataFrame, key: str = "detid", prior: float = PRIOR_POOLED) -> DataFrame:
    """One model over all sensors with the sensor's code as linear regressor. One row.

    ``codes``: key and ``code``. All rows are first reduced to sums per second of the week,
    so the single solve sees one entry per slot.
    """
    coded = train.join(codes.select(key, "code"), key)
    second = week_second("weekday", "interval_s")
    y, c = F.col("traffic").cast("double"), F.col("code").cast("double")
    sums = (
        coded.where(second.isNotNull() & y.isNotNull())
        .groupBy(second.alias("second"))
        .agg(
            F.count(F.lit(1)).alias("m"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
            F.sum(c).alias("sc"), F.sum(c * c).alias("scc"), F.sum(c * y).alias("scy"),
        )
        .withColumn("x", features(F.col("second")))
    )
    one = sums.agg(F.collect_list(F.struct("x", "m", "sy", "syy", "sc", "scc", "scy")).alias("slots"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            rows = []
            for slots in batch["slots"]:
                if not len(slots):
                    continue
                x = np.array([list(s["x"]) for s in slots], dtype=float)
                col = {f: np.array([s[f] for s in slots], dtype=float) for f in ("m", "sy", "syy", "sc", "scc", "scy")}
                n = col["m"].sum()
                span = np.sqrt(col["scc"].sum() / n) or 1.0
                cross = x.T @ (col["sc"] / span)
                top = np.hstack([(x * col["m"][:, None]).T @ x, cross[:, None]])
                gram = np.vstack([top, np.append(cross, col["scc"].sum() / span**2)])
                right = np.append(x.T @ col["sy"], col["scy"].sum() / span)
                coef, sigma = _most_probable(np, gram, right, float(col["syy"].sum()), n, prior)
                coef[-1] /= span
                rows.append((coef, sigma, int(n)))
            yield pd.DataFrame(rows, columns=["coef", "sigma", "n"])

    return one.mapInPandas(solve, MODEL_FIELDS)


def forecast_pooled(rows: DataFrame, model: DataFrame, codes: DataFrame, key: str = "detid") -> DataFrame:
    """Forecasts of the pooled model; ``codes`` are those of the train set."""
    fitted = model.select(F.struct("coef", "sigma")).scalar()
    asked = (
        rows.join(codes.select(key, "code"), key)
        .withColumn("second", week_second("weekday", "interval_s"))
        .where(F.col("second").isNotNull())
        .withColumn("_m", fitted)
        .withColumn("coef", F.col("_m.coef"))
        .withColumn("sigma", F.col("_m.sigma"))
    )
    value = _value_with_code()
    actual = asked.withColumnRenamed("traffic", "traffic_actual")
    shown = _banded(actual, value).withColumnRenamed("traffic", "traffic_pred")
    return shown.select(key, "weekday", "interval_s", "traffic_actual", "traffic_pred", "yhat_lower", "yhat_upper")


def _value_with_code() -> Column:
    design = F.concat(features(F.col("second")), F.array(F.col("code").cast("double")))
    return F.aggregate(F.zip_with(design, F.col("coef"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def eval_pooled(forecast: DataFrame) -> DataFrame:
    """MAE, MSE and R2 over all rows."""
    return regression_metrics(forecast, [])


def future_frame(train: DataFrame, key: str = "detid", steps: int = 300) -> DataFrame:
    """``steps`` hourly timestamps after the end of each sensor's folded series."""
    last = train.groupBy(key).agg(F.max(week_second("weekday", "interval_s")).alias("_last"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    seconds = spread(last.where(F.col("_last").isNotNull())).select(key, "_last", ahead)
    second = F.col("_last") + F.col("step") * HOUR_S
    return seconds.select(key, second.alias("second"), folded_timestamp(second).alias("ds"))


def predict_future(model: DataFrame, future: DataFrame, key: str = "detid", weekday_effect: bool = False) -> DataFrame:
    """Forecast along a future frame; the last trend continues, weekdays repeat."""
    shown = _banded(never_broadcast(future).join(model, key), _value(weekday_effect))
    return shown.select(key, "ds", "traffic", "yhat_lower", "yhat_upper")


def score_predictions(test: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scores per sensor of any prediction table keyed by sensor, weekday and interval."""
    return regression_metrics(join_actual(test, predictions))
