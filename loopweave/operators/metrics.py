"""Regression scores per key, averaged over keys, or pooled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keyed


def _r2(actual: Column, error: Column) -> Column:
    """1 - SSE/SST. Constant actual values: 1 for a perfect fit, else 0. Fewer than two rows: NULL."""
    sse, sst = F.sum(error * error), F.var_pop(actual) * F.count(actual)
    constant = F.max(actual) == F.min(actual)
    return (
        F.when(F.count(actual) < 2, F.lit(None))
        .when(constant, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(sse, sst))
    )


def regression_metrics(
    df: DataFrame, keys: Sequence[str] = ("detid",), actual: str = "traffic_actual", pred: str = "traffic_pred"
) -> DataFrame:
    """MAE, MSE and R2 per key (no keys: pooled). Rows without both values are left out."""
    y, error = F.col(actual), F.col(actual) - F.col(pred)
    return (
        df.where(error.isNotNull())
        .groupBy(*keys)
        .agg(F.avg(F.abs(error)).alias("MAE"), F.avg(error * error).alias("MSE"), _r2(y, error).alias("R2"))
    )


def more_metrics(
    df: DataFrame, keys: Sequence[str] = ("detid",), actual: str = "traffic_actual", pred: str = "traffic_pred"
) -> DataFrame:
    """Explained variance, median absolute error and RMSE per key."""
    keys = list(keys)
    scored = df.withColumn("_e", F.col(actual) - F.col(pred)).where(F.col("_e").isNotNull())
    scored = scored.withColumn("_abs", F.abs("_e"))
    basic = scored.groupBy(*keys).agg(
        (1 - F.try_divide(F.var_pop("_e"), F.var_pop(actual))).alias("explained_variance"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("RMSE"),
    )
    return basic.join(keyed.exact_quantiles(scored, keys, "_abs", {"median_ae": 0.5}), keys)


def macro_average(scores: DataFrame) -> DataFrame:
    """Unweighted mean of the per-key scores."""
    return scores.agg(*[F.avg(m).alias(f"avg_{m}") for m in ("MAE", "MSE", "R2")])


def join_actual(
    test: DataFrame,
    predictions: DataFrame,
    on: Sequence[str] = ("detid", "weekday", "interval_s"),
    value: str = "traffic",
) -> DataFrame:
    """Test rows with their prediction; rows without one are left out."""
    on = list(on)
    forecasts = keyed.never_broadcast(predictions.select(*on, F.col(value).alias(f"{value}_pred")))
    return test.select(*on, F.col(value).alias(f"{value}_actual")).join(forecasts, on)
