"""Polynomial least squares of the index on the interval, per sensor."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import DAY_S
from ..operators.metrics import _r2

# The interval is scaled to days before powers are taken, which keeps the system well conditioned.
SCALE = float(DAY_S)


def fit_polynomial(
    df: DataFrame, degree: int = 4, keys: Sequence[str] = ("detid",), x: str = "interval_s", y: str = "traffic"
) -> DataFrame:
    """Coefficients per key, lowest power first, in units of x / 86400.

    Spark reduces each key to its power sums; Python only solves one small system per key.
    """
    keys = list(keys)
    u, v = F.col(x) / F.lit(SCALE), F.col(y).cast("double")
    rows = df.where(u.isNotNull() & v.isNotNull())
    sums = rows.groupBy(*keys).agg(
        F.array(*[F.sum(F.pow(u, F.lit(float(j)))) for j in range(2 * degree + 1)]).alias("xx"),
        F.array(*[F.sum(F.pow(u, F.lit(float(j))) * v) for j in range(degree + 1)]).alias("xy"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    return sums.mapInPandas(_solver(keys, degree), f"{schema}, coef array<double>")


def _solver(keys: list[str], degree: int):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        lattice = np.add.outer(np.arange(degree + 1), np.arange(degree + 1))
        for batch in batches:
            out = batch[keys].copy()
            out["coef"] = [
                list(map(float, np.linalg.lstsq(np.asarray(xx)[lattice], np.asarray(xy), rcond=None)[0]))
                for xx, xy in zip(batch["xx"], batch["xy"])
            ]
            yield out

    return solve


def score_polynomial(
    df: DataFrame, model: DataFrame, keys: Sequence[str] = ("detid",), x: str = "interval_s", y: str = "traffic"
) -> DataFrame:
    """RMSE and R2 of the fitted curve on ``df``, per key."""
    keys = list(keys)
    u = F.col(x) / F.lit(SCALE)
    # Horner's scheme from the highest power down.
    curve = F.aggregate(F.reverse("coef"), F.lit(0.0), lambda acc, c: acc * u + c)
    error = F.col(y) - F.col("_pred")
    return (
        df.join(model, keys)
        .withColumn("_pred", curve)
        .where(error.isNotNull())
        .groupBy(*keys)
        .agg(F.sqrt(F.avg(error * error)).alias("RMSE"), _r2(F.col(y), error).alias("R2"))
    )
