"""Encodings of categorical columns and polynomial fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import keyed

def _codes(values: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Positions 0..n-1 of distinct values in sorted order: sorted into ranges, ranked inside each, plus the ranges' counts."""
    ranged = values.repartitionByRange(column).withColumn("_range", F.spark_partition_id())
    return keyed.global_positions(keyed.settle(ranged), [column], F.col("_range"), out)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Table of the distinct values in sorted order with ``code`` 0..n-1."""
    return _codes(df.where(F.col(column).isNotNull()).select(column).distinct(), column)


def label_encode(df: DataFrame, column: str, codes: DataFrame | None = None, out: str = "code") -> DataFrame:
    """Adds the code of ``column``. Pass the ``codes`` of the train set to encode a test set; unknown values give NULL."""
    codes = keyed.settle(label_codes(df, column)) if codes is None else codes
    return df.join(codes.select(column, F.col("code").alias(out)), column, "left")


def factorize(df: DataFrame, column: str, order: str, block: int | None = None, out: str = "code") -> DataFrame:
    """Codes in order of first appearance; ``order`` is a unique non-negative integer row number.

    First appearances are ranked in ranges that Spark balances, or in blocks of ``block`` row numbers.
    """
    first = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    if block is None:
        codes = _codes(first, "_first", out)
    else:
        codes = keyed.global_positions(first, ["_first"], F.floor(F.col("_first") / block), out)
    return df.join(keyed.settle(codes.select(column, out)), column, "left")


def onehot_encode(
    df: DataFrame, column: str, categories: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """0/1 column ``column_value`` per category; the column itself goes.

    Without ``categories`` the distinct values are looked up: each becomes a column, so their names must reach the
    driver. ``limit`` makes more than so many values an error; ``onehot_vector`` needs no column per value.
    """
    if categories is None:
        values = df.where(F.col(column).isNotNull()).select(column).distinct()
        found = (values if limit is None else values.limit(limit + 1)).collect()
        if limit is not None and len(found) > limit:
            raise ValueError(f"{column} has more than {limit} values: use onehot_vector")
        categories = sorted(row[0] for row in found)
    flags = [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).cast("double").alias(f"{column}_{v}")
        for v in categories
    ]
    return df.select("*", *flags).drop(column)


def onehot_vector(df: DataFrame, column: str, out: str = "onehot") -> DataFrame:
    """Sparse 0/1 vector for any number of categories."""
    from pyspark.ml.feature import OneHotEncoder

    coded = label_encode(df, column, out="_code").withColumn("_code", F.col("_code").cast("double"))
    encoder = OneHotEncoder(inputCol="_code", outputCol=out, dropLast=False, handleInvalid="keep")
    return encoder.fit(coded).transform(coded).drop("_code")
