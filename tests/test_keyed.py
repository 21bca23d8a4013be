"""Rank selection against numpy, with one key that holds most of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loopweave.operators import keyed


def skewed(spark, n_hot=6000, n_cold=40, kind="float"):
    rng = np.random.default_rng(3)
    parts = [("hot", rng.gamma(2.0, 50.0, n_hot))]
    parts += [(f"k{i}", rng.normal(0, 10, rng.integers(1, 60))) for i in range(n_cold)]
    rows = pd.DataFrame([(k, float(v)) for k, vs in parts for v in vs], columns=["k", "v"])
    if kind == "int":
        rows["v"] = rows["v"].round()
    if kind == "close":
        # All values of the hot key share a handful of cells.
        rows["v"] = 1e6 + rows["v"] * 1e-3
    rows.insert(0, "row_id", range(len(rows)))
    return rows, spark.createDataFrame(rows)


@pytest.mark.parametrize("kind", ["float", "int", "close"])
def test_quantiles_equal_numpy(spark, kind):
    rows, df = skewed(spark, kind=kind)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.72, "e": 1.0}
    got = {r["k"]: r for r in keyed.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(rows["k"])
    for key, group in rows.groupby("k"):
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(group["v"], p), rel=1e-12, abs=1e-12)


def test_quantiles_without_key_and_with_missing_values(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (4.0,)], "v double")
    assert keyed.exact_quantiles(df, (), "v", {"m": 0.5}).first()["m"] == 2.0
    nothing = spark.createDataFrame([("a", None)], "k string, v double")
    assert keyed.exact_quantiles(nothing, ["k"], "v", {"m": 0.5}).count() == 0


def test_parts_of_groups(spark):
    rows, df = skewed(spark, n_hot=1000)
    order = ("v", "row_id")

    def starts(n):
        size = F.floor(n / 24).cast("bigint")
        return [size * i for i in range(1, 24)]

    cuts = keyed.starts_of_parts(df, ["k"], order, [F.floor("v")], starts)
    tagged = df.join(cuts, "k").withColumn("part", keyed.part_number(order, 24)).toPandas()
    for _, group in tagged.groupby("k"):
        group = group.sort_values(list(order)).reset_index(drop=True)
        size = len(group) // 24
        want = [23] * len(group) if size == 0 else [min(i // size, 23) for i in range(len(group))]
        assert list(group["part"]) == want


def test_positions_in_the_whole_table(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "ab", "aa", "abc", "z", "a"]], "w string")
    got = {r["w"]: r["code"] for r in keyed.global_positions(df, ["w"], F.substring("w", 1, 1)).collect()}
    assert got == {w: i for i, w in enumerate(sorted(got))}


def test_settled_tables_live_in_the_checkpoint_folder(spark):
    settled = keyed.settle(spark.range(10))
    root = keyed.scratch_root(spark).replace("file://", "").replace("file:", "")
    assert settled.count() == 10 and root in settled.inputFiles()[0]


def test_no_group_is_gathered_for_quantiles(spark):
    """The plan counts cells before anything is partitioned by the key alone."""
    _, df = skewed(spark, kind="int")
    text = keyed.exact_quantiles(df, ["k"], "v", {"m": 0.5})._jdf.queryExecution().toString()
    assert "percentile" not in text and "LogicalRDD" not in text


@pytest.mark.parametrize("kind", ["float", "int", "close"])
def test_quantiles_of_the_whole_table(spark, kind):
    """Several ranges of cells, each with its own running counts."""
    rows, df = skewed(spark, kind=kind)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.72, "e": 1.0}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keyed.exact_quantiles(df, (), "v", probs).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(rows["v"], p), rel=1e-12, abs=1e-12)
    assert keyed.exact_quantiles(df.limit(0), (), "v", probs).count() == 0


def test_few_keys_give_what_many_give(spark):
    rows, df = skewed(spark, n_cold=3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keyed.exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.9}, few_keys=True).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got) == sorted(keyed.exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.9}).collect()) and len(got) == 4


def test_global_positions_over_many_blocks(spark):
    df = spark.range(0, 5000).selectExpr("(id * 7919) % 5000 as x")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = keyed.global_positions(df, ["x"], F.floor(F.col("x") / 3)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(r["x"] == r["code"] for r in placed) and len(placed) == 5000


@pytest.mark.parametrize("named", [False, True])
def test_ranks_are_looked_for_without_lambdas_over_all_cells(spark, named, monkeypatch):
    """Only the cells that hold a rank reach the array of ranks; a condition of the caller finds the same ones."""
    rows, df = skewed(spark, n_hot=700)
    plans = []
    settle = keyed.settle

    def spied(table):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return settle(table)

    monkeypatch.setattr(keyed, "settle", spied)
    cell = ["row_id"] if named else [F.floor(F.col("row_id") / 7)]

    def starts(n):
        return [F.floor(n / 24).cast("bigint") * i for i in range(1, 24)]

    def some(n, first, end):
        size = F.floor(n / 24)
        part = F.greatest(F.ceil(first / F.greatest(size, F.lit(1))), F.lit(1))
        return (part < 24) & (size * part >= first) & (size * part < end)

    plain = keyed.starts_of_parts(df, ["k"], ["row_id"], cell, starts).collect()
    asked = keyed.starts_of_parts(df, ["k"], ["row_id"], cell, starts, some).collect()
    assert sorted(plain) == sorted(asked) and len(plain) == rows["k"].nunique()
    wanted = [p for p in plans if "_ranks" in p and "_before" not in p]
    assert wanted and all("lambda" not in line for p in wanted for line in p.splitlines() if line.strip(" :+-").startswith("Filter"))
    for r in asked:
        mine = rows["row_id"][rows["k"] == r["k"]].sort_values().to_numpy()
        size = len(mine) // 24
        assert [x["row_id"] for x in r["_starts"]] == [mine[size * i] for i in range(1, 24)]
