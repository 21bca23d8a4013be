"""Files, partition pruning and the physical plans that matter at scale."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from loopweave import scratch
from loopweave.models import baseline
from loopweave.operators import aggregate, clean, grid, joins, keyed, outliers
from loopweave.plans import dataset
from loopweave.registry import base
from loopweave.sources import readers, views, writers

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_csv_with_missing_values(spark, tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    (path / "a.csv").write_text(
        "day,interval,detid,flow,occ,error,city,speed\n"
        "2024-01-01,300,EAST_N04/161x1,12.0,NaN,,london,\n"
        "2024-01-02,600,EAST_N04/161x1,,0.5,1,london,3.0\n"
    )
    df = readers.read_csv(spark, str(path), readers.READINGS)
    first, second = df.orderBy("interval_s").collect()
    assert first["day"] == datetime.date(2024, 1, 1) and first["occ"] is None and first["error"] is None
    assert second["flow"] is None and second["error"] == 1
    assert readers.read_csv(spark, str(path), readers.READINGS, where="interval_s > 300").count() == 1
    assert readers.read_csv(spark, str(path), readers.READINGS, nrows=1).count() == 1


def test_predictions_are_pruned_by_model_and_weekday(spark, tmp_path):
    keys = spark.createDataFrame([("a-b/c",), ("d",)], "detid string")
    table = baseline.week_slots(keys, 3600).withColumn("traffic", F.lit(1.0)).withColumn("model", F.lit("knn"))
    path = str(tmp_path / "p")
    writers.store_predictions(table, path)
    writers.store_predictions(table.withColumn("model", F.lit("random")), path)
    found = writers.load_predictions(spark, path, "knn", "Monday")
    assert found.count() == 48 and "a-b/c" in {r["detid"] for r in found.collect()}
    assert re.search(r"PartitionFilters: \[.*model.*weekday", physical(found))


def test_city_table_is_pruned(spark, tmp_path):
    df = spark.createDataFrame([("a", "london"), ("b", "paris")], "detid string, citycode string")
    writers.write_city({"detectors": df}, str(tmp_path))
    found = readers.read_table(spark, str(tmp_path / "detectors"), "citycode = 'london'")
    assert [r["detid"] for r in found.collect()] == ["a"]
    assert re.search(r"PartitionFilters: \[.*citycode", physical(found))


def test_box_is_expanded_by_many_tasks(spark):
    ends = spark.createDataFrame([(0.001, 50.0), (8.0, 54.0)], "lon double, lat double")
    for snap in ("round", "floor"):
        cells = grid.complete_grid(ends, snap=snap).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in cells.groupBy("task").count().collect()]
        assert len(per_task) > 1 and max(per_task) < sum(per_task) / 2
        assert sum(per_task) == 801 * 401
    single = grid.complete_grid(ends.limit(1).withColumn("k", F.lit("a")), keys=["k"])
    assert [tuple(r) for r in single.collect()] == [("a", 0, 5000)]
    assert grid.complete_grid(ends.limit(0)).count() == 0


def test_keyless_ranks_need_no_single_task(spark):
    """Quantiles of the whole table: no window over all cells, nor over all ranges."""
    rows = base.hourly(spark, SF)
    settled = []
    keep = keyed.settle
    keyed.settle = lambda df: (settled.append(physical(df)), keep(df))[1]
    try:
        found = keyed.exact_quantiles(rows, (), "traffic", {"q25": 0.25, "q72": 0.72})
    finally:
        keyed.settle = keep
    plans = [*settled, physical(found)]
    assert len(plans) > 1 and not any(re.search(r"windowspecdefinition\(_all|windowspecdefinition\(_cell", p) for p in plans)
    assert any("windowspecdefinition(_range" in p for p in plans)


def _tables(spark) -> set[str]:
    root = scratch.scratch_root(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {str(f.getPath().getName()) for f in fs.listStatus(path)} if fs.exists(path) else set()


def test_a_scope_deletes_what_it_does_not_keep(spark):
    before = _tables(spark)
    with scratch.scope(spark) as keep:
        first = scratch.settle(spark.range(10))
        with scratch.scope(spark) as keep_inner:
            inner = scratch.settle(first.where("id > 3"))
            passed = keep_inner(inner.where("id > 5"))
        assert passed.count() == 4 and len(_tables(spark) - before) == 2
        result = keep(passed.where("id > 7"))
    assert [r["id"] for r in result.orderBy("id").collect()] == [8, 9]
    assert len(_tables(spark) - before) == 1
    with pytest.raises(ZeroDivisionError):
        with scratch.scope(spark):
            scratch.settle(spark.range(3))
            1 / 0
    assert len(_tables(spark) - before) == 1


def test_recorded_tables_are_dropped_later(spark):
    before = _tables(spark)
    with scratch.recorded() as paths:
        table = scratch.settle(spark.range(5))
    assert table.count() == 5 and len(_tables(spark) - before) == 1
    scratch.drop(spark, paths)
    assert _tables(spark) == before and paths == []


def test_build_dataset_leaves_only_its_results(spark):
    before = _tables(spark)
    data, flags = dataset.build_dataset(views.readings(spark, SF), views.detectors(spark, SF))
    assert len(_tables(spark) - before) <= 3  # the hourly table, the flags, the index's ends
    assert data.count() >= 0 and flags.count() > 0


def test_formats_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.write_dataset(spark.range(1), str(tmp_path / "x"), "xml")


def test_scan_reads_only_what_the_flagship_needs(spark):
    text = physical(dataset.flagship(views.readings(spark, SF), views.detectors(spark, SF)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas) == 2
    assert not any("props" in s or "c_name" in s or "c_acctbal" in s for s in schemas)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_reach_the_scan(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").where("value > 100").select("event_id")
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in physical(rows)


def test_first_rows_are_pruned_before_the_shuffle(spark):
    rows = base.clean_rows(spark, SF)
    for df in (
        aggregate.group_head(rows, ["detid"], ["day", "interval_s", "row_id"]),
        joins.first_per_key(rows, ["detid"], ["day", "interval_s", "row_id"]),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.index("WindowGroupLimit") < text.index("Exchange") and text.count("WindowGroupLimit") == 2


def test_row_filters_do_not_shuffle_the_rows(spark):
    """Statistics are small settled tables: the rows meet them in broadcast joins, without an exchange of their own."""
    rows = base.indexed(spark, SF)
    for df in (
        outliers.drop_outliers(rows),
        outliers.drop_flatline(rows, max_repeats=2),
        clean.normalize_minmax(rows),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "CartesianProduct" not in text
        assert not re.search(r"Exchange hashpartitioning\(row_id", text)


def test_large_side_tables_fall_back_to_merge_joins(spark):
    """Above the size limit nothing is broadcast, and the result stays the same."""
    rows = base.indexed(spark, SF)
    small = outliers.drop_outliers(rows, factor=2).select("row_id")
    want = {r[0] for r in small.collect()}
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in settings:
            spark.conf.set(name, "-1")
        large = outliers.drop_outliers(rows, factor=2).select("row_id")
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert {r[0] for r in large.collect()} == want
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_filled_cube_covers_every_cell(spark):
    rows = joins.with_detectors(base.hourly(spark, SF), views.detectors(spark, SF), columns=("lon", "lat"))
    keys = ("weekday",)
    seen = grid.grid_mean(rows, keys=keys)
    full = grid.advanced_grid(seen, grid.complete_grid(rows, keys=keys), keys)
    assert full.count() == 7 * grid.complete_grid(rows).count()
    assert full.where("mean_traffic_index is null").isEmpty()
    spot = [*keys, *grid.CELL]
    changed = full.alias("f").join(seen.alias("s"), spot).where("abs(f.mean_traffic_index - s.mean_traffic_index) > 1e-9")
    assert changed.isEmpty()


def test_dataset_range_and_rescue(spark):
    limits = dataset.Limits(max_repeats=3, min_days=1, min_daily=1, min_iqr=0, min_range=0, anomaly_factor=50, rescue=True)
    data, flags = dataset.build_dataset(views.readings(spark, SF), views.detectors(spark, SF), limits)
    low, high = data.agg(F.min("traffic"), F.max("traffic")).first()
    assert (low, high) == (0, 99)
    assert {"interval_s", "day", "detid", "weekday", "traffic", "lon", "lat", "pos", "length", "fclass"} == set(data.columns)
    assert flags.count() == 0


def test_hot_sensor_is_split_below_an_aggregate(spark):
    """Broadcasts off, one sensor with a third of the rows: the join with the fences is split, also under hourly means."""
    from pyspark.sql import functions as F

    from loopweave.operators import outliers

    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("D/"), (F.col("id") % 600).cast("string")))
        rows = spark.range(120_000).repartition(8).select(hot.alias("detid"), (F.rand(1) * 100).alias("traffic"), F.md5(F.col("id").cast("string")).alias("pad"))
        kept = outliers.drop_outliers(rows)
        means = kept.groupBy("detid").agg(F.avg("traffic").alias("m"), F.max("pad").alias("p"))
        for df in (kept, means):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
