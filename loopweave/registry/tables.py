"""Sources and sinks: each query writes a table to the scratch folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..models import baseline
from ..operators import joins, keyed
from ..plans import dataset
from ..sources import readers, views, writers
from .base import hourly, query, r, rounded, train_test
from ..functions.calendar import WEEKDAYS
from ..plans.predictions import MODELS
from .forecasts import MODEL, PREDICTED, SOLVED, week_predictions
from .grids import CELLS, PLACE, PLACED_XY, placed
from .quality import DATASET_SQL, LIMITS, PLAN_SQL
from .splits import SPLIT_LEAD, draw_sql


def _path(spark, name: str) -> str:
    return f"{keyed.scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "src_csv",
    f"""select detid, day, interval_s, {r('flow')} as flow, {r('occ')} as occ, error from readings where interval_s >= 43200""",
)
def src_csv(spark, sf):
    path = _path(spark, "raw-csv")
    raw = views.readings(spark, sf).select(
        "day", F.col("interval_s").alias("interval"), "detid", "flow", "occ", "error",
        F.lit("city_a").alias("city"), F.col("speed"),
    )
    writers.write_dataset(raw, path, "csv")
    rows = readers.read_csv(spark, path, readers.READINGS, where="interval_s >= 43200")
    return rounded(rows.drop("city", "speed"))


@query("sink_dataset", DATASET_SQL)
def sink_dataset(spark, sf):
    path = _path(spark, "dataset")
    data, _ = dataset.build_dataset(views.readings(spark, sf), views.detectors(spark, sf), LIMITS)
    writers.write_dataset(data, path)
    return rounded(readers.read_table(spark, path))


@query("sink_anomalies", f"{PLAN_SQL} select * from flags")
def sink_anomalies(spark, sf):
    path = _path(spark, "anomalies")
    _, flags = dataset.build_dataset(views.readings(spark, sf), views.detectors(spark, sf), LIMITS)
    writers.write_dataset(flags, path, "csv")
    schema = T.StructType(
        [T.StructField("detid", T.StringType())]
        + [T.StructField(f, T.BooleanType()) for f in ("mean_out_of_bound", "IQR_to_small", "not_enough_data")]
    )
    return readers.read_csv(spark, path, schema)


@query(
    "sink_splits",
    f"""select split_id, case when interval_s // 3600 in (s0, s1) then 'test' else 'train' end as role, detid, weekday, interval_s,
        {r('traffic')} as traffic from (select *, {draw_sql(SPLIT_LEAD)} from hourly, (select cast(range as integer) as split_id from range(2)))""",
)
def sink_splits(spark, sf):
    """All four written parts, each read by itself."""
    path = _path(spark, "splits")
    writers.write_splits(hourly(spark, sf), "Sniper", 2, path, seed=27)
    union = None
    for split_id in range(2):
        for role in ("train", "test"):
            part = writers.read_split(spark, path, split_id, role).withColumns({"split_id": F.lit(split_id), "role": F.lit(role)})
            union = part if union is None else union.unionByName(part)
    return rounded(union.select("split_id", "role", "detid", "weekday", "interval_s", "traffic"))


@query(
    "sink_grid_cube",
    f"""with {CELLS} select weekday, interval_s, cell_x, cell_y, {r('avg(traffic)')} as mean_traffic_index,
        count(detid) as detectors_in_grid, {PLACE}, {PLACED_XY} from cells group by weekday, interval_s, cell_x, cell_y""",
)
def sink_grid_cube(spark, sf):
    path = _path(spark, "cube")
    writers.write_grid_cube(placed(spark, sf), path)
    return rounded(readers.read_table(spark, path))


@query("src_city_table", "select cast(c_custkey as bigint) as c_custkey, c_mktsegment as citycode from customer where c_mktsegment = 'MACHINERY'")
def src_city_table(spark, sf):
    path = _path(spark, "cities")
    table = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("citycode"))
    writers.write_city({"detectors": table}, path)
    return readers.read_table(spark, f"{path}/detectors", "citycode = 'MACHINERY'")


@query(
    "store_predictions",
    f"""with {MODEL} select m.detid, m.interval_s, m.traffic, {r('d.lon')} as lon, {r('d.lat')} as lat from model m
        left join detectors d using (detid) where weekday = 'Monday' and interval_s % 3600 = 0""",
)
def store_predictions(spark, sf):
    path = _path(spark, "predictions")
    model = baseline.fit_random(train_test(spark, sf)[0]).where("interval_s % 3600 = 0")
    writers.store_predictions(model.withColumn("model", F.lit("random")), path)
    found = dataset.weekday_prediction(spark, path, "random", "Monday", views.detectors(spark, sf))
    return rounded(found.select("detid", "interval_s", "traffic", "lon", "lat"))


@query(
    "store_predictions_all",
    f"""{PREDICTED} select model, weekday, p.detid, interval_s, {r('traffic', SOLVED)} as traffic, {r('d.lon', SOLVED)} as lon, {r('d.lat', SOLVED)} as lat
        from predicted p left join detectors d using (detid)""",
)
def store_predictions_all(spark, sf):
    """All models and weekdays written in one plan, then read back by the dispatch over model and weekday, part by part."""
    path = _path(spark, "predictions")
    writers.store_predictions(week_predictions(spark, sf), path)
    detectors, union = views.detectors(spark, sf), None
    for model in MODELS:
        for weekday in WEEKDAYS:
            part = dataset.weekday_prediction(spark, path, model, weekday, detectors)
            union = part if union is None else union.unionByName(part)
    return rounded(union.select("model", "weekday", "detid", "interval_s", "traffic", "lon", "lat"), SOLVED)


@query("store_models", f"with {MODEL} select detid, weekday, interval_s, traffic from model")
def store_models(spark, sf):
    path = _path(spark, "models")
    writers.store_models(baseline.fit_random(train_test(spark, sf)[0]), path)
    return writers.load_models(spark, path)


@query(
    "sink_geojson_points",
    f"""with used as (select distinct detid, 'blue' as colour from readings where flow < 200 union all select distinct detid, 'red' from readings where flow >= 400)
        select detid, 'Point' as kind, colour, 'Detector ID: ' || detid as label, {r('lon')} as lon, {r('lat')} as lat
        from used join detectors using (detid)""",
)
def sink_geojson_points(spark, sf):
    """The written lines, parsed back."""
    from ..operators import grid, outliers

    path = _path(spark, "points")
    rows = joins.with_detectors(views.readings(spark, sf), views.detectors(spark, sf), columns=("lon", "lat"), how="inner")
    points = grid.detector_points(rows.where("flow < 200"), rows.where("flow >= 400"), outliers.READING_ORDER)
    writers.write_geojson(grid.geojson_points(points), path)
    schema = "geometry struct<type: string, coordinates: array<double>>, properties struct<detid: string, colour: string, label: string>"
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("f"))
    place = F.col("f.geometry.coordinates")
    return rounded(lines.select("f.properties.*", F.col("f.geometry.type").alias("kind"), place[0].alias("lon"), place[1].alias("lat")))


@query(
    "sink_geojson_cells",
    f"""with {CELLS} select {PLACE}, 'Polygon' as kind, 5 as corners, count(detid) as detectors_in_grid,
        {r('cell_x / 100 - 0.005')} as first_lon, {r('cell_y / 100 - 0.005')} as first_lat from cells group by cell_x, cell_y""",
)
def sink_geojson_cells(spark, sf):
    """The written lines, parsed back."""
    from ..operators import grid

    path = _path(spark, "cells")
    writers.write_geojson(grid.geojson_cells(grid.grid_mean(placed(spark, sf))), path)
    schema = (
        "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, "
        "properties struct<grid_id: string, detectors_in_grid: bigint>"
    )
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("f"))
    ring = F.col("f.geometry.coordinates")[0]
    return rounded(
        lines.select(
            "f.properties.grid_id", F.col("f.geometry.type").alias("kind"), F.size(ring).alias("corners"),
            "f.properties.detectors_in_grid", ring[0][0].alias("first_lon"), ring[0][1].alias("first_lat"),
        )
    )
