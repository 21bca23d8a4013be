"""Spatial grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid, joins, outliers
from ..plans import dataset
from ..sources import views
from .base import hourly, indexed, query, r, rounded


def placed(spark, sf):
    return joins.with_detectors(hourly(spark, sf), views.detectors(spark, sf), columns=("lon", "lat"))


CELLS = """cells as (select *, cast(round_even(lon * 100, 0) as integer) as cell_x, cast(round_even(lat * 100, 0) as integer) as cell_y
  from placed where lon is not null and lat is not null)"""
PLACE = "concat_ws('_', (cell_x / 100)::varchar, (cell_y / 100)::varchar) as grid_id"
PLACED_XY = f"{r('cell_x / 100')} as lon_rounded, {r('cell_y / 100')} as lat_rounded"
GRID_SQL = f"""with {CELLS} select cell_x, cell_y, {r('avg(traffic)')} as mean_traffic_index, count(detid) as detectors_in_grid,
  {PLACE}, {PLACED_XY} from cells"""


@query("grid_round", f"{GRID_SQL} group by cell_x, cell_y")
def grid_round(spark, sf):
    return rounded(grid.grid_mean(placed(spark, sf)))


@query(
    "grid_floor",
    f"""select cast(floor(lon / 0.05::double) as integer) as cell_x, cast(floor(lat / 0.05::double) as integer) as cell_y,
        {r('avg(length)')} as mean_length, count(detid) as n from detectors group by 1, 2""",
)
def grid_floor(spark, sf):
    cells = grid.grid_mean(views.detectors(spark, sf), index="length", shape=0.05, snap="floor")
    return rounded(
        cells.select(
            "cell_x", "cell_y", F.col("mean_traffic_index").alias("mean_length"), F.col("detectors_in_grid").alias("n")
        )
    )


BOX = """box as (select min(cell_x) as x0, max(cell_x) as x1, min(cell_y) as y0, max(cell_y) as y1 from cells),
  complete as (select cast(x.x as integer) as cell_x, cast(y.y as integer) as cell_y from box, range(-1000, 1000) x(x), range(4000, 6000) y(y)
    where x.x between x0 and x1 and y.y between y0 and y1)"""


@query("complete_grid", f"with {CELLS}, {BOX} select cell_x, cell_y, {PLACE}, {PLACED_XY} from complete")
def complete_grid(spark, sf):
    return rounded(grid.with_coordinates(grid.complete_grid(placed(spark, sf))))


@query("cross_grid", f"with {CELLS}, {BOX} select cell_x, cell_y from complete")
def cross_grid(spark, sf):
    return grid.complete_grid(placed(spark, sf))


def fill_sql(start: str, rounds: int = 3, default: float = 5.5) -> str:
    """CTEs f0..fN: each round reads the one before."""
    parts = [f"f0 as ({start})"]
    for i in range(rounds):
        parts.append(
            f"""f{i + 1} as (select f.cell_x, f.cell_y, coalesce(f.v, o.v) as v, f.n from f{i} f left join (
              select f.cell_x + dx.dx as cell_x, f.cell_y + dy.dy as cell_y, avg(f.v) as v from f{i} f,
                (values (-1), (0), (1)) dx(dx), (values (-1), (0), (1)) dy(dy)
              where f.v is not null and (dx.dx <> 0 or dy.dy <> 0) group by 1, 2) o using (cell_x, cell_y))"""
        )
    parts.append(
        f"""filled as (select cell_x, cell_y, coalesce(v, {default}) as mean_traffic_index, n as detectors_in_grid from f{rounds})"""
    )
    return ", ".join(parts)


def hour_fill_sql(hour: int) -> str:
    return f"""with {CELLS}, {BOX}, {fill_sql(f'''select c.cell_x, c.cell_y, o.v, o.n from complete c left join (
      select cell_x, cell_y, avg(traffic) as v, count(detid) as n from cells where interval_s = {hour} group by 1, 2) o
      using (cell_x, cell_y)''')}
      select cell_x, cell_y, {r('mean_traffic_index')} as mean_traffic_index, detectors_in_grid, {PLACE}, {PLACED_XY} from filled"""


@query("hour_grid", f"{GRID_SQL} where interval_s = 28800 group by cell_x, cell_y")
def hour_grid(spark, sf):
    return rounded(grid.hour_grid(placed(spark, sf), 28800))


@query("advanced_grid", hour_fill_sql(28800))
def advanced_grid(spark, sf):
    return rounded(grid.hour_grid(placed(spark, sf), 28800, "traffic_complete"))


# The older snap: down to multiples of the cell size.
FLOOR = 0.02
FLOOR_CELLS = f"""cells as (select *, cast(floor(lon / {FLOOR}::double) as integer) as cell_x, cast(floor(lat / {FLOOR}::double) as integer) as cell_y
  from placed where lon is not null and lat is not null),
  ends as (select min(cell_x) as x0, max(cell_x) as x1, min(cell_y) as y0, max(cell_y) as y1 from cells),
  columns_ as (select unnest(range(x0, x1 + 1))::integer as cell_x, y0, y1 from ends),
  complete as (select cell_x, unnest(range(y0, y1 + 1))::integer as cell_y from columns_)"""
FLOOR_XY = f"{r(f'cell_x * {FLOOR}')} as lon_rounded, {r(f'cell_y * {FLOOR}')} as lat_rounded"


@query("complete_grid_floor", f"with {FLOOR_CELLS} select cell_x, cell_y, {FLOOR_XY} from complete")
def complete_grid_floor(spark, sf):
    cells = grid.complete_grid(placed(spark, sf), FLOOR, snap="floor")
    return rounded(grid.with_coordinates(cells, FLOOR, "floor").drop("grid_id"))


@query(
    "advanced_grid_floor",
    f"""with {FLOOR_CELLS}, {fill_sql('''select c.cell_x, c.cell_y, o.v, o.n from complete c left join (
      select cell_x, cell_y, avg(traffic) as v, count(detid) as n from cells where interval_s = 28800 group by 1, 2) o
      using (cell_x, cell_y)''')}
      select cell_x, cell_y, {r('mean_traffic_index')} as mean_traffic_index, detectors_in_grid, {FLOOR_XY} from filled""",
)
def advanced_grid_floor(spark, sf):
    return rounded(grid.hour_grid(placed(spark, sf), 28800, "traffic_complete", FLOOR, "floor").drop("grid_id"))


@query("join_grid_fill", f"""with {CELLS}, {BOX} select c.cell_x, c.cell_y, {r('o.v')} as mean_traffic_index, o.n as detectors_in_grid
    from complete c left join (select cell_x, cell_y, avg(traffic) as v, count(detid) as n from cells group by 1, 2) o using (cell_x, cell_y)""")
def join_grid_fill(spark, sf):
    rows = placed(spark, sf)
    seen = grid.grid_mean(rows).select(*grid.CELL, "mean_traffic_index", "detectors_in_grid")
    return rounded(grid.complete_grid(rows).join(seen, list(grid.CELL), "left"))


# Only the busiest readings are observed, which leaves holes that need several rounds and the default.
SPARSE = f"""with {CELLS}, {BOX}, {fill_sql('''select c.cell_x, c.cell_y, o.v, o.n from complete c left join (
      select cell_x, cell_y, avg(traffic) as v, count(detid) as n from cells where traffic >= 170 group by 1, 2) o
      using (cell_x, cell_y)''')}
      select cell_x, cell_y, {r('mean_traffic_index')} as mean_traffic_index, detectors_in_grid from filled"""


@query("fill_neighbours", SPARSE)
def fill_neighbours(spark, sf):
    rows = placed(spark, sf)
    seen = grid.grid_mean(rows.where("traffic >= 170"))
    cells = grid.complete_grid(rows).join(
        seen.select(*grid.CELL, "mean_traffic_index", "detectors_in_grid"), list(grid.CELL), "left"
    )
    return rounded(grid.fill_neighbours(cells))


@query(
    "band_neighbours",
    f"""with {CELLS}, seen as (select cell_x, cell_y, avg(traffic) as v from cells group by 1, 2)
        select a.cell_x, a.cell_y, {r('avg(b.v)')} as neighbour_mean from seen a join seen b
        on b.cell_x between a.cell_x - 2 and a.cell_x + 2 and b.cell_y between a.cell_y - 2 and a.cell_y + 2
        and (a.cell_x <> b.cell_x or a.cell_y <> b.cell_y) group by 1, 2""",
)
def band_neighbours(spark, sf):
    cells = grid.grid_mean(placed(spark, sf))
    return rounded(cells.select(*grid.CELL).join(grid.neighbour_means(cells, radius=2), list(grid.CELL)))


@query("grid_cube", f"""with {CELLS} select weekday, interval_s, cell_x, cell_y, {r('avg(traffic)')} as mean_traffic_index,
    count(detid) as detectors_in_grid, {PLACE}, {PLACED_XY} from cells group by weekday, interval_s, cell_x, cell_y""")
def grid_cube(spark, sf):
    return rounded(grid.grid_cube(placed(spark, sf)))


CUBE_FILL = f"""with {CELLS}, {BOX}, keyed as (select distinct weekday, interval_s from cells),
  g0 as (select k.weekday, k.interval_s, c.cell_x, c.cell_y, o.v from keyed k, complete c left join (
     select weekday, interval_s, cell_x, cell_y, avg(traffic) as v from cells group by 1, 2, 3, 4) o
     on o.weekday = k.weekday and o.interval_s = k.interval_s and o.cell_x = c.cell_x and o.cell_y = c.cell_y)"""
for _i in range(3):
    CUBE_FILL += f""", g{_i + 1} as (select f.weekday, f.interval_s, f.cell_x, f.cell_y, coalesce(f.v, o.v) as v from g{_i} f left join (
       select f.weekday, f.interval_s, f.cell_x + dx.dx as cell_x, f.cell_y + dy.dy as cell_y, avg(f.v) as v from g{_i} f,
         (values (-1), (0), (1)) dx(dx), (values (-1), (0), (1)) dy(dy)
       where f.v is not null and (dx.dx <> 0 or dy.dy <> 0) group by 1, 2, 3, 4) o using (weekday, interval_s, cell_x, cell_y))"""


@query("grid_cube_complete", CUBE_FILL + f" select weekday, interval_s, cell_x, cell_y, {r('coalesce(v, 5.5)')} as mean_traffic_index from g3")
def grid_cube_complete(spark, sf):
    keys = ("weekday", "interval_s")
    rows = placed(spark, sf)
    full = grid.advanced_grid(grid.grid_cube(rows), grid.complete_grid(rows, keys=keys), keys)
    return rounded(full.select(*keys, *grid.CELL, "mean_traffic_index"))


def _corner_sql(shape: str) -> str:
    offsets = {
        "rectangle": [(-1, -1), (-1, 1), (1, 1), (1, -1)],
        "triangle": [(1, 0), (-0.5, -1), (-0.5, 1)],
    }.get(shape)
    if shape == "octagon":
        places = "(select i, cos(i * pi() / 4) as a, sin(i * pi() / 4) as b from range(8) t(i))"
    else:
        places = "(values " + ", ".join(f"({i}, {a}::double, {b}::double)" for i, (a, b) in enumerate(offsets)) + ") t(i, a, b)"
    return f"""select '{shape}' as shape, cell_x, cell_y, cast(i as integer) as corner,
      {r('cell_y / 100 + a * 0.005')} as lat, {r('cell_x / 100 + b * 0.005')} as lon from (select distinct cell_x, cell_y from cells), {places}"""


@query("cell_polygon", f"with {CELLS} " + " union all ".join(_corner_sql(s) for s in ("rectangle", "triangle", "octagon")))
def cell_polygon(spark, sf):
    cells = grid.grid_mean(placed(spark, sf))
    parts = None
    for shape in ("rectangle", "triangle", "octagon"):
        corners = cells.select(
            F.lit(shape).alias("shape"), *grid.CELL,
            F.posexplode(grid.cell_polygon("lat_rounded", "lon_rounded", shape)).alias("corner", "at"),
        ).select("shape", *grid.CELL, "corner", "at.lat", "at.lon")
        parts = corners if parts is None else parts.unionByName(corners)
    return rounded(parts)


def colour_sql(value: str, low: str, high: str) -> str:
    """Green (0,128,0) to yellow (255,255,0) to red (255,0,0)."""
    place = f"(least(greatest(coalesce(({value} - {low}) / nullif({high} - {low}, 0), 0), 0), 1) * 2)"

    def channel(a, b, c):
        level = f"case when {place} <= 1 then {a}::double + {place} * {b - a} else {b}::double + ({place} - 1) * {c - b} end"
        return f"printf('%02x', cast(floor(({level}) * (255.9999::double / 255)) as integer))"

    return f"'#' || {channel(0, 255, 255)} || {channel(128, 255, 0)} || {channel(0, 0, 0)}"


@query(
    "colour_scale",
    f"""with {CELLS}, means as (select cell_x, cell_y, floor(avg(traffic) + 0.501) as v from cells group by 1, 2)
        select cell_x, cell_y, {colour_sql('v', '0::double', '99::double')} as fixed_colour,
        {colour_sql('v', 'lo', 'hi')} as range_colour from means, (select min(v) as lo, max(v) as hi from means)""",
)
def colour_scale(spark, sf):
    cells = grid.grid_mean(placed(spark, sf)).withColumn(
        "v", F.floor(F.col("mean_traffic_index") + F.lit(0.501)).cast("double")
    )
    ends = cells.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    ranged = grid.colour("v", F.col("_ends.lo"), F.col("_ends.hi"))
    return cells.withColumn("_ends", ends).select(
        *grid.CELL, grid.colour("v").alias("fixed_colour"), ranged.alias("range_colour")
    )


@query(
    "cell_popup",
    f"""with {CELLS}, g as (select cell_x, cell_y, cast(floor(avg(traffic)) as bigint) as v, count(detid) as n, {PLACE} from cells group by 1, 2)
        select cell_x, cell_y, 'Grid ID: ' || grid_id || '<br>Mean Traffic Index: ' || v || '<br>Detectors in Grid: ' || n as popup from g""",
)
def cell_popup(spark, sf):
    cells = grid.grid_mean(placed(spark, sf)).withColumn("mean_traffic_index", F.floor("mean_traffic_index"))
    return cells.select(*grid.CELL, grid.popup().alias("popup"))


ODD_SQL = "select detid from indexed group by 1 having avg(traffic) > 60"


@query(
    "detector_points",
    f"""with firsts as (select x.detid, d.lon, d.lat, x.detid in ({ODD_SQL}) as odd from (
          select distinct detid from indexed) x join detectors d using (detid))
        select detid, {r('lon')} as lon, {r('lat')} as lat, case when odd then 'red' else 'blue' end as colour,
          'Detector ID: ' || detid as label from firsts""",
)
def detector_points(spark, sf):
    rows = joins.with_detectors(indexed(spark, sf), views.detectors(spark, sf), columns=("lon", "lat"), how="inner")
    odd = rows.groupBy("detid").agg(F.avg("traffic").alias("m")).where("m > 60").select("detid")
    points = grid.detector_points(
        joins.drop_keys(rows, odd, "detid"), joins.keep_keys(rows, odd, "detid"), outliers.READING_ORDER
    )
    return rounded(points)


@query(
    "sink_geojson",
    f"""with {CELLS}, seen as (select cell_x, cell_y, avg(traffic) as m, count(detid) as n, {PLACE} from cells group by cell_x, cell_y),
        ends as (select *, least(greatest(m / 99, 0), 1) * 2 as t from seen)
        select grid_id, 'Polygon' as kind, {r('m')} as mean_traffic_index, n as detectors_in_grid,
          '#' || printf('%02x', floor((case when t <= 1 then t * 255 else 255 end) * 255.9999 / 255)::integer)
          || printf('%02x', floor((case when t <= 1 then 128 + t * 127 else 255 - (t - 1) * 255 end) * 255.9999 / 255)::integer) || '00' as colour,
          [{', '.join(f"[{r(f'cell_x / 100 + {x}')}, {r(f'cell_y / 100 + {y}')}]" for x, y in ((-0.005, -0.005), (0.005, -0.005), (0.005, 0.005), (-0.005, 0.005), (-0.005, -0.005)))}]::varchar as ring
        from ends""",
)
def sink_geojson(spark, sf):
    """Every feature's text, parsed back: ring, colour and counts."""
    text = grid.geojson_cells(grid.grid_mean(placed(spark, sf)))
    schema = (
        "geometry struct<type: string, coordinates: array<array<array<double>>>>, "
        "properties struct<grid_id: string, mean_traffic_index: double, detectors_in_grid: bigint, colour: string>"
    )
    lines = text.select(F.from_json("value", schema).alias("f"))
    size = F.lit(1e6)
    ring = F.transform(F.col("f.geometry.coordinates")[0], lambda p: F.transform(p, lambda v: F.floor(v * size + F.lit(0.501)) / size))
    flat = F.concat(F.lit("["), F.array_join(F.transform(ring, lambda p: F.concat(F.lit("["), F.array_join(p.cast("array<string>"), ", "), F.lit("]"))), ", "), F.lit("]"))
    return rounded(lines.select("f.properties.*", F.col("f.geometry.type").alias("kind"), flat.alias("ring")))


@query(
    "rows_without_place",
    "select count(*) filter (where d.lon is null or d.lat is null) as n_rows from (select concat('D/', l_partkey::varchar) as detid from lineitem) l left join detectors d using (detid)",
)
def rows_without_place(spark, sf):
    parts = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.concat(F.lit("D/"), F.col("l_partkey").cast("string")).alias("detid")
    )
    return grid.rows_without_place(joins.with_detectors(parts, views.detectors(spark, sf), columns=("lon", "lat")))


@query(
    "flagship",
    f"with {CELLS} select {PLACE}, {r('avg(traffic)')} as mean_traffic_index, count(detid) as detectors_in_grid, {PLACED_XY} from cells group by cell_x, cell_y",
)
def flagship(spark, sf):
    return rounded(dataset.flagship(views.readings(spark, sf), views.detectors(spark, sf), digits=None))
