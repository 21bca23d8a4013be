"""Spatial grid: cell means, complete grids, neighbour filling, shapes and colours.

Cells are integer pairs (``cell_x``, ``cell_y``), so neighbours and joins never depend on
rounded floating point coordinates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import col
from ..functions.numbers import decimals_of
from . import keyed
from .joins import first_per_key

CELL = ("cell_x", "cell_y")
# Green, yellow and red of the colour scale.
SCALE_STOPS = ((0, 128, 0), (255, 255, 0), (255, 0, 0))


def _step(shape: float, snap: str) -> Decimal:
    if snap == "round":
        return Decimal(1).scaleb(-decimals_of(shape))
    if snap == "floor":
        return Decimal(str(shape))
    raise ValueError(f"unknown snap {snap!r}: round or floor")


def with_cells(df: DataFrame, shape: float = 0.01, snap: str = "round", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds the cell of each row. ``round`` keeps the decimals of ``shape``, ``floor`` snaps down to its multiples."""
    _step(shape, snap)

    def number(c: str) -> Column:
        if snap == "round":
            return F.rint(F.col(c) * F.lit(float(10 ** decimals_of(shape)))).cast("int")
        return F.floor(F.col(c) / F.lit(float(shape))).cast("int")

    return df.withColumn("cell_x", number(lon)).withColumn("cell_y", number(lat))


def with_coordinates(df: DataFrame, shape: float = 0.01, snap: str = "round") -> DataFrame:
    """Adds ``lon_rounded``, ``lat_rounded`` and the text id ``lon_lat`` of each cell."""
    step = F.lit(_step(shape, snap))

    def place(c: str) -> Column:
        return F.col(c).cast("decimal(12,0)") * step

    def text(c: str) -> Column:
        return F.regexp_replace(place(c).cast("string"), r"(\.\d+?)0+$", "$1")

    return (
        df.withColumn("grid_id", F.concat_ws("_", text("cell_x"), text("cell_y")))
        .withColumn("lon_rounded", place("cell_x").cast("double"))
        .withColumn("lat_rounded", place("cell_y").cast("double"))
    )


def grid_mean(
    df: DataFrame,
    index: str = "traffic",
    key: str = "detid",
    keys: Sequence[str] = (),
    shape: float = 0.01,
    snap: str = "round",
) -> DataFrame:
    """Mean index and number of sensor rows per cell (and per extra key). Rows without coordinates are left out."""
    placed = with_cells(df, shape, snap).where(F.col("cell_x").isNotNull() & F.col("cell_y").isNotNull())
    means = placed.groupBy(*keys, *CELL).agg(
        F.avg(index).alias("mean_traffic_index"), F.count(key).alias("detectors_in_grid")
    )
    return with_coordinates(means, shape, snap)


def rows_without_place(df: DataFrame) -> DataFrame:
    """How many rows the grid leaves out for want of coordinates."""
    return df.agg(F.count_if(F.col("lon").isNull() | F.col("lat").isNull()).alias("n_rows"))


def complete_grid(df: DataFrame, shape: float = 0.01, keys: Sequence[str] = (), snap: str = "round") -> DataFrame:
    """Every cell of the bounding box of all rows, repeated for each distinct ``keys`` value.

    The box is cut into strips of columns, which are dealt out to all cores before they are expanded to cells.
    """
    placed = with_cells(df, shape, snap)
    extent = placed.agg(
        F.min("cell_x").alias("x0"), F.max("cell_x").alias("x1"), F.min("cell_y").alias("y0"), F.max("cell_y").alias("y1")
    )
    if keys:
        ends = extent.select(F.struct("*")).scalar()
        box = df.select(*keys).distinct().withColumn("_e", ends).select(*keys, "_e.*")
    else:
        box = extent
    strips = 4 * max(df.sparkSession.sparkContext.defaultParallelism, 1)
    width = F.greatest(F.ceil((F.col("x1") - F.col("x0") + 1) / F.lit(strips)).cast("int"), F.lit(1))
    start = F.explode(F.sequence(F.col("x0"), F.col("x1"), width)).alias("_from")
    box = box.where(F.col("x0").isNotNull() & F.col("y0").isNotNull())
    dealt = keyed.spread(box.select(*keys, start, width.alias("_width"), "x1", "y0", "y1"))
    columns = F.explode(F.sequence("_from", F.least(F.col("_from") + F.col("_width") - 1, F.col("x1")))).alias("cell_x")
    return dealt.select(*keys, columns, "y0", "y1").select(*keys, "cell_x", F.explode(F.sequence("y0", "y1")).alias("cell_y"))


def neighbour_means(grid: DataFrame, keys: Sequence[str] = (), value: str = "mean_traffic_index", radius: int = 1) -> DataFrame:
    """Mean of the known cells at most ``radius`` away (column ``neighbour_mean``), for every place that has one.

    The cell itself does not count, and places outside the grid appear too. Known cells offer
    their value to the places around them: one aggregation, no band join.
    """
    steps = F.array(
        *[
            F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
            for dx in range(-radius, radius + 1)
            for dy in range(-radius, radius + 1)
            if (dx, dy) != (0, 0)
        ]
    )
    known = grid.where(F.col(value).isNotNull()).select(*keys, *CELL, F.col(value).alias("_v"), F.explode(steps).alias("_s"))
    x, y = F.col("cell_x") + F.col("_s.dx"), F.col("cell_y") + F.col("_s.dy")
    return known.groupBy(*keys, x.alias("cell_x"), y.alias("cell_y")).agg(F.avg("_v").alias("neighbour_mean"))


def fill_neighbours(
    grid: DataFrame,
    keys: Sequence[str] = (),
    value: str = "mean_traffic_index",
    radius: int = 1,
    rounds: int = 3,
    default: float = 5.5,
) -> DataFrame:
    """Fills empty cells with the mean of the cells at most ``radius`` away, up to ``rounds`` times, then ``default``.

    Every round uses the values of the round before; rounds stop when nothing is empty.
    """
    spot = [*keys, *CELL]
    filled = keyed.settle(grid)
    for i in range(rounds):
        if filled.where(F.col(value).isNull()).isEmpty():
            break
        offers = neighbour_means(filled, keys, value, radius)
        filled = filled.join(offers, spot, "left").withColumn(value, F.coalesce(value, "neighbour_mean")).drop("neighbour_mean")
        if i + 1 < rounds:
            filled = keyed.settle(filled)
    return filled.withColumn(value, F.coalesce(F.col(value), F.lit(float(default))))


def advanced_grid(
    observed: DataFrame, complete: DataFrame, keys: Sequence[str] = (), shape: float = 0.01, snap: str = "round", **fill
) -> DataFrame:
    """The complete grid with observed means where they exist and filled ones elsewhere."""
    spot = [*keys, *CELL]
    seen = observed.select(*spot, "mean_traffic_index", "detectors_in_grid")
    return with_coordinates(fill_neighbours(complete.join(seen, spot, "left"), keys, **fill), shape, snap)


def hour_grid(
    df: DataFrame, interval: int, mode: str = "traffic", shape: float = 0.01, snap: str = "round", **fill
) -> DataFrame:
    """Grid of one interval; ``traffic_complete`` fills the bounding box of all intervals."""
    observed = grid_mean(df.where(F.col("interval_s") == interval), shape=shape, snap=snap)
    if mode == "traffic":
        return observed
    if mode != "traffic_complete":
        raise ValueError(f"unknown mode {mode!r}: traffic or traffic_complete")
    return advanced_grid(observed, complete_grid(df, shape, snap=snap), shape=shape, snap=snap, **fill)


def grid_cube(df: DataFrame, keys: Sequence[str] = ("weekday", "interval_s"), shape: float = 0.01) -> DataFrame:
    """Grids of all weekdays and intervals in one aggregation."""
    return grid_mean(df, keys=keys, shape=shape)


def cell_polygon(lat: str | Column, lon: str | Column, shape: str = "circle", size: float = 0.005) -> Column:
    """Vertices around a centre as array of (lat, lon); NULL for a circle."""
    lat, lon = col(lat), col(lon)
    offsets = {
        # Vertex offsets in units of ``size``, in drawing order.
        "rectangle": [(-1, -1), (-1, 1), (1, 1), (1, -1)],
        "triangle": [(1, 0), (-0.5, -1), (-0.5, 1)],
        "octagon": [(math.cos(i * math.pi / 4), math.sin(i * math.pi / 4)) for i in range(8)],
    }.get(shape)
    if offsets is None:
        return F.lit(None).cast("array<struct<lat:double,lon:double>>")
    return F.array(
        *[
            F.struct((lat + F.lit(float(a * size))).alias("lat"), (lon + F.lit(float(b * size))).alias("lon"))
            for a, b in offsets
        ]
    )


def colour(value: str | Column, low: float | Column = 0, high: float | Column = 99) -> Column:
    """``#rrggbb`` on a linear green-yellow-red scale; values outside low..high take the end colours."""
    value = col(value)
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    share = F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0))
    place = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * 2
    a, b, c = SCALE_STOPS

    def channel(i: int) -> Column:
        first = F.lit(float(a[i])) + place * (b[i] - a[i])
        second = F.lit(float(b[i])) + (place - 1) * (c[i] - b[i])
        level = F.when(place <= 1, first).otherwise(second)
        # Fixed value: 255.9999 / 255 maps a full channel to 255 when cut to an integer.
        return F.lower(F.lpad(F.hex(F.floor(level * F.lit(255.9999 / 255)).cast("int")), 2, "0"))

    return F.when(value.isNotNull(), F.concat(F.lit("#"), channel(0), channel(1), channel(2)))


def popup() -> Column:
    """Label text of a cell."""
    return F.concat_ws(
        "<br>",
        F.concat(F.lit("Grid ID: "), F.col("grid_id")),
        F.concat(F.lit("Mean Traffic Index: "), F.col("mean_traffic_index").cast("string")),
        F.concat(F.lit("Detectors in Grid: "), F.col("detectors_in_grid").cast("string")),
    )


def detector_points(
    used: DataFrame,
    anomalous: DataFrame,
    order: Sequence[str],
    index: str | None = None,
    key: str = "detid",
) -> DataFrame:
    """One point per used sensor (blue) and per anomalous sensor (red), with a label."""

    def points(df: DataFrame, paint: str) -> DataFrame:
        first = first_per_key(df, [key], order)
        text = [F.concat(F.lit("Detector ID: "), F.col(key))]
        if index is not None and index in df.columns:
            text.append(F.concat(F.lit("Traffic Index: "), F.col(index).cast("string")))
        return first.select(key, "lon", "lat", F.lit(paint).alias("colour"), F.concat_ws("<br>", *text).alias("label"))

    return points(used, "blue").unionByName(points(anomalous, "red"))


def geojson_cells(grid: DataFrame, shape: str = "rectangle", size: float = 0.005) -> DataFrame:
    """One GeoJSON feature per cell as text column ``value``; circles are points with a radius."""
    point = F.array("lon_rounded", "lat_rounded")
    corners = cell_polygon("lat_rounded", "lon_rounded", shape, size)
    ring = F.transform(corners, lambda p: F.array(p["lon"], p["lat"]))
    closed = F.array(F.concat(ring, F.slice(ring, 1, 1)))
    if shape == "circle":
        geometry = F.struct(F.lit("Point").alias("type"), point.alias("coordinates"))
    else:
        geometry = F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates"))
    properties = F.struct(
        "grid_id", "mean_traffic_index", "detectors_in_grid",
        colour("mean_traffic_index").alias("colour"), popup().alias("popup"),
    )
    return grid.select(_feature(geometry, properties).alias("value"))


def geojson_points(points: DataFrame) -> DataFrame:
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return points.select(_feature(geometry, F.struct("detid", "colour", "label")).alias("value"))


def _feature(geometry: Column, properties: Column) -> Column:
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")))
