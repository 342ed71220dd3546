"""The region grid: fixed-size chunks of the target raster as a small dimension table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S


class Grid(NamedTuple):
    """A raster of ny by nx cells; (lat0, lon0) is the first cell's centre; chunks of cy by cx cells."""

    ny: int
    nx: int
    cy: int
    cx: int
    lat0: float
    lon0: float
    dlat: float
    dlon: float

    @property
    def shape(self) -> tuple[int, int]:
        return -(-self.ny // self.cy), -(-self.nx // self.cx)

    @property
    def transform(self) -> tuple[float, float, float, float, float, float]:
        """(a, b, c, d, e, f): lon = a * ix + b * iy + c and lat = d * ix + e * iy + f at a cell's lower corner."""
        return self.dlon, 0.0, self.lon0 - self.dlon / 2, 0.0, self.dlat, self.lat0 - self.dlat / 2

    def corner(self, ix: int, iy: int) -> tuple[float, float]:
        """(lon, lat) of a cell's lower corner."""
        return self.lon0 + (ix - 0.5) * self.dlon, self.lat0 + (iy - 0.5) * self.dlat

    def chunk_slice(self, iy: int, ix: int) -> tuple[range, range]:
        """Rows and columns of a chunk."""
        if not (0 <= iy < self.shape[0] and 0 <= ix < self.shape[1]):
            raise ValueError("Invalid chunk ID")
        return range(iy * self.cy, min((iy + 1) * self.cy, self.ny)), range(ix * self.cx, min((ix + 1) * self.cx, self.nx))


def chunk_starts(sizes: DataFrame) -> DataFrame:
    """axis, k, size with ``start``: the sum of the sizes before."""
    before = Window.partitionBy("axis").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))


def regions(spark: SparkSession, grid: Grid) -> DataFrame:
    """region_id, iy, ix, their cell ranges [start, stop) and the corners of their area."""
    rows, columns = grid.shape
    out = spark.range(rows * columns).select(F.floor(F.col("id") / columns).cast("int").alias("iy"), (F.col("id") % columns).cast("int").alias("ix"))
    out = out.select(
        S.region_id("iy", "ix").alias("region_id"), "iy", "ix",
        (F.col("iy") * grid.cy).alias("y_start"), F.least((F.col("iy") + 1) * grid.cy, F.lit(grid.ny)).alias("y_stop"),
        (F.col("ix") * grid.cx).alias("x_start"), F.least((F.col("ix") + 1) * grid.cx, F.lit(grid.nx)).alias("x_stop"),
    )
    edge = lambda c, origin, step: F.lit(origin) + (F.col(c) - F.lit(0.5)) * F.lit(step)
    return out.withColumns(
        {
            "lat_min": edge("y_start", grid.lat0, grid.dlat), "lat_max": edge("y_stop", grid.lat0, grid.dlat),
            "lon_min": edge("x_start", grid.lon0, grid.dlon), "lon_max": edge("x_stop", grid.lon0, grid.dlon),
        }
    )


def for_bbox(regions_: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Regions that a box meets; touching counts."""
    return regions_.where((F.col("lon_min") <= xmax) & (F.col("lon_max") >= xmin) & (F.col("lat_min") <= ymax) & (F.col("lat_max") >= ymin))


def valid_regions(pixels: DataFrame, grid: Grid, value: str) -> DataFrame:
    """Ids of the regions with any value at all."""
    at = [F.floor(F.col("iy") / grid.cy).cast("int").alias("iy"), F.floor(F.col("ix") / grid.cx).cast("int").alias("ix")]
    found = pixels.groupBy(*at).agg(F.count(S.missing(F.col(value).cast("double"))).alias("n"))
    return found.where("n > 0").select(S.region_id("iy", "ix").alias("region_id"))


def extent(pixels: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return pixels.agg(F.min(lon).alias("xmin"), F.min(lat).alias("ymin"), F.max(lon).alias("xmax"), F.max(lat).alias("ymax"))


def extent_albers(pixels: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The extent's lower left and upper right corners in equal-area metres: xmin, xmax, ymin, ymax."""
    low, high = (geo.to_albers_udf(F.col(x), F.col(y)) for x, y in (("xmin", "ymin"), ("xmax", "ymax")))
    corners = extent(pixels, lon, lat).select(low.alias("low"), high.alias("high"))
    return corners.select(F.col("low.x").alias("xmin"), F.col("high.x").alias("xmax"), F.col("low.y").alias("ymin"), F.col("high.y").alias("ymax"))


def template(spark: SparkSession, grid: Grid, variables: Sequence[str], region_ids: DataFrame | None = None) -> DataFrame:
    """Every cell (region_id, iy, ix, lon, lat) of the grid, or of some regions, with empty variables: what a sparse raster is filled into."""
    chosen = regions(spark, grid)
    if region_ids is not None:
        chosen = chosen.join(F.broadcast(region_ids.select("region_id").distinct()), "region_id", "left_semi")  # at most the grid's regions
    chosen = chosen.select("region_id", F.explode(F.sequence("y_start", F.col("y_stop") - 1)).alias("iy"), "x_start", "x_stop")
    chosen = chosen.select("region_id", "iy", F.explode(F.sequence("x_start", F.col("x_stop") - 1)).alias("ix"))
    place = [(F.lit(grid.lon0) + F.col("ix") * F.lit(grid.dlon)).alias("lon"), (F.lit(grid.lat0) + F.col("iy") * F.lit(grid.dlat)).alias("lat")]
    return chosen.select("region_id", "iy", "ix", *place, *[F.lit(None).cast("float").alias(v) for v in variables])


def region_status(provided: DataFrame, valid: DataFrame, processed: DataFrame) -> DataFrame:
    """region_id with a flag for each kind: provided, valid, invalid, processed, unprocessed_valid."""
    tagged = [df.select("region_id").distinct().withColumn(name, F.lit(True)) for name, df in (("p", provided), ("v", valid), ("d", processed))]
    joined = tagged[0].join(tagged[1], "region_id", "left").join(tagged[2], "region_id", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return joined.select(
        "region_id", flag("v").alias("valid"), (~flag("v")).alias("invalid"), flag("d").alias("previously_processed"), (flag("v") & ~flag("d")).alias("unprocessed_valid")
    )


def select_regions(status: DataFrame, allow_all_processed: bool = False) -> list[str]:
    """Ids to process now, sorted; an error names what is invalid or done if nothing is left."""
    rows = status.collect()  # one row a region: at most the grid's few hundred
    todo = sorted(r["region_id"] for r in rows if r["unprocessed_valid"])
    if not todo and not allow_all_processed:
        invalid = sorted(r["region_id"] for r in rows if r["invalid"])
        done = sorted(r["region_id"] for r in rows if r["previously_processed"])
        raise ValueError(f"no region to process; invalid: {invalid}; already processed: {done}")
    return todo


def monotonic(coordinates: DataFrame, axis: str, order: str) -> DataFrame:
    """One row: do the coordinates ascend strictly?"""
    step = F.lead(axis).over(Window.orderBy(order)) - F.col(axis)
    return coordinates.select(step.alias("step")).agg(F.coalesce(F.bool_and(F.col("step") > 0), F.lit(True)).alias("ascending"))


def select_box(pixels: DataFrame, bbox: Sequence[float] | None = None, point: tuple[float, float] | None = None, tolerance: float | None = None) -> DataFrame:
    """Pixels (lon, lat) in a box, or the one nearest to a point, which keeps the point it was asked for."""
    if (bbox is None) == (point is None):
        raise ValueError("give either a box or a point")
    if bbox is not None:
        xmin, ymin, xmax, ymax = bbox
        return pixels.where(F.col("lon").between(xmin, xmax) & F.col("lat").between(ymin, ymax))
    x, y = point
    far = F.greatest(F.abs(F.col("lon") - x), F.abs(F.col("lat") - y))
    near = pixels if tolerance is None else pixels.where(far <= tolerance)
    first = near.orderBy(F.abs(F.col("lat") - y), F.abs(F.col("lon") - x), "lat", "lon").limit(1)
    return first.withColumns({"requested_lon": F.lit(x), "requested_lat": F.lit(y)})
