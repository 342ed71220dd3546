"""The whole computation: regions to buildings, buildings to partitions and statistics, and the files made of them."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S
from cinderspark.operators import grid, joins, raster, regional
from cinderspark.sources import sinks

#: The surfaces sampled at each building.
VARIABLES = ("rps_scott", "rps_2011", "rps_2047", "bp_2011", "bp_2047", "crps_scott", "bp_2011_riley", "bp_2047_riley")
LEVELS = (("state", 2), ("county", 5), ("tract", 11), ("block", 15))


@dataclass(frozen=True)
class Settings:
    """Where inputs and outputs are, and the grid's size; each can come from the environment."""

    pixels: str = ""
    distribution: str = ""
    buildings: str = ""
    output: str = "output"
    cell_degrees: float = 0.00027
    lat0: float = 24.0
    lon0: float = -125.0
    ny: int = 0
    nx: int = 0
    chunk: int = 6000
    tile: int = 512
    window: int = 81
    #: Areas by level (level, GEOID, NAME, STUSPS, geometry); without them codes alone are grouped by.
    polygons: str = ""
    #: Degrees of a cell of the join of places with areas.
    join_degrees: float = 0.25

    @classmethod
    def from_environment(cls, prefix: str = "CINDERSPARK_") -> Settings:
        found = {}
        for f in fields(cls):
            raw = os.environ.get(prefix + f.name.upper())
            if raw is not None:
                found[f.name] = type(f.default)(raw)
        return cls(**found)

    def grid(self) -> grid.Grid:
        return grid.Grid(self.ny, self.nx, self.chunk, self.chunk, self.lat0, self.lon0, self.cell_degrees, self.cell_degrees)

    def path(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"


def adjusted_risk(pixels: DataFrame, distribution: DataFrame, settings: Settings) -> DataFrame:
    """iy, ix and the eight variables: wind-informed burn probabilities times conditional risk.

    ``pixels`` has iy, ix, bp_2011_riley, bp_2047_riley, rps_scott and crps_scott.
    """
    s = settings
    out = pixels.select("iy", "ix", *[F.col(c).cast("float").alias(c) for c in ("bp_2011_riley", "bp_2047_riley", "rps_scott", "crps_scott")])
    for year in ("2011", "2047"):
        bp = raster.wind_informed_burn_probability(pixels, f"bp_{year}_riley", distribution, s.ny, s.nx, s.lat0, s.lon0, s.cell_degrees, s.cell_degrees, s.window, s.tile)
        out = out.join(bp.withColumnRenamed("bp", f"bp_{year}"), ["iy", "ix"])
    out = out.withColumns({f"rps_{year}": F.col(f"bp_{year}") * F.col("crps_scott") for year in ("2011", "2047")})
    return out.select("iy", "ix", *VARIABLES)


def near_regions(settings: Settings, regions: Sequence[str], margin: int) -> Column:
    """True for pixels in the regions or at most ``margin`` away: few boxes, which reach the scan as pushed filters."""
    s, rows = settings, {}
    for iy, ix in (map(int, r[1:].split("_x")) for r in regions):
        rows.setdefault(iy, set()).add(ix)
    # Neighbouring regions of a row are one box, and equal rows one above the other too.
    boxes: list[list[int]] = []
    for iy in sorted(rows):
        for ix in sorted(rows[iy]):
            if boxes and boxes[-1][:2] == [iy, iy] and boxes[-1][3] == ix - 1:
                boxes[-1][3] = ix
            else:
                boxes.append([iy, iy, ix, ix])
    merged: list[list[int]] = []
    for y0, y1, x0, x1 in boxes:
        above = next((b for b in merged if b[1] == y0 - 1 and b[2:] == [x0, x1]), None)
        if above:
            above[1] = y1
        else:
            merged.append([y0, y1, x0, x1])
    inside = F.lit(False)
    for y0, y1, x0, x1 in merged:
        inside = inside | (F.col("iy").between(y0 * s.chunk - margin, (y1 + 1) * s.chunk - 1 + margin) & F.col("ix").between(x0 * s.chunk - margin, (x1 + 1) * s.chunk - 1 + margin))
    return inside


def region_of(settings: Settings) -> Column:
    return S.region_id(F.floor(F.col("iy") / settings.chunk), F.floor(F.col("ix") / settings.chunk))


def buildings_at_risk(buildings: DataFrame, surface: DataFrame, settings: Settings) -> DataFrame:
    """Buildings (GEOID, lon, lat, ...) with their pixel's variables; those with a gap in any are left out."""
    s = settings
    sampled = joins.sample_nearest(buildings, surface, "lon", "lat", s.lon0, s.lat0, s.cell_degrees, s.cell_degrees, s.nx, s.ny)
    return sampled.withColumn("region_id", region_of(s)).na.drop("any", subset=list(VARIABLES)).drop("iy", "ix")


def process_regions(spark: SparkSession, settings: Settings, regions: Sequence[str] | None = None, overwrite: bool = False) -> list[str]:
    """Writes the buildings of the regions asked for (all by default) that are valid and not done yet.

    Only the pixels of these regions, and those near enough to matter to them, are read.
    """
    s = settings
    pixels = spark.read.parquet(s.pixels)
    every = grid.regions(spark, s.grid()).select("region_id")
    provided = spark.createDataFrame([(r,) for r in regions], "region_id string") if regions else every
    done = spark.createDataFrame([], "region_id string") if overwrite else sinks.processed(spark, s.path("ledger"))
    todo = grid.select_regions(grid.region_status(provided, grid.valid_regions(pixels, s.grid(), "bp_2011_riley"), done), allow_all_processed=True)
    if not todo:
        return todo
    near = near_regions(s, todo, raster.reach(s.cell_degrees, s.window))
    surface = adjusted_risk(pixels.where(near), spark.read.parquet(s.distribution).where(near), s).where(region_of(s).isin(todo))
    homes = spark.read.parquet(s.buildings)
    at = {"iy": S.nearest_index("lat", s.lat0, s.cell_degrees, s.ny), "ix": S.nearest_index("lon", s.lon0, s.cell_degrees, s.nx)}
    homes = homes.withColumns(at).where(region_of(s).isin(todo)).drop("iy", "ix")
    sinks.write_partitioned(buildings_at_risk(homes, surface, s), s.path("regions"), ["region_id"])
    sinks.record(spark, s.path("ledger"), todo)
    return todo


def partition_buildings(spark: SparkSession, settings: Settings) -> None:
    """All regions' buildings by state and county."""
    found = regional.partition_keys(spark.read.parquet(settings.path("regions")))
    sinks.write_partitioned(found, settings.path("buildings"), ["state_fips", "county_fips"])


def aggregate(spark: SparkSession, settings: Settings) -> None:
    """Statistics of all levels, by level: of the areas that hold the buildings, or of the buildings' codes if no areas are given."""
    s, found = settings, spark.read.parquet(settings.path("regions"))
    values, histograms = [v for v in VARIABLES if v != "rps_scott"], ("rps_2011", "rps_2047")
    if not s.polygons:
        levels = [(name, F.substring("GEOID", 1, n)) for name, n in LEVELS]
        sinks.write_partitioned(regional.nested_statistics(found, levels, values, histograms), s.path("statistics"), ["level"])
        return
    areas = spark.read.parquet(s.polygons)
    for level in ("nation", *(name for name, _ in LEVELS)):
        of = areas.where(F.col("level") == level)
        stats = regional.polygon_statistics(found, of, "lon", "lat", s.join_degrees, values, histograms, large=level in ("nation", "state", "county"))
        sinks.write_partitioned(stats, s.path("statistics"), ["level"])


def write_analysis(spark: SparkSession, settings: Settings, folder: str, levels: Sequence[str] = ("nation", "state", "county"), license: str = "") -> None:
    """Statistics as CSV (places as their shapes' centres) and GeoJSON (with the shapes) for the levels with few rows."""
    os.makedirs(folder, exist_ok=True)
    stats = spark.read.parquet(settings.path("statistics"))
    for level in levels:
        rows = stats.where(F.col("level") == level).drop("level").orderBy("GEOID")
        about = {"license": license, "level": level}
        if "geometry" in rows.columns:
            rows = rows.withColumn("_c", geo.centroid_udf("geometry")).withColumns({"longitude": F.col("_c.x"), "latitude": F.col("_c.y")}).drop("_c")
        else:
            rows = rows.withColumn("geometry", F.lit(None).cast("binary"))
        sinks.write_csv(rows, f"{folder}/{level}.csv", about, drop=("geometry",))
        sinks.write_geojson(rows.drop("longitude", "latitude"), f"{folder}/{level}.geojson", about)


def write_tiles_input(spark: SparkSession, settings: Settings) -> None:
    """Newline-delimited features of the buildings at risk in both periods, for a tile maker."""
    found = spark.read.parquet(settings.path("regions")).where("rps_2011 > 0 and rps_2047 > 0")
    short = [F.round(F.col(c).cast("double"), 3).alias(str(k)) for k, c in enumerate(("rps_2011", "rps_2047"))]
    sinks.write_ndjson(found.select(*short, geo.point_wkb(F.col("lon"), F.col("lat")).alias("geometry")), settings.path("features"))


def write_pyramid(spark: SparkSession, settings: Settings, levels: int = 6) -> None:
    """Both risk surfaces averaged two by two, level by level."""
    surface = adjusted_risk(spark.read.parquet(settings.pixels), spark.read.parquet(settings.distribution), settings)
    sinks.write_partitioned(raster.pyramid(surface, ["rps_2011", "rps_2047"], levels), settings.path("pyramid"), ["level"])


def run_all(spark: SparkSession, settings: Settings, folder: str, pyramid: bool = False) -> list[str]:
    """Every step in order; the regions that were processed now."""
    done = process_regions(spark, settings)
    if pyramid:
        write_pyramid(spark, settings)
    partition_buildings(spark, settings)
    aggregate(spark, settings)
    write_analysis(spark, settings, folder)
    write_tiles_input(spark, settings)
    return done
