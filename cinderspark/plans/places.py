"""Queries that join by place, and those on the region grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S
from cinderspark.operators import grid, joins
from cinderspark.plans import raster as R
from cinderspark.plans import tables as T
from cinderspark.sources import files, sinks
from cinderspark.sources.catalog import Catalog, Dataset

_B = T.with_sql(b=T.BUILDINGS)
GRID = grid.Grid(ny=400, nx=580, cy=60, cx=45, lat0=24.0, lon0=-125.0, dlat=0.1, dlon=0.1)


def box_join(spark, d):
    met = joins.points_in_boxes(T.buildings(spark, d).select("lon", "lat", "rps_2011"), T.areas(spark, d), "lon", "lat", 1.5)
    return met.groupBy("area_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rps_2011"), 6).alias("mean"))


BOX_SQL = T.with_sql(b=T.BUILDINGS, c=T.AREAS) + """ SELECT area_id, count(*) AS n, round(avg(rps_2011), 6) AS mean
FROM b JOIN c ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax GROUP BY area_id"""


def overlap_join(spark, d):
    met = joins.overlapping_boxes(R.order_boxes(spark, d), T.areas(spark, d), 1.0, "o", "c")
    return met.groupBy("c_area_id").agg(F.count(F.lit(1)).alias("n"), F.min("o_box_id").alias("first"))


OVERLAP_SQL = T.with_sql(o=R.BOXES, c=T.AREAS) + """ SELECT area_id AS c_area_id, count(*) AS n, min(box_id) AS first FROM o JOIN c
ON o.xmin <= c.xmax AND o.xmax >= c.xmin AND o.ymin <= c.ymax AND o.ymax >= c.ymin GROUP BY area_id"""


def polygon_join(spark, d):
    """Points moved off the edges in triangles; equal triangles are one until their points are counted."""
    points = T.buildings(spark, d).select((F.col("lon") + 0.031).alias("lon"), (F.col("lat") + 0.017).alias("lat"), "rps_2011")
    shapes, members = joins.shape_classes(T.triangles(spark, d), "area_id", "geometry")
    met = joins.spatial_join(points, shapes, "lon", "lat", "_shape", 1.5)
    found = met.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rps_2011"), 6).alias("mean"))
    return members.join(found, "_class").select("area_id", "n", "mean")


POLYGON_SQL = T.with_sql(b=T.BUILDINGS, c=T.AREAS, q="SELECT lon + 0.031::DOUBLE AS x, lat + 0.017::DOUBLE AS y, rps_2011 FROM b") + """
SELECT area_id, count(*) AS n, round(avg(rps_2011), 6) AS mean FROM q JOIN c ON x >= xmin AND y >= ymin AND (xmax - xmin) * (y - ymin) + (ymax - ymin) * (x - xmin) <= (xmax - xmin) * (ymax - ymin)
GROUP BY area_id"""


def centroids(spark, d):
    p = T.triangles(spark, d).withColumn("c", geo.centroid_udf("geometry")).withColumn("box", geo.bbox_udf("geometry"))
    return p.select("area_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), F.round(geo.area_udf("geometry"), 6).alias("area"), F.round("box.xmax", 6).alias("xmax"), F.round("box.ymin", 6).alias("ymin"))


CENTROIDS_SQL = T.with_sql(c=T.AREAS) + """ SELECT area_id, round((2 * xmin + xmax) / 3, 6) AS x, round((2 * ymin + ymax) / 3, 6) AS y,
round((xmax - xmin) * (ymax - ymin) / 2, 6) AS area, round(xmax, 6) AS xmax, round(ymin, 6) AS ymin FROM c"""


def sample(spark, d):
    """Every building with the values of its nearest pixel; places outside the raster take its edge."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    b = T.buildings(spark, d).select("l_orderkey", "l_linenumber", (F.col("lon") / 10 - 112.5).alias("lon"), (F.col("lat") / 10 + 21.613).alias("lat"))
    return joins.sample_nearest(b, p.select("iy", "ix", "v", "w"), "lon", "lat", T.LON0, T.LAT0, T.STEP, T.STEP, nx, ny).select("l_orderkey", "l_linenumber", "iy", "ix", "v", "w")


SAMPLE_SQL = T.with_sql(b=T.BUILDINGS, p=T.PIXELS, g="SELECT max(iy) + 1 AS ny, max(ix) + 1 AS nx FROM p", k=f"""SELECT l_orderkey, l_linenumber,
CAST(greatest(0, least(nx - 1, floor((lon / 10 - 112.5 - {T.LON0}::DOUBLE) / 0.1::DOUBLE + 0.5))) AS INTEGER) AS kx,
CAST(greatest(0, least(ny - 1, floor((lat / 10 + 21.613::DOUBLE - {T.LAT0}::DOUBLE) / 0.1::DOUBLE + 0.5))) AS INTEGER) AS ky FROM b, g""") + """
SELECT l_orderkey, l_linenumber, iy, ix, v, w FROM k JOIN p ON iy = ky AND ix = kx"""


def align(spark, d):
    p = T.pixels(spark, d)
    joined = joins.exact_align(p.select("iy", "ix", "v"), p.select("iy", "ix", "w"), ["iy", "ix"])
    return joined.select("iy", "ix", F.round(F.col("v") * F.col("w"), 9).alias("product"))


ALIGN_SQL = T.with_sql(p=T.PIXELS) + " SELECT iy, ix, round(v * w, 9) AS product FROM p"


def merge(spark, d):
    p = T.pixels(spark, d)
    merged = joins.merge_variables([p.select("iy", "ix", "v"), p.select("iy", "ix", "w"), p.select("iy", "ix", "lat")], ["iy", "ix"])
    return merged.groupBy("ix").agg(F.round(F.sum("v"), 6).alias("v"), F.round(F.max("w"), 6).alias("w"), F.round(F.max("lat"), 6).alias("lat"))


MERGE_SQL = T.with_sql(p=T.PIXELS) + " SELECT ix, round(sum(v), 6) AS v, round(max(w), 6) AS w, round(max(lat), 6) AS lat FROM p GROUP BY ix"


def regions(spark, d):
    r = grid.regions(spark, GRID)
    return r.select("region_id", "y_start", "y_stop", "x_start", "x_stop", *[F.round(c, 6).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])


_REGIONS = """SELECT 'y' || iy || '_x' || ix AS region_id, iy, ix, iy * 60 AS y_start, least((iy + 1) * 60, 400) AS y_stop, ix * 45 AS x_start, least((ix + 1) * 45, 580) AS x_stop,
24 + (iy * 60 - 0.5) * 0.1 AS lat_min, 24 + (least((iy + 1) * 60, 400) - 0.5) * 0.1 AS lat_max, -125 + (ix * 45 - 0.5) * 0.1 AS lon_min, -125 + (least((ix + 1) * 45, 580) - 0.5) * 0.1 AS lon_max
FROM (SELECT CAST(unnest(generate_series(0, 6)) AS INTEGER) AS iy) y, (SELECT CAST(unnest(generate_series(0, 12)) AS INTEGER) AS ix) x"""
REGIONS_SQL = f"""WITH r AS ({_REGIONS}) SELECT region_id, y_start, CAST(y_stop AS INTEGER) AS y_stop, x_start, CAST(x_stop AS INTEGER) AS x_stop, round(CAST(lat_min AS DOUBLE), 6) AS lat_min,
round(CAST(lat_max AS DOUBLE), 6) AS lat_max, round(CAST(lon_min AS DOUBLE), 6) AS lon_min, round(CAST(lon_max AS DOUBLE), 6) AS lon_max FROM r"""


def region_counts(spark, d):
    """Buildings by region of the grid: half-open cells, so every building has one region."""
    b = T.buildings(spark, d).withColumns({"iy": F.floor((F.col("lat") - 24) * 10 / 60 + 1e-9).cast("int"), "ix": F.floor((F.col("lon") + 125) * 10 / 45 + 1e-9).cast("int")})
    return b.groupBy(S.region_id("iy", "ix").alias("region_id")).agg(F.count(F.lit(1)).alias("n"))


REGION_COUNTS_SQL = f"{_B} SELECT 'y' || CAST(floor((lat - 24) * 10 / 60 + 1e-9) AS INTEGER) || '_x' || CAST(floor((lon + 125) * 10 / 45 + 1e-9) AS INTEGER) AS region_id, count(*) AS n FROM b GROUP BY ALL"


def bbox_regions(spark, d):
    return grid.for_bbox(grid.regions(spark, GRID), -123.3, 25.02, -118.01, 38.0).select("region_id")


BBOX_REGIONS_SQL = f"WITH r AS ({_REGIONS}) SELECT region_id FROM r WHERE lon_min <= -118.01 AND lon_max >= -123.3 AND lat_min <= 38.0 AND lat_max >= 25.02"


def _status_inputs(spark, d):
    n = T.table(spark, d, "nation")
    provided = n.select(S.region_id("n_regionkey", "n_nationkey").alias("region_id"))
    valid = T.table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).where(F.col("c_acctbal") > 9900).select(S.region_id("n_regionkey", "n_nationkey").alias("region_id")).distinct()
    messages = T.table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).where(F.col("s_acctbal") < 0)
    messages = messages.select(F.concat(F.lit("wrote region_id ("), S.region_id("n_regionkey", "n_nationkey"), F.lit(")")).alias("message"))
    return provided, valid, messages.select(S.message_region("message").alias("region_id"))


def status(spark, d):
    return grid.region_status(*_status_inputs(spark, d))


STATUS_SQL = """WITH p AS (SELECT 'y' || n_regionkey || '_x' || n_nationkey AS region_id, n_nationkey FROM nation),
v AS (SELECT DISTINCT region_id FROM p JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9900),
s AS (SELECT DISTINCT region_id FROM p JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal < 0)
SELECT region_id, region_id IN (FROM v) AS valid, region_id NOT IN (FROM v) AS invalid, region_id IN (FROM s) AS previously_processed,
region_id IN (FROM v) AND region_id NOT IN (FROM s) AS unprocessed_valid FROM p"""


def unprocessed(spark, d):
    """Set operations: valid regions less those done, and those in both."""
    _, valid, done = _status_inputs(spark, d)
    todo = valid.join(done, "region_id", "left_anti").withColumn("kind", F.lit("todo"))
    return todo.unionByName(valid.intersect(done).withColumn("kind", F.lit("done")))


UNPROCESSED_SQL = STATUS_SQL.split("SELECT region_id, region_id IN")[0] + """, t AS (FROM v EXCEPT FROM s), i AS (FROM v INTERSECT FROM s)
SELECT region_id, 'todo' AS kind FROM t UNION ALL SELECT region_id, 'done' AS kind FROM i"""


def valid_regions(spark, d):
    """Regions of the raster with any value; zero stands for missing here."""
    p = T.pixels(spark, d).withColumn("v", F.when(F.col("v") > 0.045, F.col("v")))
    return grid.valid_regions(p, GRID._replace(cy=2, cx=5), "v")


VALID_SQL = T.with_sql(p=T.PIXELS) + " SELECT DISTINCT 'y' || (iy // 2) || '_x' || (ix // 5) AS region_id FROM p WHERE v > 0.045"


def starts(spark, d):
    sizes = T.table(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("size"))
    return grid.chunk_starts(sizes.select(F.lit("y").alias("axis"), F.col("n_regionkey").alias("k"), "size"))


STARTS_SQL = """SELECT 'y' AS axis, n_regionkey AS k, count(*) AS size, CAST(coalesce(sum(count(*)) OVER (ORDER BY n_regionkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM nation GROUP BY n_regionkey"""


def positive(spark, d):
    """Places of buildings at risk in both periods, rounded as the tiles have them."""
    b = T.buildings(spark, d).where((F.col("rps_2011") > 0) & (F.col("rps_2047") > 0))
    return b.select("l_orderkey", "l_linenumber", F.round(F.col("lon"), 3).alias("lon"), F.round(F.col("lat"), 3).alias("lat"), F.round(F.col("rps_2011").cast("double"), 3).alias("score"))


POSITIVE_SQL = f"{_B} SELECT l_orderkey, l_linenumber, round(lon, 3) AS lon, round(lat, 3) AS lat, round(CAST(rps_2011 AS DOUBLE), 3) AS score FROM b WHERE rps_2011 > 0 AND rps_2047 > 0"


def ascending(spark, d):
    lat = T.pixels(spark, d).groupBy("iy").agg(F.max("lat").alias("lat"))
    return grid.monotonic(lat, "lat", "iy")


ASCENDING_SQL = T.with_sql(p=T.PIXELS, a="SELECT iy, max(lat) AS lat FROM p GROUP BY iy", s="SELECT lead(lat) OVER (ORDER BY iy) - lat AS step FROM a") + " SELECT coalesce(bool_and(step > 0), true) AS ascending FROM s"


def semi_join(spark, d):
    """Orders' boxes that any area touches: each once, whatever the number of areas."""
    boxes = R.order_boxes(spark, d)
    met = joins.overlapping_boxes(boxes, T.areas(spark, d), 1.0, "o", "c").select(F.col("o_box_id").alias("box_id"))
    kept = boxes.join(met, "box_id", "left_semi")
    return kept.select("box_id", F.round("xmin", 6).alias("xmin"), F.round("ymax", 6).alias("ymax"))


SEMI_SQL = T.with_sql(o=R.BOXES, c=T.AREAS) + """ SELECT box_id, round(xmin, 6) AS xmin, round(ymax, 6) AS ymax FROM o
WHERE EXISTS (FROM c WHERE o.xmin <= c.xmax AND o.xmax >= c.xmin AND o.ymin <= c.ymax AND o.ymax >= c.ymin)"""


def polygon_overlap(spark, d):
    """Triangles against boxes (both WKB): candidates by cells, decided on the shapes. Equal boxes and equal triangles meet once."""
    wkb = lambda df: df.withColumn("shape", geo.from_wkt_udf(F.format_string("POLYGON((%1$.17g %2$.17g, %3$.17g %2$.17g, %3$.17g %4$.17g, %1$.17g %4$.17g, %1$.17g %2$.17g))", "xmin", "ymin", "xmax", "ymax")))
    boxes = R.order_boxes(spark, d).groupBy("xmin", "ymin", "xmax", "ymax").agg(F.count(F.lit(1)).alias("n"))
    shapes, members = joins.shape_classes(T.triangles(spark, d), "area_id", "geometry")
    bounded = shapes.withColumn("_box", geo.bbox_udf("_shape")).select("*", "_box.*").drop("_box")
    met = joins.overlapping_boxes(wkb(boxes), bounded, 1.0, "o", "c").where(geo.intersects_udf("o_shape", "c__shape"))
    found = met.groupBy(F.col("c__class").alias("_class")).agg(F.sum("o_n").alias("n"))
    return members.join(found, "_class").select(F.col("area_id").alias("c_area_id"), "n")


# A box meets a right triangle if it meets its box and its lower left corner, held to the triangle's box, is below the long side.
POLYGON_OVERLAP_SQL = T.with_sql(o=R.BOXES, c=T.AREAS) + """ SELECT area_id AS c_area_id, count(*) AS n FROM o JOIN c
ON o.xmin <= c.xmax AND o.xmax >= c.xmin AND o.ymin <= c.ymax AND o.ymax >= c.ymin
AND (c.xmax - c.xmin) * (greatest(o.ymin, c.ymin) - c.ymin) + (c.ymax - c.ymin) * (greatest(o.xmin, c.xmin) - c.xmin) <= (c.xmax - c.xmin) * (c.ymax - c.ymin) GROUP BY area_id"""


def feature_lines(spark, d):
    """Areas as the GeoJSON features that the writers make, read back field by field."""
    made = sinks.features(T.triangles(spark, d).withColumn("name", F.when(F.col("area_id") % 2 == 0, F.concat(F.lit("area "), F.col("area_id")))))
    field = lambda path: F.get_json_object("value", path)
    return made.select(
        field("$.properties.area_id").cast("long").alias("area_id"), field("$.properties.name").alias("name"), field("$.geometry.type").alias("kind"),
        F.round(field("$.geometry.coordinates[0][1][0]").cast("double"), 6).alias("x1"), F.col("value").contains('"name":null').alias("null_kept"),
    )


FEATURES_SQL = T.with_sql(c=T.AREAS) + """ SELECT area_id, CASE WHEN area_id % 2 = 0 THEN 'area ' || area_id END AS name, 'Polygon' AS kind, round(xmax, 6) AS x1, area_id % 2 <> 0 AS null_kept FROM c"""


def catalog_query(spark, d):
    """SQL over a named dataset, the latest of its versions."""
    known = Catalog([Dataset("homes", f"{d}/customer.parquet", "parquet", "v2"), Dataset("homes", f"{d}/supplier.parquet", "parquet", "v10")])
    return known.get("HOMES", case_sensitive=False, latest=True).query(spark, "SELECT s_nationkey AS nation, count(*) AS n, round(max(s_acctbal), 2) AS most FROM {source} GROUP BY s_nationkey")


CATALOG_SQL = "SELECT s_nationkey AS nation, count(*) AS n, round(max(s_acctbal), 2) AS most FROM supplier GROUP BY s_nationkey"


def template_counts(spark, d):
    """An empty raster for the regions that hold values, counted by region."""
    small = grid.Grid(ny=40, nx=50, cy=12, cx=20, lat0=24.0, lon0=-125.0, dlat=0.5, dlon=0.5)
    empty = grid.template(spark, small, ["v"], grid.valid_regions(T.pixels(spark, d), small, "v"))
    return empty.groupBy("region_id").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_values"), F.round(F.max("lat"), 6).alias("north"))


TEMPLATE_SQL = T.with_sql(
    p=T.PIXELS, c="SELECT y.i AS iy, x.i AS ix FROM range(40) y(i), range(50) x(i)", k="SELECT iy // 12 AS cy, ix // 20 AS cx FROM p WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL",
) + """ SELECT 'y' || cy || '_x' || cx AS region_id, count(*) AS n, 0::BIGINT AS n_values, round(max(24::DOUBLE + iy * 0.5::DOUBLE), 6) AS north
FROM c JOIN k ON c.iy // 12 = k.cy AND c.ix // 20 = k.cx GROUP BY cy, cx"""


def versioned_paths(spark, d):
    path = F.concat_ws("/", F.lit("output"), "p_brand", F.when(F.col("p_partkey") % 3 == 0, F.lit("v2")), "p_name")
    return T.table(spark, d, "part").select("p_partkey", files.versioned(path, "2", "qa").alias("path"), files.versioned("p_name", "1").alias("name"))


VERSIONED_SQL = """WITH q AS (SELECT *, concat_ws('/', 'output', p_brand, CASE WHEN p_partkey % 3 = 0 THEN 'v2' END, p_name) AS path FROM part)
SELECT p_partkey, CASE WHEN contains(path, 'v2') THEN path ELSE regexp_replace(path, '^(.*/)?([^/]*)$', '\\1qa/v2/\\2') END AS path,
CASE WHEN contains(p_name, 'v1') THEN p_name ELSE 'v1/' || p_name END AS name FROM q"""


QUERIES = {
    "spatial_join_boxes": (box_join, BOX_SQL),
    "bbox_overlap_join": (overlap_join, OVERLAP_SQL),
    "point_in_polygon": (polygon_join, POLYGON_SQL),
    "polygon_measures": (centroids, CENTROIDS_SQL),
    "sample_nearest": (sample, SAMPLE_SQL),
    "exact_align": (align, ALIGN_SQL),
    "merge_variables": (merge, MERGE_SQL),
    "region_grid": (regions, REGIONS_SQL),
    "region_counts": (region_counts, REGION_COUNTS_SQL),
    "regions_for_bbox": (bbox_regions, BBOX_REGIONS_SQL),
    "region_status": (status, STATUS_SQL),
    "region_sets": (unprocessed, UNPROCESSED_SQL),
    "valid_regions": (valid_regions, VALID_SQL),
    "chunk_starts": (starts, STARTS_SQL),
    "positive_centroids": (positive, POSITIVE_SQL),
    "spatial_semi_join": (semi_join, SEMI_SQL),
    "polygon_overlap": (polygon_overlap, POLYGON_OVERLAP_SQL),
    "feature_lines": (feature_lines, FEATURES_SQL),
    "template_counts": (template_counts, TEMPLATE_SQL),
    "versioned_paths": (versioned_paths, VERSIONED_SQL),
    "catalog_query": (catalog_query, CATALOG_SQL),
    "ascending_check": (ascending, ASCENDING_SQL),
}
