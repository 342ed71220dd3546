"""The driver's tables in the roles of the engine's inputs, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import geo

NX = 50
LON0, LAT0, STEP = -125.0, 24.0, 0.1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as buildings with risk values, nested GEOIDs and places."""
    t = lambda name: table(spark, sf_dir, name)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pad = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    out = joined.select(
        "l_orderkey", "l_linenumber", "n_name", "r_name",
        F.concat(pad("n_regionkey", 2), pad("n_nationkey", 3), pad("c_custkey", 9)).alias("GEOID"),
        (F.lit(LON0) + (F.col("l_partkey") % 580) / 10.0).alias("lon"),
        (F.lit(LAT0) + (F.col("l_suppkey") % 250) / 10.0).alias("lat"),
        (F.col("l_discount") + F.lit(0.0)).cast("float").alias("bp_2011"),
        (F.col("l_tax") + F.lit(0.0)).cast("float").alias("bp_2047"),
        F.col("l_quantity").cast("float").alias("crps_scott"),
    )
    return out.withColumns({"rps_2011": F.col("bp_2011") * F.col("crps_scott"), "rps_2047": F.col("bp_2047") * F.col("crps_scott")})


BUILDINGS = f"""SELECT *, bp_2011 * crps_scott AS rps_2011, bp_2047 * crps_scott AS rps_2047 FROM (
  SELECT l_orderkey, l_linenumber, n_name, r_name,
    lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS GEOID,
    CAST({LON0} AS DOUBLE) + CAST(l_partkey % 580 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon,
    CAST({LAT0} AS DOUBLE) + CAST(l_suppkey % 250 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat,
    CAST(l_discount + 0.0 AS FLOAT) AS bp_2011, CAST(l_tax + 0.0 AS FLOAT) AS bp_2047, CAST(l_quantity AS FLOAT) AS crps_scott
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a raster of NX columns: iy, ix, lon, lat, v (some zeros), w."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.floor(key / NX).cast("int").alias("iy"),
        (key % NX).cast("int").alias("ix"),
        (F.lit(LON0) + (key % NX) * F.lit(STEP)).alias("lon"),
        (F.lit(LAT0) + F.floor(key / NX) * F.lit(STEP)).alias("lat"),
        F.when(F.col("p_size") % 7 == 0, F.lit(0.0)).otherwise(F.col("p_size") / 1000.0).alias("v"),
        (F.col("p_retailprice") / 1000.0).alias("w"),
    )


PIXELS = f"""SELECT CAST(p_partkey // {NX} AS INTEGER) AS iy, CAST(p_partkey % {NX} AS INTEGER) AS ix,
    CAST({LON0} AS DOUBLE) + CAST(p_partkey % {NX} AS DOUBLE) * CAST({STEP} AS DOUBLE) AS lon,
    CAST({LAT0} AS DOUBLE) + CAST(p_partkey // {NX} AS DOUBLE) * CAST({STEP} AS DOUBLE) AS lat,
    CASE WHEN p_size % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 1000 END AS v,
    p_retailprice / 1000 AS w FROM part"""


def shape(pixels_: DataFrame) -> tuple[int, int]:
    """(ny, nx) of a dense pixel table: one row of metadata."""
    row = pixels_.agg(F.max("iy").alias("y"), F.max("ix").alias("x")).first()
    return (row["y"] or 0) + 1, (row["x"] or 0) + 1


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as axis-aligned areas of a few degrees."""
    s = table(spark, sf_dir, "supplier")
    x, y = F.lit(-125.0) + (F.col("s_suppkey") * 7 % 560) / 10.0, F.lit(24.0) + (F.col("s_suppkey") * 3 % 240) / 10.0
    return s.select(F.col("s_suppkey").alias("area_id"), x.alias("xmin"), y.alias("ymin"), (x + 1.5).alias("xmax"), (y + 0.8).alias("ymax"))


AREAS = """SELECT area_id, x AS xmin, y AS ymin, x + 1.5 AS xmax, y + 0.8::DOUBLE AS ymax FROM (
SELECT s_suppkey AS area_id, CAST(-125 AS DOUBLE) + (s_suppkey * 7 % 560) / 10::DOUBLE AS x, CAST(24 AS DOUBLE) + (s_suppkey * 3 % 240) / 10::DOUBLE AS y FROM supplier)"""


def triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as triangles (WKB), from their corners' text."""
    c = areas(spark, sf_dir)
    n = lambda col: F.format_string("%.17g", F.col(col))
    ring = F.concat(F.lit("POLYGON(("), n("xmin"), F.lit(" "), n("ymin"), F.lit(", "), n("xmax"), F.lit(" "), n("ymin"), F.lit(", "), n("xmin"), F.lit(" "), n("ymax"), F.lit(", "), n("xmin"), F.lit(" "), n("ymin"), F.lit("))"))
    return c.select("area_id", geo.from_wkt_udf(ring).alias("geometry"))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly weather: pixel, ts, degrees, rh, t_f, wind."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("pixel"), "ts", F.col("value").alias("degrees"),
        ((n * 37) % 101).cast("double").alias("rh"), (40 + (n * 13) % 60).cast("double").alias("t_f"), ((n * 7) % 20).cast("double").alias("wind"),
    )


HOURS = """SELECT event_id, user_id AS pixel, ts, value AS degrees, CAST((event_id * 37) % 101 AS DOUBLE) AS rh,
    CAST(40 + (event_id * 13) % 60 AS DOUBLE) AS t_f, CAST((event_id * 7) % 20 AS DOUBLE) AS wind FROM events"""


def with_sql(**tables: str) -> str:
    """A WITH clause of the named tables."""
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in tables.items())
