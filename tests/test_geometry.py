import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.operators import joins

SQUARE = geo.box(0, 0, 4, 4)
HOLED = geo.write_wkb("Polygon", [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]])
TWO = geo.write_wkb("MultiPolygon", [[[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]], [[(6, 0), (8, 0), (8, 2), (6, 2), (6, 0)]]])


@pytest.mark.parametrize(
    "text",
    ["POINT (1.5 -2)", "LINESTRING (0 0, 3 4, 5 6)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTIPOINT (1 2, 3 4)", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"],
)
def test_text_round_trip(text):
    assert geo.to_wkt(geo.from_wkt(text)) == text


def test_big_endian():
    import struct

    assert geo.to_wkt(struct.pack(">BIdd", 0, 1, 3.0, 4.0)) == "POINT (3 4)"
    with pytest.raises(ValueError):
        geo.read_wkb(struct.pack("<BI", 1, 99))


def test_measures():
    assert geo.area(SQUARE) == 16 and geo.area(HOLED) == 12 and geo.area(TWO) == 8
    assert geo.centroid(SQUARE) == (2, 2) and geo.centroid(HOLED) == (2, 2) and geo.centroid(TWO) == (4, 1)
    assert geo.centroid(geo.from_wkt("LINESTRING (0 0, 2 0, 2 2)")) == (1.5, 0.5)
    assert geo.centroid(geo.from_wkt("POINT (3 4)")) == (3, 4)
    assert geo.bbox(TWO) == (0, 0, 8, 2)
    assert geo.to_geojson(geo.from_wkt("POINT (3 4)")) == '{"type":"Point","coordinates":[3.0,4.0]}'


def test_contains():
    x = np.array([2.0, 0.5, 0.0, 4.0, 5.0, 1.0, 2.0, 0.0])
    y = np.array([2.0, 0.5, 0.0, 2.0, 2.0, 2.0, 4.0, 5.0])
    assert geo.contains(geo.read_wkb(SQUARE), x, y).tolist() == [True, True, True, True, False, True, True, False]
    assert geo.contains(geo.read_wkb(HOLED), x, y).tolist() == [False, True, True, True, False, True, True, False]


def test_intersects():
    read = geo.read_wkb
    assert geo.polygons_intersect(read(SQUARE), read(geo.box(3, 3, 5, 5)))
    assert geo.polygons_intersect(read(SQUARE), read(geo.box(4, 4, 5, 5)))  # a corner
    assert geo.polygons_intersect(read(SQUARE), read(geo.box(1, 1, 2, 2)))  # within
    assert geo.polygons_intersect(read(SQUARE), read(geo.box(1, -1, 2, 5)))  # through
    assert not geo.polygons_intersect(read(SQUARE), read(geo.box(4.1, 0, 5, 4)))
    assert not geo.polygons_intersect(read(HOLED), read(geo.box(1.5, 1.5, 2.5, 2.5)))


def test_clip():
    assert geo.area(geo.clip_to_box(SQUARE, 1, 1, 9, 2)) == pytest.approx(3)
    assert geo.clip_to_box(SQUARE, 5, 5, 6, 6) is None
    assert geo.area(geo.clip_to_box(TWO, 1, 0, 7, 2)) == pytest.approx(4)


def test_projection_round_trip():
    lon, lat = np.array([-125.0, -96.0, -66.0]), np.array([24.5, 37.0, 49.0])
    x, y = geo.to_albers(lon, lat)
    back = geo.from_albers(x, y)
    assert np.allclose(back[0], lon, atol=1e-10) and np.allclose(back[1], lat, atol=1e-10)
    assert geo.to_albers(-96, 23) == (pytest.approx(0), pytest.approx(0, abs=1e-6))
    # Equal area: a cell of a degree has the ellipsoid's area wherever it is.
    def area(lat0):
        ring = [(-100 + k / 50, lat0) for k in range(51)] + [(-99, lat0 + k / 50) for k in range(51)] + [(-99 - k / 50, lat0 + 1) for k in range(51)] + [(-100, lat0 + 1 - k / 50) for k in range(51)]
        px, py = geo.to_albers(*np.array(ring).T)
        return abs(np.dot(px, np.roll(py, -1)) - np.dot(py, np.roll(px, -1))) / 2
    for lat0 in (25, 45):
        q = geo._q(math.radians(lat0 + 1)) - geo._q(math.radians(lat0))
        ring_area = geo._A**2 * q / 2 * math.radians(1)
        assert area(lat0) / ring_area == pytest.approx(1, rel=0.03)


def test_spatial_join(spark):
    polygons = spark.createDataFrame([(1, SQUARE), (2, geo.box(4, 0, 8, 4)), (3, HOLED)], "id int, geometry binary")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 4.0, 2.0), (3, 9.0, 9.0), (4, 0.5, 0.5)], "p int, x double, y double")
    met = joins.spatial_join(points, polygons, "x", "y", "geometry", 3.0)
    assert sorted((r["p"], r["id"]) for r in met.collect()) == [(1, 1), (2, 1), (2, 2), (2, 3), (4, 1), (4, 3)]
    once = joins.spatial_join(points, polygons, "x", "y", "geometry", 3.0, dedupe=["p"])
    assert sorted(r["p"] for r in once.collect()) == [1, 2, 4]


def test_overlaps_meet_once(spark):
    rng = np.random.default_rng(0)
    boxes = [(i, float(x), float(y), float(x + w), float(y + h)) for i, (x, y, w, h) in enumerate(rng.uniform(0, 3, (80, 4)))]
    df = spark.createDataFrame(boxes, "id int, xmin double, ymin double, xmax double, ymax double")
    got = [(r["a_id"], r["b_id"]) for r in joins.overlapping_boxes(df, df, 0.7).collect()]
    want = [(p[0], q[0]) for p in boxes for q in boxes if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]]
    assert sorted(got) == sorted(want)


def test_udfs(spark):
    df = spark.createDataFrame([(SQUARE,), (None,)], "g binary")
    row = df.where("g is not null").select(geo.centroid_udf("g").alias("c"), geo.wkt_udf("g").alias("t"), geo.area_udf("g").alias("a"), geo.geojson_udf("g").alias("j"), geo.clip_udf(0, 0, 1, 1)("g").alias("k"), geo.intersects_udf("g", "g").alias("i")).first()
    assert (row["c"]["x"], row["c"]["y"], row["a"], row["i"]) == (2, 2, 16, True) and row["t"].startswith("POLYGON") and geo.area(bytes(row["k"])) == 1
    out = spark.createDataFrame([(-100.0, 40.0)], "x double, y double").select(geo.to_albers_udf("x", "y").alias("p")).select("p.*").select(geo.from_albers_udf("x", "y").alias("q")).select("q.*").first()
    assert out["x"] == pytest.approx(-100) and out["y"] == pytest.approx(40)
    assert df.select(geo.bbox_udf("g").alias("b")).where(F.col("b.xmin").isNull()).count() == 1


def test_exact_align_fails(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "i int, v double")
    assert joins.exact_align(a, a.withColumnRenamed("v", "w"), ["i"]).count() == 2
    with pytest.raises(Exception, match="coordinates differ"):
        joins.exact_align(a, a.where("i = 0").withColumnRenamed("v", "w"), ["i"]).collect()
