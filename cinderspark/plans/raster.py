"""Queries on the pixel table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderspark.functions import scalar as S
from cinderspark.operators import grid, kernels, raster
from cinderspark.plans import tables as T

_P = T.with_sql(p=T.PIXELS, g="SELECT max(iy) + 1 AS ny, max(ix) + 1 AS nx FROM p")
#: A small lopsided kernel, and its SQL.
TAPS = [(0, 0, 0.25), (0, 1, 0.2), (0, -1, 0.15), (1, 0, 0.15), (-1, 0, 0.1), (1, 1, 0.1), (-2, 1, 0.05)]
_TAPS = "SELECT * FROM (VALUES " + ", ".join(f"({dy}, {dx}, CAST({w} AS DOUBLE))" for dy, dx, w in TAPS) + ") AS t(dy, dx, w)"


def _mirror(i: str, n: str) -> str:
    wrapped = f"((({i}) % (2 * ({n} - 1))) + 2 * ({n} - 1)) % (2 * ({n} - 1))"
    return f"CASE WHEN {n} = 1 THEN 0 WHEN {wrapped} < {n} THEN {wrapped} ELSE 2 * ({n} - 1) - {wrapped} END"


def _round(c: str, n: int = 9):
    return F.round(c, n).alias(c)


def shift4(spark, d):
    p = raster.shifts(T.pixels(spark, d), "v")
    return p.select("iy", "ix", "west", "east", "south", "north")


SHIFT_SQL = f"""{_P} SELECT p.iy, p.ix, w.v AS west, e.v AS east, s.v AS south, n.v AS north FROM p
LEFT JOIN p w ON w.iy = p.iy AND w.ix = p.ix - 1 LEFT JOIN p e ON e.iy = p.iy AND e.ix = p.ix + 1
LEFT JOIN p s ON s.iy = p.iy - 1 AND s.ix = p.ix LEFT JOIN p n ON n.iy = p.iy + 1 AND n.ix = p.ix"""


def rolling(spark, d):
    return raster.rolling_mean_3x3(T.pixels(spark, d), "v", "mean").select("iy", "ix", _round("mean"))


_MEAN = "m AS (SELECT a.iy, a.ix, avg(b.v) AS mean FROM p a JOIN p b ON abs(a.iy - b.iy) <= 1 AND abs(a.ix - b.ix) <= 1 GROUP BY ALL)"
ROLLING_SQL = f"{_P}, {_MEAN} SELECT iy, ix, round(mean, 9) AS mean FROM m"


def gap_fill(spark, d):
    return raster.gap_fill(T.pixels(spark, d), "v").select("iy", "ix", _round("filled"))


GAP_SQL = f"""{_P}, {_MEAN}, k AS (SELECT p.iy, p.ix, p.v, coalesce(w.v > 0 AND e.v > 0 AND s.v > 0 AND n.v > 0, false) AS enclosed FROM p
LEFT JOIN p w ON w.iy = p.iy AND w.ix = p.ix - 1 LEFT JOIN p e ON e.iy = p.iy AND e.ix = p.ix + 1
LEFT JOIN p s ON s.iy = p.iy - 1 AND s.ix = p.ix LEFT JOIN p n ON n.iy = p.iy + 1 AND n.ix = p.ix)
SELECT k.iy, k.ix, round(CASE WHEN NOT v > 0 AND enclosed THEN mean ELSE v END, 9) AS filled FROM k JOIN m ON k.iy = m.iy AND k.ix = m.ix"""


def taps(spark, d):
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    return raster.correlate(p, "v", TAPS, ny, nx, "c").select("iy", "ix", _round("c"))


_ASKED = f"""t AS ({_TAPS}), k AS (SELECT p.iy, p.ix, {_mirror('p.iy + dy', 'ny')} AS sy, {_mirror('p.ix + dx', 'nx')} AS sx, t.w AS w FROM p, g, t)"""
TAPS_SQL = f"{_P}, {_ASKED} SELECT k.iy, k.ix, round(sum(k.w * s.v), 9) AS c FROM k JOIN p s ON s.iy = sy AND s.ix = sx GROUP BY ALL"


def spread(iterations: int):
    def run(spark, d):
        p = T.pixels(spark, d)
        ny, nx = T.shape(p)
        for _ in range(iterations):
            p = raster.masked_mean_step(p, "v", TAPS, ny, nx)
        # Twelve digits: quotients of short decimals end in a five at the tenth now and then.
        return p.select("iy", "ix", _round("v", 12))

    return run


def spread_sql(iterations: int) -> str:
    out, last = f"{_P}, {_ASKED}", "p"
    for n in range(iterations):
        out += f""", c{n} AS (SELECT k.iy, k.ix, sum(k.w * s.v) AS a, sum(k.w * CASE WHEN s.v > 0 THEN 1 ELSE 0 END) AS c FROM k JOIN {last} s ON s.iy = sy AND s.ix = sx GROUP BY ALL),
s{n} AS (SELECT iy, ix, CASE WHEN c >= 10e-12 THEN CASE WHEN a < 10e-12 THEN 0 ELSE a END / c ELSE 0 END AS v FROM c{n})"""
        last = f"s{n}"
    return f"{out} SELECT iy, ix, round(v, 12) AS v FROM {last}"


def composite(spark, d):
    """Eight layers made from the value, weighted by shares made from the place; some places have no shares."""
    p = T.pixels(spark, d)
    shares = F.array(*[((F.col("iy") + F.col("ix") * (k + 1)) % 5).cast("double") * (F.col("ix") % 9 > 0).cast("double") for k in range(8)])
    layers = [F.col("v") * (k + 1) for k in range(8)]
    return p.withColumn("shares", shares).select("iy", "ix", F.round(raster.combine(raster.composite(layers, "shares"), "v"), 9).alias("bp"))


_SHARE = lambda k: f"((iy + ix * {k + 1}) % 5) * CASE WHEN ix % 9 > 0 THEN 1 ELSE 0 END"
_TOTAL = " + ".join(_SHARE(k) for k in range(8))
COMPOSITE_SQL = f"""{_P} SELECT iy, ix, round(CASE WHEN v = 0 THEN CASE WHEN ({_TOTAL}) <> 0 THEN ({' + '.join(f'v * {k + 1} * ({_SHARE(k)})' for k in range(8))}) / ({_TOTAL}) END ELSE v END, 9) AS bp FROM p"""


def stack(spark, d):
    p = T.pixels(spark, d).select("iy", "ix", *[F.round(F.col("v") * (k + 1), 9).alias(x) for k, x in enumerate(S.DIRECTIONS)])
    return raster.stack_directions(p, ["iy", "ix"])


STACK_SQL = _P + " " + " UNION ALL ".join(f"SELECT iy, ix, '{x}' AS direction, round(v * {k + 1}, 9) AS bp FROM p" for k, x in enumerate(S.DIRECTIONS))


def coarsen(spark, d):
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    return raster.coarsen(p, ["v", "w"], 3, 4, ny, nx).select("iy", "ix", _round("v"), _round("w", 6))


COARSEN_SQL = f"{_P} SELECT iy // 3 AS iy, ix // 4 AS ix, round(avg(v), 9) AS v, round(avg(w), 6) AS w FROM p, g WHERE iy < ny // 3 * 3 AND ix < nx // 4 * 4 GROUP BY ALL"


def pyramid(spark, d):
    return raster.pyramid(T.pixels(spark, d), ["v"], 3).select("level", "iy", "ix", _round("v"))


PYRAMID_SQL = f"""{_P}, l1 AS (SELECT iy // 2 AS iy, ix // 2 AS ix, avg(v) AS v FROM p GROUP BY ALL),
l2 AS (SELECT iy // 2 AS iy, ix // 2 AS ix, avg(v) AS v FROM l1 GROUP BY ALL), l3 AS (SELECT iy // 2 AS iy, ix // 2 AS ix, avg(v) AS v FROM l2 GROUP BY ALL)
SELECT level, iy, ix, round(v, 9) AS v FROM (SELECT 0 AS level, iy, ix, v FROM p UNION ALL SELECT 1, iy, ix, v FROM l1 UNION ALL SELECT 2, iy, ix, v FROM l2 UNION ALL SELECT 3, iy, ix, v FROM l3)"""


def gaussian(spark, d):
    """A separable smoothing of five by five taps, by the same tap join."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    w = [0.05, 0.24, 0.42, 0.24, 0.05]
    one = raster.correlate(p, "v", [(0, k - 2, x) for k, x in enumerate(w)], ny, nx, "v")
    return raster.correlate(one, "v", [(k - 2, 0, x) for k, x in enumerate(w)], ny, nx, "v").select("iy", "ix", _round("v"))


_GAUSS = "SELECT * FROM (VALUES (-2, 0.05::DOUBLE), (-1, 0.24), (0, 0.42), (1, 0.24), (2, 0.05)) AS t(o, w)"
GAUSSIAN_SQL = f"""{_P}, t AS ({_GAUSS}), a AS (SELECT k.iy, k.ix, sum(k.w * s.v) AS v FROM (SELECT p.iy, p.ix, {_mirror('p.ix + o', 'nx')} AS sx, t.w FROM p, g, t) k JOIN p s ON s.iy = k.iy AND s.ix = sx GROUP BY ALL)
SELECT k.iy, k.ix, round(sum(k.w * s.v), 9) AS v FROM (SELECT p.iy, p.ix, {_mirror('p.iy + o', 'ny')} AS sy, t.w FROM p, g, t) k JOIN a s ON s.ix = k.ix AND s.iy = sy GROUP BY ALL"""


def resample(spark, d):
    """A grid of another step sampled from the raster; places outside it are null."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    target = p.select(F.col("iy").alias("ty"), F.col("ix").alias("tx"), (F.lit(T.LON0) - 0.33 + F.col("ix") * 0.13).alias("lon"), (F.lit(T.LAT0) + 0.07 + F.col("iy") * 0.07).alias("lat"))
    out = raster.resample_nearest(target, p.select("iy", "ix", "v"), T.LON0, T.LAT0, T.STEP, T.STEP, nx, ny)
    return out.select(F.col("ty").alias("iy"), F.col("tx").alias("ix"), "v")


RESAMPLE_SQL = f"""{_P}, t AS (SELECT iy, ix, CAST(floor(({T.LON0}::DOUBLE - 0.33::DOUBLE + ix * 0.13::DOUBLE - {T.LON0}::DOUBLE) / 0.1::DOUBLE + 0.5) AS INTEGER) AS sx,
CAST(floor(({T.LAT0}::DOUBLE + 0.07::DOUBLE + iy * 0.07::DOUBLE - {T.LAT0}::DOUBLE) / 0.1::DOUBLE + 0.5) AS INTEGER) AS sy FROM p)
SELECT t.iy, t.ix, p.v FROM t LEFT JOIN p ON p.iy = sy AND p.ix = sx"""


def rasterize(spark, d):
    """How many orders' boxes touch each pixel."""
    boxes = order_boxes(spark, d)
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    return raster.rasterize_boxes(boxes, T.LON0, T.LAT0, T.STEP, T.STEP, nx, ny)


def order_boxes(spark, d):
    """Orders as boxes: the lower corner from the order, the size from the customer."""
    o = T.table(spark, d, "orders")
    x = F.lit(-125.05) + (F.col("o_orderkey") % 53) / 10.0
    y = F.lit(23.95) + (F.col("o_custkey") % 31) / 10.0
    return o.select(F.col("o_orderkey").alias("box_id"), x.alias("xmin"), y.alias("ymin"), (x + 0.02 + (F.col("o_custkey") % 3) / 10.0).alias("xmax"), (y + 0.02 + (F.col("o_orderkey") % 2) / 10.0).alias("ymax"))


BOXES = """SELECT box_id, x AS xmin, y AS ymin, x + 0.02::DOUBLE + (o_custkey % 3) / 10::DOUBLE AS xmax, y + 0.02::DOUBLE + (o_orderkey % 2) / 10::DOUBLE AS ymax FROM (
SELECT *, o_orderkey AS box_id, CAST(-125.05 AS DOUBLE) + (o_orderkey % 53) / 10::DOUBLE AS x, CAST(23.95 AS DOUBLE) + (o_custkey % 31) / 10::DOUBLE AS y FROM orders)"""
_AT = lambda c, o: f"CAST(floor(({c} - {o}::DOUBLE) / 0.1::DOUBLE + 0.5) AS INTEGER)"
RASTERIZE_SQL = f"""{_P}, b AS ({BOXES}), k AS (SELECT {_AT('ymin', T.LAT0)} AS y0, {_AT('ymax', T.LAT0)} AS y1, {_AT('xmin', T.LON0)} AS x0, {_AT('xmax', T.LON0)} AS x1, ny, nx FROM b, g),
y AS (SELECT *, unnest(generate_series(greatest(y0, 0), least(y1, ny - 1))) AS iy FROM k), x AS (SELECT iy, unnest(generate_series(greatest(x0, 0), least(x1, nx - 1))) AS ix FROM y)
SELECT CAST(iy AS INTEGER) AS iy, CAST(ix AS INTEGER) AS ix, count(*) AS n FROM x GROUP BY ALL"""


def areas(spark, d):
    return T.pixels(spark, d).select("iy", "ix", F.round(S.cell_area_km2("lat", T.STEP, T.STEP), 6).alias("km2"), F.round(S.haversine("lat", "lon", F.lit(37.0), F.lit(-120.0)), 3).alias("metres"), F.round(S.at_least(F.col("v") - 0.02), 9).alias("clipped"))


AREAS_SQL = f"""{_P} SELECT iy, ix, round(6371000.0::DOUBLE * 6371000.0::DOUBLE / 1e6 * radians(0.1) * radians(0.1) * cos(radians(lat)), 6) AS km2,
round(2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin((radians(37.0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(37.0)) * pow(sin((radians(-120.0) - radians(lon)) / 2), 2))), 3) AS metres,
round(greatest(v - 0.02::DOUBLE, 0), 9) AS clipped FROM p"""


def box_select(spark, d):
    return grid.select_box(T.pixels(spark, d), bbox=(-124.05, 23.95, -121.95, 25.05)).select("iy", "ix", "v")


BOX_SQL = f"{_P} SELECT iy, ix, v FROM p WHERE lon BETWEEN -124.05 AND -121.95 AND lat BETWEEN 23.95 AND 25.05"


def point_select(spark, d):
    return grid.select_box(T.pixels(spark, d), point=(-122.32, 24.21)).select("iy", "ix", "v", "requested_lon", "requested_lat")


POINT_SQL = f"{_P} SELECT iy, ix, v, -122.32::DOUBLE AS requested_lon, 24.21::DOUBLE AS requested_lat FROM p ORDER BY abs(lat - 24.21::DOUBLE), abs(lon + 122.32::DOUBLE), lat, lon LIMIT 1"


def extent(spark, d):
    e = grid.extent(T.pixels(spark, d))
    return e.select(*[F.round(c, 9).alias(c) for c in e.columns])


EXTENT_SQL = f"{_P} SELECT round(min(lon), 9) AS xmin, round(min(lat), 9) AS ymin, round(max(lon), 9) AS xmax, round(max(lat), 9) AS ymax FROM p"


def mercator(spark, d):
    lon, lat = S.mercator_to_degrees(F.col("lon") * 1e5, F.col("lat") * 1e5)
    return T.pixels(spark, d).select("iy", "ix", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


MERCATOR_SQL = f"{_P} SELECT iy, ix, round(degrees(lon * 1e5 / 6378137.0), 7) AS lon, round(degrees(2 * atan(exp(lat * 1e5 / 6378137.0))) - 90, 7) AS lat FROM p"


def burn_probability(spark, d):
    """The whole wind-informed surface on tiles (kernels in metres of a 30 m grid)."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    shares = F.array(*[(1.0 + (F.col("iy") + F.col("ix") * (k + 1)) % 5).cast("double") for k in range(8)])
    distribution = p.select("iy", "ix", shares.alias("distribution"))
    return raster.wind_informed_burn_probability(p, "v", distribution, ny, nx, 35.0, -120.0, 0.00027, 0.00033, tile=64)


#: A coarse step, at which the wind's ellipse covers a few pixels.
COARSE, WINDOW = 0.0018, 5


def small_burn_probability(spark, d):
    """The whole surface on tiles of eight pixels, with kernels of five by five, in double precision."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    shares = F.array(*[(1.0 + (F.col("iy") + F.col("ix") * (k + 1)) % 5).cast("double") for k in range(8)])
    distribution = p.select("iy", "ix", shares.alias("distribution"))
    wind = kernels.wind_kernels(35.0, -120.0, COARSE, COARSE, WINDOW)
    out = raster.wind_informed_burn_probability(p, "v", distribution, ny, nx, 35.0, -120.0, COARSE, COARSE, tile=8, kind="double", wind=wind)
    return out.select("iy", "ix", _round("bp"))


def _small_burn_probability_sql() -> str:
    values = []
    for direction, k in kernels.wind_kernels(35.0, -120.0, COARSE, COARSE, WINDOW).items():
        at = S.DIRECTIONS.index(direction)
        values += [f"({at}, {dy}, {dx}, CAST({w!r} AS DOUBLE))" for dy, dx, w in kernels.taps(k)]
    gauss = kernels.gaussian(COARSE)
    g = ", ".join(f"({k - len(gauss) // 2}, CAST({float(w)!r} AS DOUBLE))" for k, w in enumerate(gauss))
    out = GAP_SQL.replace("SELECT k.iy, k.ix, round(CASE", ", f AS (SELECT k.iy, k.ix, CASE").replace("ELSE v END, 9) AS filled FROM k", "ELSE v END AS v FROM k") + ")"
    out += f""", t AS (SELECT * FROM (VALUES {', '.join(values)}) AS t(dir, dy, dx, w)),
a AS (SELECT dir, f.iy, f.ix, {_mirror('f.iy + dy', 'ny')} AS sy, {_mirror('f.ix + dx', 'nx')} AS sx, t.w FROM f, g, t), z AS (SELECT dir, iy, ix, v FROM f, (SELECT DISTINCT dir FROM t))"""
    last = "z"
    for n in range(3):
        out += f""", c{n} AS (SELECT a.dir, a.iy, a.ix, sum(a.w * s.v) AS s, sum(a.w * CASE WHEN s.v > 0 THEN 1 ELSE 0 END) AS c FROM a JOIN {last} s ON s.dir = a.dir AND s.iy = sy AND s.ix = sx GROUP BY ALL),
s{n} AS (SELECT dir, iy, ix, CASE WHEN c >= 10e-12 THEN CASE WHEN s < 10e-12 THEN 0 ELSE s END / c ELSE 0 END AS v FROM c{n})"""
        last = f"s{n}"
    share = "(1.0::DOUBLE + (iy + ix * (dir + 1)) % 5)"
    return f"""{out}, h AS (SELECT iy, ix, sum(v * {share}) / sum({share}) AS v FROM {last} GROUP BY iy, ix),
mm AS (SELECT f.iy, f.ix, CASE WHEN f.v = 0 THEN h.v ELSE f.v END AS v FROM f JOIN h ON h.iy = f.iy AND h.ix = f.ix), q AS (SELECT * FROM (VALUES {g}) AS q(o, w)),
b AS (SELECT k.iy, k.ix, sum(k.w * s.v) AS v FROM (SELECT mm.iy, mm.ix, {_mirror('mm.iy + o', 'ny')} AS sy, q.w FROM mm, g, q) k JOIN mm s ON s.ix = k.ix AND s.iy = sy GROUP BY ALL)
SELECT k.iy, k.ix, round(sum(k.w * s.v), 9) AS bp FROM (SELECT b.iy, b.ix, {_mirror('b.ix + o', 'nx')} AS sx, q.w FROM b, g, q) k JOIN b s ON s.iy = k.iy AND s.ix = sx GROUP BY ALL"""


def polygon_counts(spark, d):
    """How many triangles hold each pixel's centre; the raster is moved off their corners."""
    p = T.pixels(spark, d)
    ny, nx = T.shape(p)
    return raster.rasterize_polygons(T.triangles(spark, d), "geometry", T.LON0 + 0.031, T.LAT0 + 0.017, T.STEP, T.STEP, nx, ny)


POLYGON_COUNTS_SQL = f"""{_P}, c AS ({T.AREAS}), q AS (SELECT iy, ix, {T.LON0}::DOUBLE + 0.031::DOUBLE + ix * 0.1::DOUBLE AS x, {T.LAT0}::DOUBLE + 0.017::DOUBLE + iy * 0.1::DOUBLE AS y FROM p)
SELECT iy, ix, count(*) AS n FROM q JOIN c ON x >= xmin AND y >= ymin AND (xmax - xmin) * (y - ymin) + (ymax - ymin) * (x - xmin) <= (xmax - xmin) * (ymax - ymin) GROUP BY iy, ix"""


QUERIES = {
    "shift4": (shift4, SHIFT_SQL),
    "rolling3x3": (rolling, ROLLING_SQL),
    "gap_fill": (gap_fill, GAP_SQL),
    "conv_taps": (taps, TAPS_SQL),
    "conv_masked": (spread(1), spread_sql(1)),
    "conv_masked_3": (spread(3), spread_sql(3)),
    "weighted_composite": (composite, COMPOSITE_SQL),
    "direction_stack": (stack, STACK_SQL),
    "coarsen_trim": (coarsen, COARSEN_SQL),
    "pyramid_levels": (pyramid, PYRAMID_SQL),
    "gauss_separable": (gaussian, GAUSSIAN_SQL),
    "resample_nearest": (resample, RESAMPLE_SQL),
    "rasterize_count": (rasterize, RASTERIZE_SQL),
    "cell_measures": (areas, AREAS_SQL),
    "box_select": (box_select, BOX_SQL),
    "point_select": (point_select, POINT_SQL),
    "extent": (extent, EXTENT_SQL),
    "mercator_inverse": (mercator, MERCATOR_SQL),
    "rasterize_polygons": (polygon_counts, POLYGON_COUNTS_SQL),
    "wind_informed_bp_small": (small_burn_probability, _small_burn_probability_sql()),
    "wind_informed_bp": (burn_probability, None),
}
