"""Scalar functions as Column expressions: all stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_M = 6_371_000.0
DIRECTIONS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
SCORE_EDGES = (0.01, 0.02, 0.035, 0.06, 0.1, 0.2, 0.5, 1.0, 3.0, 100.0)
MERCATOR_RADIUS_M = 6_378_137.0
METERS_PER_DEGREE = 111_000.0
# Moisture content of fuel: coefficients of (1, h, h t) below 10 percent humidity, of (1, h, t) to 50, of (1, h h, h t, h) above;
# the damping polynomial of a thirtieth of it.
MOISTURE_DRY = (0.03229, 0.281073, -0.000578)
MOISTURE_MIDDLE = (2.22749, 0.160107, -0.01478)
MOISTURE_MOIST = (21.0606, 0.005565, -0.00035, -0.483199)
DAMPING = (1.0, -2.0, 1.5, -0.5)
RED_FLAG_HUMIDITY, RED_FLAG_GUST_FACTOR, RED_FLAG_WIND = 15, 1.4, 35
# Saturation vapour pressure over water (Sonntag 1990): of 1/T, 1, T, T T and log T.
SATURATION = (-6096.9385, 16.635794, -2.711193e-2, 1.673952e-5, 2.433502)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(c: Column | str) -> Column:
    """NaN as null: rasters use NaN for missing, Spark treats it as a number."""
    c = col(c)
    return F.when(F.isnan(c), None).otherwise(c)


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def wrap_degrees(c) -> Column:
    """Degrees in [0, 360), with the sign of the divisor."""
    return F.pmod(col(c), F.lit(360.0))


def wind_class(degrees) -> Column:
    """0 (N) to 7 (NW): eight sectors of 45 degrees, lower edges included; missing stays missing."""
    return F.floor(F.pmod(col(degrees) + F.lit(22.5), F.lit(360.0)) / F.lit(45.0)).cast("int")


def wind_label(code) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), col(code).cast("int") + 1)


def equilibrium_moisture(rh, temperature_f) -> Column:
    """Fosberg's equilibrium moisture content; null outside 0 to 100 percent."""
    h, t = col(rh), col(temperature_f)
    a, b, c = map(F.lit, MOISTURE_DRY)
    dry = a + b * h + c * h * t
    a, b, c = map(F.lit, MOISTURE_MIDDLE)
    middle = a + b * h + c * t
    a, b, c, d = map(F.lit, MOISTURE_MOIST)
    moist = a + b * h * h + c * h * t + d * h
    return F.when(h < 10, dry).when((h >= 10) & (h <= 50), middle).when((h > 50) & (h <= 100), moist)


def fosberg_index(rh, temperature_f, wind) -> Column:
    """Fire-weather index of relative humidity (percent), temperature (F) and wind (m/s)."""
    m = equilibrium_moisture(rh, temperature_f) / F.lit(30.0)
    a, b, c, d = map(F.lit, DAMPING)
    damping = a + b * m + c * m * m + d * m * m * m
    return damping * F.sqrt(F.lit(1.0) + col(wind) * col(wind))


def red_flag(rh, wind) -> Column:
    """Dry and windy by the older rule: humidity below 15 percent and gusts (1.4 times wind) above 35."""
    return (col(rh) < RED_FLAG_HUMIDITY) & (F.lit(RED_FLAG_GUST_FACTOR) * col(wind) > RED_FLAG_WIND)


def kelvin_to_fahrenheit(k) -> Column:
    return (col(k) - F.lit(273.15)) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)


def saturation_pressure(kelvin) -> Column:
    """Saturation vapour pressure over water in Pa (Sonntag 1990)."""
    t = col(kelvin)
    a, b, c, d, e = map(F.lit, SATURATION)
    return F.lit(100.0) * F.exp(a / t + b + c * t + d * t * t + e * F.log(t))


def relative_humidity(kelvin, dew_point_kelvin) -> Column:
    """Percent, held to [0, 100]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) * saturation_pressure(dew_point_kelvin) / saturation_pressure(kelvin)))


def rotate_wind(u, v, sin_alpha, cos_alpha) -> tuple[Column, Column]:
    """Grid-relative wind turned to earth-relative."""
    u, v, s, c = (col(x) for x in (u, v, sin_alpha, cos_alpha))
    return u * c - v * s, v * c + u * s


def wind_speed(u, v) -> Column:
    return F.sqrt(col(u) * col(u) + col(v) * col(v))


def wind_from(u, v, calm: float = 0.5) -> Column:
    """Degrees that the wind blows from: 0 if calm, 360 for due north."""
    degrees = F.pmod(F.lit(180.0) + F.degrees(F.atan2(col(u), col(v))), F.lit(360.0))
    return F.when(wind_speed(u, v) < F.lit(calm), F.lit(0.0)).when(degrees == 0, F.lit(360.0)).otherwise(degrees)


def cell_area_km2(lat, dlat: float, dlon: float) -> Column:
    """Area of a cell of dlat by dlon degrees."""
    scale = EARTH_RADIUS_M * EARTH_RADIUS_M / 1e6
    return F.lit(scale) * F.radians(F.lit(dlat)) * F.radians(F.lit(dlon)) * F.cos(F.radians(col(lat)))


def at_least(c, least: float = 0.0) -> Column:
    """Clip from below; missing stays missing, unlike ``greatest``."""
    return F.when(col(c).isNotNull(), F.greatest(col(c), F.lit(least)))


def mercator_to_degrees(x, y) -> tuple[Column, Column]:
    """(lon, lat) of spherical Mercator metres."""
    lon = F.degrees(col(x) / F.lit(MERCATOR_RADIUS_M))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(col(y) / F.lit(MERCATOR_RADIUS_M)))) - F.lit(90.0)
    return lon, lat


def risk_score(risk, closed: str = "right") -> Column:
    """Score 0 to 10 of a risk value.

    0 is zero risk. ``right``: (previous edge, edge], as the statistics count; ``left``:
    [previous edge, edge), as the score table is published. Edges are single precision.
    """
    x = col(risk)
    out = F.when(x == 0, F.lit(0))
    for k, edge in enumerate(SCORE_EDGES):
        top = F.lit(edge).cast("float")
        out = out.when(x <= top if closed == "right" else x < top, F.lit(k + 1))
    return out.otherwise(F.when(x.isNotNull(), F.lit(len(SCORE_EDGES))) if closed == "left" else F.lit(None))


def bin_counts(c, edges: Sequence[float], closed: str = "right") -> Column:
    """An aggregate: array of counts by bin. ``right``: first bin takes all up to its edge; ``left``: numpy's bins."""
    x, e = col(c), [F.lit(v).cast("float") for v in edges]
    if closed == "right":
        lows = [None, *e[:-1]]
        return F.array(*[F.count_if((x <= hi) if lo is None else (x > lo) & (x <= hi)) for lo, hi in zip(lows, e, strict=True)])
    last = len(e) - 2
    return F.array(*[F.count_if((x >= e[k]) & ((x <= e[k + 1]) if k == last else (x < e[k + 1]))) for k in range(len(e) - 1)])


def score_histogram(risk) -> Column:
    """An aggregate: counts of scores 0 to 10 (zero risk, then the right-closed bins of the rest)."""
    rest = F.when(col(risk) != 0, col(risk))
    return F.concat(F.array(F.count_if(col(risk) == 0)), bin_counts(rest, SCORE_EDGES))


def resize(array, n: int, fill: Column) -> Column:
    """Array cut or filled to n entries."""
    return F.slice(F.concat(col(array), F.array_repeat(fill, n)), 1, n)


def first_argmax(array) -> Column:
    """0-based place of the first largest entry."""
    return (F.array_position(col(array), F.array_max(col(array))) - 1).cast("int")


def region_id(iy, ix) -> Column:
    return F.format_string("y%d_x%d", col(iy).cast("int"), col(ix).cast("int"))


def parse_region_id(c) -> tuple[Column, Column]:
    return tuple(F.regexp_extract(col(c), r"^y(\d+)_x(\d+)$", k).cast("int") for k in (1, 2))


def message_region(c) -> Column:
    """The region named in parentheses in a ledger message."""
    return F.regexp_extract(col(c), r"\(([^)]*)\)", 1)


def to_json(*columns: Column) -> Column:
    """JSON of the columns, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def nearest_index(value, origin: float, step: float, n: int) -> Column:
    """Index of the nearest cell centre along an axis, held to the grid; halves go up."""
    index = F.floor((col(value) - F.lit(origin)) / F.lit(step) + F.lit(0.5))
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), index)).cast("int")
