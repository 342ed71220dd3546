"""Geometry on WKB: a small codec in NumPy, and Arrow UDFs over it.

Points, lines, polygons and their multi forms, little or big endian, 2-D. Planar
arithmetic throughout: the callers' coordinates are degrees or metres as they are.
"""

from __future__ import annotations

import json
import math
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, StringType, StructField, StructType

NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
CODES = {name.upper(): code for code, name in NAMES.items()}
BBOX = StructType([StructField(c, DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])
XY = StructType([StructField(c, DoubleType()) for c in ("x", "y")])


# ------------------------------------------------------------------ codec


def read_wkb(raw: bytes) -> tuple[str, list]:
    """(type name, coordinates): nested like GeoJSON's, rings as (n, 2) arrays."""
    geometry, _ = _read(memoryview(raw), 0)
    return geometry


def _read(raw: memoryview, at: int) -> tuple[tuple[str, list], int]:
    order = "<" if raw[at] == 1 else ">"
    code = struct.unpack_from(order + "I", raw, at + 1)[0]
    at += 5

    def count():
        nonlocal at
        at += 4
        return struct.unpack_from(order + "I", raw, at - 4)[0]

    def line(n):
        nonlocal at
        out = np.frombuffer(raw, order + "f8", 2 * n, at).reshape(n, 2).astype(float)
        at += 16 * n
        return out

    if code not in NAMES:
        raise ValueError(f"geometry type {code} is not supported")
    if code == 1:
        return ("Point", line(1)[0]), at
    if code == 2:
        return ("LineString", line(count())), at
    if code == 3:
        return ("Polygon", [line(count()) for _ in range(count())]), at
    parts = []
    for _ in range(count()):
        (_, part), at = _read(raw, at)
        parts.append(part)
    return (NAMES[code], parts), at


def write_wkb(name: str, coordinates) -> bytes:
    code = CODES[name.upper()]
    head = struct.pack("<BI", 1, code)
    flat = lambda a: np.asarray(a, "<f8").tobytes()
    if code == 1:
        return head + flat(coordinates)
    if code == 2:
        return head + struct.pack("<I", len(coordinates)) + flat(coordinates)
    if code == 3:
        return head + struct.pack("<I", len(coordinates)) + b"".join(struct.pack("<I", len(r)) + flat(r) for r in coordinates)
    inner = NAMES[code - 3]
    return head + struct.pack("<I", len(coordinates)) + b"".join(write_wkb(inner, c) for c in coordinates)


def box(xmin: float, ymin: float, xmax: float, ymax: float) -> bytes:
    return write_wkb("Polygon", [[(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]])


def to_wkt(raw: bytes) -> str:
    def text(c, depth):
        if depth == 0:
            return f"{c[0]:.15g} {c[1]:.15g}"
        return "(" + ", ".join(text(x, depth - 1) for x in c) + ")"

    name, coordinates = read_wkb(raw)
    depth = {"Point": 0, "LineString": 1, "Polygon": 2, "MultiPoint": 1, "MultiLineString": 2, "MultiPolygon": 3}[name]
    body = text(coordinates, depth)
    return f"{name.upper()} {body if depth else f'({body})'}"


def from_wkt(text: str) -> bytes:
    name, body = re.fullmatch(r"\s*([A-Za-z]+)\s*(\(.*\))\s*", text, re.S).groups()
    number = r"-?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
    # Points become lists first; brackets then nest as in JSON.
    points = re.sub(rf"({number})\s+({number})", r"[\1,\2]", body.replace("(", "[").replace(")", "]"))
    points = re.sub(r"(?<=\[)\.|(?<=,)\.", "0.", points)
    coordinates = json.loads(points)
    if name.upper() == "POINT":
        coordinates = coordinates[0]
    if name.upper() == "MULTIPOINT":
        coordinates = [c[0] if isinstance(c[0], list) else c for c in coordinates]
    return write_wkb(name, coordinates)


def to_geojson(raw: bytes) -> str:
    def plain(c):
        return c.tolist() if isinstance(c, np.ndarray) else [plain(x) for x in c]

    name, coordinates = read_wkb(raw)
    return json.dumps({"type": name, "coordinates": plain(coordinates)}, separators=(",", ":"))


# ------------------------------------------------------------- measurements


def _polygons(geometry) -> list:
    name, coordinates = geometry
    return [coordinates] if name == "Polygon" else coordinates if name == "MultiPolygon" else []


def _points(geometry) -> np.ndarray:
    name, c = geometry
    if name == "Point":
        return np.asarray([c])
    if name == "LineString":
        return c
    if name == "MultiPoint":
        return np.asarray(c).reshape(-1, 2)
    if name == "MultiLineString":
        return np.vstack(c)
    return np.vstack([ring for polygon in _polygons(geometry) for ring in polygon])


def bbox(raw: bytes) -> tuple[float, float, float, float]:
    p = _points(read_wkb(raw))
    return (*p.min(axis=0).tolist(), *p.max(axis=0).tolist())


def _ring_moments(ring: np.ndarray) -> tuple[float, float, float]:
    """Signed area and first moments about the ring's first point."""
    r = ring - ring[0]
    x, y = r[:, 0], r[:, 1]
    cross = x[:-1] * y[1:] - x[1:] * y[:-1]
    area = cross.sum() / 2
    return area, ((x[:-1] + x[1:]) * cross).sum() / 6 + area * ring[0, 0], ((y[:-1] + y[1:]) * cross).sum() / 6 + area * ring[0, 1]


def area(raw: bytes) -> float:
    total = 0.0
    for polygon in _polygons(read_wkb(raw)):
        for k, ring in enumerate(polygon):
            total += (1 if k == 0 else -1) * abs(_ring_moments(ring)[0])
    return total


def centroid(raw: bytes) -> tuple[float, float]:
    """Area-weighted centre; holes subtract; without area, the mean of the points (segments' for lines)."""
    geometry = read_wkb(raw)
    total = mx = my = 0.0
    for polygon in _polygons(geometry):
        for k, ring in enumerate(polygon):
            a, x, y = _ring_moments(ring)
            sign = (1 if a >= 0 else -1) * (1 if k == 0 else -1)
            total, mx, my = total + sign * a, mx + sign * x, my + sign * y
    if total:
        return mx / total, my / total
    if geometry[0] in ("LineString", "MultiLineString"):
        lines = [geometry[1]] if geometry[0] == "LineString" else geometry[1]
        lengths = np.concatenate([np.linalg.norm(np.diff(g, axis=0), axis=1) for g in lines])
        if lengths.sum():
            middles = np.vstack([(g[:-1] + g[1:]) / 2 for g in lines])
            return tuple((middles * lengths[:, None]).sum(axis=0) / lengths.sum())
    return tuple(_points(geometry).mean(axis=0))


def contains(geometry, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points are in the polygon(s) by the even-odd rule, boundaries included."""
    inside, edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for polygon in _polygons(geometry):
        odd = np.zeros(len(x), bool)
        for ring in polygon:
            for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
                cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
                edge |= (cross == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
                if y1 != y2:
                    straddles = (y1 > y) != (y2 > y)
                    odd ^= straddles & ((cross > 0) == (y2 > y1))
        inside |= odd
    return inside | edge


def _segments(geometry) -> np.ndarray:
    return np.vstack([np.hstack([ring[:-1], ring[1:]]) for polygon in _polygons(geometry) for ring in polygon])


def polygons_intersect(a, b) -> bool:
    """True if the polygons share a point: crossing or touching edges, or one within the other."""
    s, t = _segments(a), _segments(b)

    def side(p, q):
        """Cross products of the segments p with both ends of the segments q."""
        d = p[:, None, 2:] - p[:, None, :2]
        u, v = q[None, :, :2] - p[:, None, :2], q[None, :, 2:] - p[:, None, :2]
        return d[..., 0] * u[..., 1] - d[..., 1] * u[..., 0], d[..., 0] * v[..., 1] - d[..., 1] * v[..., 0]

    s1, s2 = side(s, t)
    t1, t2 = side(t, s)
    apart = np.zeros(s1.shape, bool)
    for k in (0, 1):
        apart |= np.maximum(s[:, None, k], s[:, None, k + 2]) < np.minimum(t[None, :, k], t[None, :, k + 2])
        apart |= np.maximum(t[None, :, k], t[None, :, k + 2]) < np.minimum(s[:, None, k], s[:, None, k + 2])
    if (~apart & (np.sign(s1) * np.sign(s2) <= 0) & (np.sign(t1) * np.sign(t2) <= 0).T).any():
        return True
    first = lambda g: _polygons(g)[0][0][:1]
    p, q = first(a), first(b)
    return bool(contains(a, q[:, 0], q[:, 1])[0] or contains(b, p[:, 0], p[:, 1])[0])


def clip_to_box(raw: bytes, xmin: float, ymin: float, xmax: float, ymax: float) -> bytes | None:
    """Polygons clipped to a box by its four half planes; None if nothing is left."""
    def half(ring, axis, limit, sign):
        out = []
        for p, q in zip(ring, np.roll(ring, -1, axis=0), strict=True):
            dp, dq = sign * (p[axis] - limit), sign * (q[axis] - limit)
            if dp >= 0:
                out.append(p)
            if dp * dq < 0:
                out.append(p + (q - p) * (dp / (dp - dq)))
        return np.array(out).reshape(-1, 2)

    kept = []
    for polygon in _polygons(read_wkb(raw)):
        rings = []
        for ring in polygon:
            r = ring[:-1]
            for axis, limit, sign in ((0, xmin, 1), (0, xmax, -1), (1, ymin, 1), (1, ymax, -1)):
                r = half(r, axis, limit, sign) if len(r) else r
            if len(r) >= 3 and abs(_ring_moments(np.vstack([r, r[:1]]))[0]) > 0:
                rings.append(np.vstack([r, r[:1]]))
            elif not rings:
                break
        if rings:
            kept.append(rings)
    if not kept:
        return None
    return write_wkb("Polygon", kept[0]) if len(kept) == 1 else write_wkb("MultiPolygon", kept)


# --------------------------------------------------------------- projection

# GRS80 and the parameters of the equal-area projection of the lower 48 states.
_A, _F = 6378137.0, 1 / 298.257222101
_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)
_LAT1, _LAT2, _LAT0, _LON0 = (math.radians(d) for d in (29.5, 45.5, 23.0, -96.0))


def _q(lat):
    s = np.sin(lat)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - np.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m(lat):
    return np.cos(lat) / np.sqrt(1 - _E2 * np.sin(lat) ** 2)


_N = (_m(_LAT1) ** 2 - _m(_LAT2) ** 2) / (_q(_LAT2) - _q(_LAT1))
_C = _m(_LAT1) ** 2 + _N * _q(_LAT1)
_RHO0 = _A * math.sqrt(_C - _N * _q(_LAT0)) / _N


def to_albers(lon, lat) -> tuple[np.ndarray, np.ndarray]:
    """Degrees to equal-area metres (ellipsoidal, two standard parallels)."""
    lon, lat = np.radians(np.asarray(lon, float)), np.radians(np.asarray(lat, float))
    rho = _A * np.sqrt(_C - _N * _q(lat)) / _N
    theta = _N * (lon - _LON0)
    return rho * np.sin(theta), _RHO0 - rho * np.cos(theta)


def from_albers(x, y) -> tuple[np.ndarray, np.ndarray]:
    """Equal-area metres to degrees; the latitude by Newton's steps on the authalic function."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    rho = np.hypot(x, _RHO0 - y)
    q = (_C - (rho * _N / _A) ** 2) / _N
    lat = np.arcsin(np.clip(q / 2, -1, 1))
    for _ in range(8):
        s = np.sin(lat)
        lat = lat + (1 - _E2 * s * s) ** 2 / (2 * np.cos(lat)) * (q - _q(lat)) / (1 - _E2)
    return np.degrees(_LON0 + np.arctan2(x, _RHO0 - y) / _N), np.degrees(lat)


#: Sphere of the web map's projection, in metres (fixed value).
_WEB = 6378137.0


def to_mercator(lon, lat) -> tuple[np.ndarray, np.ndarray]:
    lon, lat = np.radians(np.asarray(lon, float)), np.radians(np.asarray(lat, float))
    return _WEB * lon, _WEB * np.arctanh(np.sin(lat))


def from_mercator(x, y) -> tuple[np.ndarray, np.ndarray]:
    return np.degrees(np.asarray(x, float) / _WEB), np.degrees(np.arctan(np.sinh(np.asarray(y, float) / _WEB)))


def _same(x, y):
    return x, y


TO_DEGREES = {4326: _same, 4269: _same, 5070: from_albers, 3857: from_mercator}
FROM_DEGREES = {4326: _same, 4269: _same, 5070: to_albers, 3857: to_mercator}

# ---------------------------------------------------------------------- UDFs


@F.pandas_udf(BBOX)
def bbox_udf(wkb: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([bbox(g) if g is not None else (None,) * 4 for g in wkb], columns=[f.name for f in BBOX])


@F.pandas_udf(XY)
def centroid_udf(wkb: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([centroid(g) if g is not None else (None, None) for g in wkb], columns=["x", "y"])


@F.pandas_udf(DoubleType())
def area_udf(wkb: pd.Series) -> pd.Series:
    return wkb.map(area, na_action="ignore").astype(float)


@F.pandas_udf(StringType())
def wkt_udf(wkb: pd.Series) -> pd.Series:
    return wkb.map(to_wkt, na_action="ignore")


@F.pandas_udf(BinaryType())
def from_wkt_udf(text: pd.Series) -> pd.Series:
    return text.map(from_wkt, na_action="ignore")


@F.pandas_udf(StringType())
def geojson_udf(wkb: pd.Series) -> pd.Series:
    return wkb.map(to_geojson, na_action="ignore")


@F.pandas_udf(BooleanType())
def contains_udf(wkb: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    """Point in polygon; equal geometries of a batch are decoded once and tested together."""
    out = np.zeros(len(wkb), bool)
    px, py = x.to_numpy(float), y.to_numpy(float)
    for raw, at in wkb.groupby(wkb).indices.items():
        out[at] = contains(read_wkb(raw), px[at], py[at])
    return pd.Series(out)


@F.pandas_udf(BooleanType())
def intersects_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([p is not None and q is not None and polygons_intersect(read_wkb(p), read_wkb(q)) for p, q in zip(a, b, strict=True)])


@F.pandas_udf(XY)
def to_albers_udf(lon: pd.Series, lat: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(dict(zip("xy", to_albers(lon, lat), strict=True)))


@F.pandas_udf(XY)
def from_albers_udf(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(dict(zip("xy", from_albers(x, y), strict=True)))


def clip_udf(xmin: float, ymin: float, xmax: float, ymax: float):
    @F.pandas_udf(BinaryType())
    def clip(wkb: pd.Series) -> pd.Series:
        return wkb.map(lambda g: clip_to_box(g, xmin, ymin, xmax, ymax), na_action="ignore")

    return clip


def reproject(raw: bytes, source: int, target: int) -> bytes:
    """Coordinates of a shape from one reference system (EPSG code) to another, by way of degrees."""
    name, coordinates = read_wkb(raw)

    def move(c):
        if isinstance(c, list):
            return [move(x) for x in c]
        a = np.atleast_2d(np.asarray(c, float))
        x, y = TO_DEGREES[source](a[:, 0], a[:, 1])
        x, y = FROM_DEGREES[target](x, y)
        moved = np.stack([x, y], axis=1)
        return moved if np.ndim(c) == 2 else moved[0]

    return write_wkb(name, move(coordinates))


def reproject_udf(source: int, target: int):
    if source not in TO_DEGREES or target not in FROM_DEGREES:
        raise ValueError(f"no way from EPSG:{source} to EPSG:{target}")

    @F.pandas_udf(BinaryType())
    def run(wkb: pd.Series) -> pd.Series:
        return wkb.map(lambda g: reproject(g, source, target), na_action="ignore")

    return run


@F.pandas_udf(BinaryType())
def _point_wkb_udf(px: pd.Series, py: pd.Series) -> pd.Series:
    head = np.frombuffer(struct.pack("<BI", 1, 1), np.uint8)
    raw = np.empty((len(px), 21), np.uint8)
    raw[:, :5] = head
    raw[:, 5:] = np.stack([px.to_numpy("<f8"), py.to_numpy("<f8")], axis=1).view(np.uint8).reshape(-1, 16)
    return pd.Series(raw.reshape(-1).view("V21").tolist(), dtype=object)


def point_wkb(x, y):
    """WKB of a point as a Column: order byte and type, then the two doubles, low byte first; filled for a whole batch at once."""
    return _point_wkb_udf(x, y)
