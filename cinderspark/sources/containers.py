"""Readers of vector and raster containers: zipped shapefiles, GeoPackages, GeoTIFFs.

The driver reads headers only (names, types, sizes). Executors read the records: a shapefile is one
task and streamed, a GeoPackage is cut by row ids, a GeoTIFF by its own blocks.
"""

from __future__ import annotations

import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cinderspark.functions import geo
from cinderspark.sources.files import open_fs
from cinderspark.sources.readers import nan_to_null

BATCH = 2048


def _open(where: str):
    fs, path = open_fs(where)
    return fs.open_input_file(path)


def _batches(rows: Iterator[tuple], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pd.DataFrame(held, columns=list(names), dtype=object)
            held = []
    if held:
        yield pd.DataFrame(held, columns=list(names), dtype=object)


# ------------------------------------------------------------- shapefiles


class _Field(NamedTuple):
    name: str
    kind: str
    length: int
    decimals: int

    @property
    def type(self) -> str:
        if self.kind in "NF":
            return "long" if self.kind == "N" and self.decimals == 0 else "double"
        return "boolean" if self.kind == "L" else "string"

    def value(self, raw: bytes, encoding: str):
        text = raw.decode(encoding, "replace").strip(" \x00")
        if self.type == "string":
            return text or None
        if self.type == "boolean":
            return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
        if not text or text.strip("*") == "":
            return None
        return int(text) if self.type == "long" else float(text)


def _dbf_header(f) -> tuple[int, int, list[_Field]]:
    """(records, bytes of one, fields); ``f`` then stands at the first record."""
    n, head, size = struct.unpack("<4xIHH20x", f.read(32))
    table = f.read(head - 32)
    fields = []
    for at in range(0, len(table) - 31, 32):
        if table[at] == 0x0D:
            break
        name, kind, length, decimals = struct.unpack_from("<11sc4xBB", table, at)
        fields.append(_Field(name.split(b"\0")[0].decode("latin-1"), kind.decode("latin-1"), length, decimals))
    return n, size, fields


def _rings(raw: bytes) -> list[np.ndarray]:
    parts, points = struct.unpack_from("<II", raw, 36)
    starts = [*struct.unpack_from(f"<{parts}I", raw, 44), points]
    xy = np.frombuffer(raw, "<f8", 2 * points, 44 + 4 * parts).reshape(points, 2)
    return [xy[a:b] for a, b in zip(starts, starts[1:], strict=False) if b > a]


def _polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Outer rings run clockwise; each hole goes to the outer ring around it."""
    twice = [float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()) for r in rings]
    out = [[r] for r, a in zip(rings, twice, strict=True) if a <= 0]
    for hole in (r for r, a in zip(rings, twice, strict=True) if a > 0):
        middle = hole[:-1].mean(axis=0)
        home = next((p for p in out for at in (hole[0], middle) if geo.contains(("Polygon", [p[0]]), np.array([at[0]]), np.array([at[1]]))[0]), None)
        out.append([hole]) if home is None else home.append(hole)
    return out


def shape_wkb(raw: bytes) -> bytes | None:
    """WKB of one shapefile record; measures and heights are left out. None for null shapes."""
    kind = struct.unpack_from("<I", raw)[0] % 10
    if kind == 0:
        return None
    if kind == 1:
        return geo.write_wkb("Point", struct.unpack_from("<2d", raw, 4))
    if kind == 8:
        n = struct.unpack_from("<I", raw, 36)[0]
        return geo.write_wkb("MultiPoint", np.frombuffer(raw, "<f8", 2 * n, 40).reshape(n, 2))
    rings = _rings(raw)
    if kind == 3:
        return geo.write_wkb("LineString", rings[0]) if len(rings) == 1 else geo.write_wkb("MultiLineString", rings)
    if kind == 5:
        found = _polygons(rings)
        return geo.write_wkb("Polygon", found[0]) if len(found) == 1 else geo.write_wkb("MultiPolygon", found)
    raise ValueError(f"shape type {kind} is not supported")


def _members(z: zipfile.ZipFile, layer: str | None) -> tuple[str, str, str | None]:
    names = {n.lower(): n for n in z.namelist()}
    found = sorted(n for n in names if n.endswith(".shp") and (layer is None or n.rsplit("/", 1)[-1] == f"{layer.lower()}.shp"))
    if len(found) != 1:
        raise ValueError(f"one layer is to be named out of {found}")
    stem = found[0][:-4]
    return names[found[0]], names[f"{stem}.dbf"], names.get(f"{stem}.cpg")


def shapefiles(spark: SparkSession, paths: Sequence[str], layer: str | None = None) -> DataFrame:
    """All records of zipped shapefiles with equal columns, with WKB ``geometry``; deleted records are left out.

    A zip is one task, whose records are streamed: memory holds a few of them.
    """
    with _open(paths[0]) as f, zipfile.ZipFile(f) as z, z.open(_members(z, layer)[1]) as table:
        fields = _dbf_header(table)[2]

    def records(path: str) -> Iterator[tuple]:
        with _open(path) as f, zipfile.ZipFile(f) as z:
            shapes, attributes, page = _members(z, layer)
            encoding = z.read(page).decode("ascii").strip() if page else "utf-8"
            encoding = f"cp{encoding}" if encoding.isdigit() else encoding
            with z.open(shapes) as shp, z.open(attributes) as dbf:
                n, size, own = _dbf_header(dbf)
                if own != fields and [x.name for x in own] != [x.name for x in fields]:
                    raise ValueError(f"{path} has other columns")
                shp.read(100)
                for _ in range(n):
                    row, head = dbf.read(size), shp.read(8)
                    if len(head) < 8:
                        raise ValueError(f"{path} has fewer shapes than records")
                    shape = shp.read(2 * struct.unpack(">4xI", head)[0])
                    if row[:1] == b"*":
                        continue
                    at, values = 1, []
                    for x in own:
                        values.append(x.value(row[at : at + x.length], encoding))
                        at += x.length
                    yield (*values, shape_wkb(shape))

    names = [*(x.name for x in fields), "geometry"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield from _batches(records(path), names)

    schema = ", ".join([*(f"`{x.name}` {x.type}" for x in fields), "geometry binary"])
    return _one_task_each(spark, [(p,) for p in paths], "path string").mapInPandas(run, schema)


def _one_task_each(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema)


# ------------------------------------------------------------- GeoPackages


def _database(where: str) -> sqlite3.Connection:
    """A database opened for reading: local files in place, others from memory."""
    fs, path = open_fs(where)
    if fs.type_name == "local":
        from urllib.parse import quote

        return sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)
    found = sqlite3.connect(":memory:")
    with fs.open_input_stream(path) as f:
        found.deserialize(f.read())
    return found


def geopackage_wkb(raw: bytes | None) -> bytes | None:
    """The WKB after a GeoPackage's header; None for empty shapes."""
    if raw is None or raw[:2] != b"GP" or raw[3] & 0x10:
        return None
    envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[raw[3] >> 1 & 7]
    return bytes(raw[8 + envelope :])


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def geopackage(spark: SparkSession, where: str, layer: str | None = None, rows_per_task: int = 100_000) -> DataFrame:
    """A layer's rows with WKB ``geometry``, cut into tasks by row id; a file that is not local must fit in a worker's memory."""
    kinds = {"INT": "long", "REA": "double", "DOU": "double", "FLO": "double", "BOO": "boolean", "BLO": "binary"}
    db = _database(where)
    try:
        layers = dict(db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall())
        if layer is None and len(layers) != 1:
            raise ValueError(f"one layer is to be named out of {sorted(layers)}")
        layer = layer or next(iter(layers))
        shape = layers[layer]
        info = db.execute(f"PRAGMA table_info({_quoted(layer)})").fetchall()
        first, last = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(layer)}").fetchone()
    finally:
        db.close()
    columns = [(r[1], "long" if "INT" in r[2].upper() else kinds.get(r[2].upper()[:3], "string")) for r in info if r[1] != shape]
    casts = {"long": int, "double": float, "boolean": bool, "string": str, "binary": bytes}
    names = [*(c for c, _ in columns), "geometry"]
    sql = f"SELECT {', '.join(_quoted(c) for c in [*names[:-1], shape])} FROM {_quoted(layer)} WHERE rowid BETWEEN ? AND ?"

    def records(a: int, b: int) -> Iterator[tuple]:
        found = _database(where)
        try:
            for row in found.execute(sql, (int(a), int(b))):
                yield (*(None if v is None else casts[k](v) for v, (_, k) in zip(row, columns, strict=False)), geopackage_wkb(row[-1]))
        finally:
            found.close()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in batch.itertuples(index=False):
                yield from _batches(records(a, b), names)

    starts = range(first, last + 1, rows_per_task) if first is not None else ()
    schema = ", ".join([*(f"`{c}` {k}" for c, k in columns), "geometry binary"])
    ranges = [(a, min(a + rows_per_task - 1, last)) for a in starts]
    return _one_task_each(spark, ranges, "a long, b long").mapInPandas(run, schema)


# ---------------------------------------------------------------- GeoTIFF

#: Bytes and NumPy letters of the format's value types (fixed values).
TYPES = {1: "u1", 2: "u1", 3: "u2", 4: "u4", 6: "i1", 8: "i2", 9: "i4", 11: "f4", 12: "f8", 16: "u8", 17: "i8"}


class Raster(NamedTuple):
    """What a file's first image says of itself; block places are left in the file."""

    order: str
    ny: int
    nx: int
    height: int
    width: int
    tiled: bool
    dtype: str
    compression: int
    predictor: int
    samples: int
    offsets: tuple[int, str]
    counts: tuple[int, str]
    nodata: float | None
    lon0: float
    lat0: float
    dlon: float
    dlat: float


def describe_tiff(where: str) -> Raster:
    """Reads the header; north-up images with a pixel scale and one tie point, samples side by side."""
    with _open(where) as f:
        mark = f.read(8)
        order = {b"II": "<", b"MM": ">"}[mark[:2]]
        big = struct.unpack_from(order + "H", mark, 2)[0] == 43
        start = struct.unpack(order + "Q", f.read(8))[0] if big else struct.unpack_from(order + "I", mark, 4)[0]
        f.seek(start)
        n = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
        size, slot = (20, 8) if big else (12, 4)
        base, table = f.tell(), f.read(n * size)
        places = {}
        for k in range(n):
            tag, kind = struct.unpack_from(order + "HH", table, k * size)
            count = struct.unpack_from(order + ("Q" if big else "I"), table, k * size + 4)[0]
            if kind not in TYPES:
                continue
            width = np.dtype(TYPES[kind]).itemsize * count
            at = base + k * size + size - slot if width <= slot else struct.unpack_from(order + ("Q" if big else "I"), table, k * size + size - slot)[0]
            places[tag] = (at, order + TYPES[kind], count)

        def values(tag: int, default=None):
            if tag not in places:
                return default
            at, kind, count = places[tag]
            f.seek(at)
            return np.frombuffer(f.read(np.dtype(kind).itemsize * count), kind)

        one = lambda tag, default: int(values(tag, [default])[0])
        nx, ny, tiled = one(256, 0), one(257, 0), 324 in places
        scale, tie = values(33550), values(33922)
        if scale is None or tie is None or one(284, 1) != 1 and one(277, 1) > 1:
            raise ValueError(f"{where}: only placed images with their samples side by side are read")
        text = values(42113)
        letter = {1: "u", 2: "i", 3: "f"}[one(339, 1)]
        shift = 0.0 if _area(values(34735)) else 0.5
        return Raster(
            order, ny, nx, one(323, 0) if tiled else min(one(278, ny), ny), one(322, 0) if tiled else nx, tiled, f"{order}{letter}{one(258, 1) // 8}",
            one(259, 1), one(317, 1), one(277, 1), places[324 if tiled else 273][:2], places[325 if tiled else 279][:2],
            float(text.tobytes().strip(b"\0 ").decode()) if text is not None else None,
            float(tie[3] - (tie[0] + shift) * scale[0]), float(tie[4] + (tie[1] + shift) * scale[1]), float(scale[0]), -float(scale[1]),
        )


def _area(keys: np.ndarray | None) -> bool:
    """False if the tie point is a cell's centre (key 1025 is 2), else it is a corner."""
    rows = keys.reshape(-1, 4)[1:] if keys is not None else ()
    return not any(k == 1025 and v == 2 for k, _, _, v in rows)


def _lzw(raw: bytes) -> bytes:
    """The format's LZW: codes of 9 to 12 bits, high bits first; 256 clears, 257 ends."""
    out, held, bits, width, at = [], 0, 0, 9, 0
    start = [bytes([k]) for k in range(256)] + [b"", b""]
    table, last = list(start), b""
    while True:
        while bits < width and at < len(raw):
            held, bits, at = (held << 8 | raw[at]) & 0xFFFFFFFF, bits + 8, at + 1
        if bits < width:
            break
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, last, width = list(start), b"", 9
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        # The writer's table is one entry ahead of this one.
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def _block(r: Raster, raw: bytes, rows: int) -> np.ndarray:
    """(rows, width, samples) of one block's bytes."""
    kind, shape = np.dtype(r.dtype), (rows, r.width, r.samples)
    if r.compression in (8, 32946):
        raw = zlib.decompress(raw)
    elif r.compression == 5:
        raw = _lzw(raw)
    elif r.compression == 50000:
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=int(np.prod(shape)) * kind.itemsize)
    elif r.compression != 1:
        raise ValueError(f"compression {r.compression} is not read")
    size = int(np.prod(shape))
    if r.predictor == 3:  # differences of bytes, the high bytes of a row first
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize).reshape(rows, -1)
        planes = np.cumsum(planes.reshape(rows, -1, r.samples), axis=1, dtype=np.uint8).reshape(rows, kind.itemsize, -1)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{kind.itemsize}").reshape(shape)
    values = np.frombuffer(raw, kind, size).reshape(shape)
    if r.predictor == 2:
        return np.cumsum(values.astype(kind.newbyteorder("=")), axis=1, dtype=kind.newbyteorder("="))
    return values


def geotiff_pixels(spark: SparkSession, where: str, names: Sequence[str], blocks_per_task: int = 16, keep_missing: bool = False) -> DataFrame:
    """iy, ix, lon, lat (a cell's centre, row 0 in the north) and one column a band; no-data and NaN are null.

    Blocks are dealt over tasks, and each is read by its own offset, so no task meets the whole file.
    ``names`` are the bands' columns. Pixels without any value are left out unless kept.
    """
    r = describe_tiff(where)
    if len(names) != r.samples:
        raise ValueError(f"{where} has {r.samples} bands")
    across = -(-r.nx // r.width)
    n = across * -(-r.ny // r.height)

    def entry(f, place: tuple[int, str], k: int) -> int:
        kind = np.dtype(place[1])
        f.seek(place[0] + k * kind.itemsize)
        return int(np.frombuffer(f.read(kind.itemsize), kind)[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with _open(where) as f:
                for k in map(int, batch["id"]):
                    iy0, ix0 = k // across * r.height, k % across * r.width
                    rows = r.height if r.tiled else min(r.height, r.ny - iy0)
                    size = entry(f, r.counts, k)
                    if size:
                        f.seek(entry(f, r.offsets, k))
                        block = _block(r, f.read(size), rows).astype(float)
                    else:  # a sparse file's block
                        block = np.full((rows, r.width, r.samples), np.nan)
                    block = block[: r.ny - iy0, : r.nx - ix0]
                    if r.nodata is not None:
                        block = np.where(block == np.dtype(r.dtype).type(r.nodata), np.nan, block)
                    band = max(1, 200_000 // block.shape[1])
                    for a in range(0, block.shape[0], band):
                        part = block[a : a + band]
                        iy, ix = np.mgrid[iy0 + a : iy0 + a + part.shape[0], ix0 : ix0 + part.shape[1]]
                        iy, ix = iy.ravel(), ix.ravel()
                        found = pd.DataFrame({"iy": iy, "ix": ix, "lon": r.lon0 + (ix + 0.5) * r.dlon, "lat": r.lat0 + (iy + 0.5) * r.dlat})
                        for b, name in enumerate(names):
                            found[name] = part[:, :, b].ravel()
                        yield found if keep_missing else found.dropna(subset=list(names), how="all")

    dealt = spark.range(0, n, 1, max(1, -(-n // blocks_per_task)))
    return nan_to_null(dealt.mapInPandas(run, ", ".join(["iy int", "ix int", "lon double", "lat double", *(f"`{c}` double" for c in names)])))
