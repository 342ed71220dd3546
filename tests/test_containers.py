import hashlib
import io
import json
import sqlite3
import struct
import zipfile
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.operators import grid, stats
from cinderspark.sources import arrays, containers, files, sinks
from cinderspark.sources.catalog import Dataset

OUTER = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]  # clockwise
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
FAR = [(10, 10), (10, 11), (11, 11), (11, 10), (10, 10)]


def _polygon(rings):
    starts = np.cumsum([0] + [len(r) for r in rings[:-1]])
    xy = np.array([p for r in rings for p in r], "<f8")
    return struct.pack("<I4d", 5, 0, 0, 0, 0) + struct.pack("<II", len(rings), len(xy)) + starts.astype("<u4").tobytes() + xy.tobytes()


def _shapefile(path, rows, layer="tracts"):
    """rows: (code, area, share, kept or deleted, record bytes)."""
    shp, dbf = io.BytesIO(), io.BytesIO()
    shp.write(b"\0" * 100)
    fields = [("GEOID", "C", 5, 0), ("ALAND", "N", 8, 0), ("SHARE", "N", 8, 3), ("URBAN", "L", 1, 0)]
    head, size = 32 + 32 * len(fields) + 1, 1 + sum(f[2] for f in fields)
    dbf.write(struct.pack("<4xIHH20x", len(rows), head, size))
    for name, kind, length, decimals in fields:
        dbf.write(struct.pack("<11sc4xBB14x", name.encode(), kind.encode(), length, decimals))
    dbf.write(b"\r")
    for k, (code, area, share, deleted, raw) in enumerate(rows):
        dbf.write((b"*" if deleted else b" ") + code.encode().ljust(5) + str(area if area is not None else "").rjust(8).encode() + f"{share:8.3f}".encode() + b"T")
        shp.write(struct.pack(">II", k + 1, len(raw) // 2) + raw)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"in/{layer}.shp", shp.getvalue())
        z.writestr(f"in/{layer}.dbf", dbf.getvalue())


def test_shapefiles(spark, tmp_path):
    a, b = str(tmp_path / "a.zip"), str(tmp_path / "b.zip")
    point = struct.pack("<Idd", 1, 1.5, 2.5)
    _shapefile(a, [("06037", 12, 0.5, False, _polygon([OUTER, HOLE, FAR])), ("06038", None, 0.25, False, struct.pack("<I", 0)), ("gone", 1, 0.0, True, point)])
    _shapefile(b, [("01001", 3, 0.125, False, point)])
    df = containers.shapefiles(spark, [a, b])
    assert dict(df.dtypes) == {"GEOID": "string", "ALAND": "bigint", "SHARE": "double", "URBAN": "boolean", "geometry": "binary"}
    rows = {r["GEOID"]: r for r in df.collect()}
    assert set(rows) == {"06037", "06038", "01001"} and rows["06038"]["ALAND"] is None and rows["06038"]["geometry"] is None
    name, parts = geo.read_wkb(bytes(rows["06037"]["geometry"]))
    assert name == "MultiPolygon" and [len(p) for p in parts] == [2, 1] and rows["06037"]["SHARE"] == 0.5 and rows["06037"]["URBAN"]
    assert geo.to_wkt(bytes(rows["01001"]["geometry"])) == "POINT (1.5 2.5)"
    with pytest.raises(ValueError):
        containers.shapefiles(spark, [a], layer="counties")


def test_geopackage(spark, tmp_path):
    path = tmp_path / "places one.gpkg"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name, column_name)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('fires', 'geom')")
    db.execute('CREATE TABLE fires (fid INTEGER PRIMARY KEY, geom BLOB, name TEXT, "burnt area" REAL, seen BOOLEAN)')
    shape = lambda flags, extra: b"GP\0" + bytes([flags]) + struct.pack("<i", 4326) + extra + geo.box(0, 0, 1, 1)
    db.executemany("INSERT INTO fires VALUES (?, ?, ?, ?, ?)", [(1, shape(1, b""), "a", 2, 1), (2, shape(3, b"\0" * 32), None, 2.5, 0), (9, shape(0x11, b""), "c", None, None), (10, None, "d", 1.0, 1)])
    db.commit()
    db.close()
    df = containers.geopackage(spark, str(path), rows_per_task=2)
    assert df.dtypes == [("fid", "bigint"), ("name", "string"), ("burnt area", "double"), ("seen", "boolean"), ("geometry", "binary")]
    rows = {r["fid"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 9, 10} and rows[1]["burnt area"] == 2.0 and rows[2]["seen"] is False and rows[2]["name"] is None
    assert bytes(rows[1]["geometry"]) == bytes(rows[2]["geometry"]) == geo.box(0, 0, 1, 1) and rows[9]["geometry"] is None and rows[10]["geometry"] is None


def _lzw(raw):
    """Literal codes only, cleared before the codes get longer."""
    codes = []
    for at in range(0, len(raw), 200):
        codes += [256, *raw[at : at + 200]]
    bits = "".join(f"{c:09b}" for c in [*codes, 257])
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def _tiff(values, compression, predictor, tile, nodata=None, order="<"):
    """One band, tiles of ``tile`` cells or strips of 3 rows."""
    ny, nx = values.shape
    th, tw = (tile, tile) if tile else (3, nx)
    blocks = []
    for y in range(0, ny, th):
        for x in range(0, nx, tw):
            part = values[y : y + th, x : x + tw]
            if tile:
                part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1])))
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=part.dtype.type(0)).astype(part.dtype)
            raw = part.tobytes()
            if predictor == 3:
                planes = part.astype(part.dtype.newbyteorder(">"))[..., None].view(np.uint8).reshape(*part.shape, -1).transpose(0, 2, 1).reshape(part.shape[0], -1)
                raw = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
            blocks.append({1: lambda b: b, 5: _lzw, 8: zlib.compress}[compression](raw))
    kind = {"f": 3, "i": 2, "u": 1}[values.dtype.kind]
    tags = {256: ("I", [nx]), 257: ("I", [ny]), 258: ("H", [values.dtype.itemsize * 8]), 259: ("H", [compression]), 277: ("H", [1]), 317: ("H", [predictor]), 339: ("H", [kind])}
    tags |= {322: ("I", [tw]), 323: ("I", [th])} if tile else {278: ("I", [th])}
    tags |= {33550: ("d", [0.5, 0.25, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, -120.0, 40.0, 0.0])}
    if nodata is not None:
        tags[42113] = ("s", nodata.encode() + b"\0")
    places = (324, 325) if tile else (273, 279)
    tags |= {places[0]: ("I", [0] * len(blocks)), places[1]: ("I", [len(b) for b in blocks])}
    codes = {"H": 3, "I": 4, "d": 12, "s": 2}
    at, extra, offsets = 8 + 2 + 12 * len(tags) + 4, {}, []
    pack = lambda t, v: v if t == "s" else struct.pack(f"{order}{len(v)}{t}", *v)
    for tag, (t, v) in tags.items():
        if len(pack(t, v)) > 4:
            extra[tag] = at
            at += len(pack(t, v))
    for b in blocks:
        offsets.append(at)
        at += len(b)
    tags[places[0]] = ("I", offsets)
    out = struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 8) + struct.pack(order + "H", len(tags))
    for tag in sorted(tags):
        t, v = tags[tag]
        out += struct.pack(order + "HHI", tag, codes[t], len(v)) + (struct.pack(order + "I", extra[tag]) if tag in extra else pack(t, v).ljust(4, b"\0"))
    out += b"\0" * 4
    for tag in extra:
        out += pack(*tags[tag])
    return out + b"".join(blocks)


@pytest.mark.parametrize(
    ("kind", "compression", "predictor", "tile", "order"),
    [("<f4", 1, 1, 0, "<"), ("<f4", 8, 3, 16, "<"), ("<i2", 5, 2, 16, "<"), (">u2", 8, 2, 0, ">"), ("<f8", 5, 1, 16, "<")],
)
def test_geotiff(spark, tmp_path, kind, compression, predictor, tile, order):
    values = (np.arange(20 * 23).reshape(20, 23) % 97 + 1).astype(kind)
    values[3, 4] = 7 if kind[1] != "f" else 7.0
    path = tmp_path / "x.tif"
    path.write_bytes(_tiff(values, compression, predictor, tile, nodata="7", order=order))
    df = containers.geotiff_pixels(spark, str(path), ["v"], blocks_per_task=1)
    got = {(r["iy"], r["ix"]): r for r in df.collect()}
    assert len(got) == int((values != 7).sum()) and all(got[k]["v"] == values[k] for k in got)
    assert (got[0, 0]["lon"], got[0, 0]["lat"]) == (-119.75, 39.875) and (got[19, 22]["lon"], got[19, 22]["lat"]) == (-108.75, 35.125)
    kept = containers.geotiff_pixels(spark, str(path), ["v"], keep_missing=True)
    assert kept.count() == values.size and kept.where("v IS NULL").count() == int((values == 7).sum())


@pytest.mark.parametrize("compressor", [{"id": "zlib", "level": 1}, {"id": "zstd", "level": 3}])
def test_array_store(spark, tmp_path, compressor):
    where = str(tmp_path / "s.zarr")
    g = grid.Grid(ny=10, nx=13, cy=4, cx=5, lat0=30.0, lon0=-100.0, dlat=0.5, dlon=0.25)
    arrays.write_template(where, g, ["a", "b"], compressor=compressor, attributes={"a": {"units": "1"}, "": {"license": "CC0"}})
    assert arrays.read_pixels(spark, where, ["a", "b"]).count() == 0 and arrays.read_pixels(spark, where, ["a"], keep_missing=True).count() == 130
    assert json.loads((tmp_path / "s.zarr/a/.zattrs").read_text()) == {"_ARRAY_DIMENSIONS": ["latitude", "longitude"], "units": "1"}
    lat = np.frombuffer(arrays._decode((tmp_path / "s.zarr/latitude/0").read_bytes(), compressor, 80), "<f8")
    assert lat[[0, -1]].tolist() == [30.0, 34.5]
    rows = [(y, x, float(y * 13 + x), None if x % 2 else 1.0) for y in range(10) for x in range(13) if y < 6]
    df = spark.createDataFrame(rows, "iy int, ix int, a double, b double")
    for _ in range(2):  # a repeated write leaves the same
        assert sum(r["n"] for r in arrays.write_chunks(df, where, ["a", "b"]).collect()) == len(rows)
    back = arrays.read_pixels(spark, where, ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    boxed = arrays.read_pixels(spark, where, ["a"], box=(2, 4, 5, 30))
    assert sorted((r["iy"], r["ix"]) for r in boxed.collect()) == [(y, x) for y in range(2, 5) for x in range(5, 13)]
    assert arrays.read_pixels(spark, where, ["a"], box=(50, 60, 0, 1)).count() == 0
    with pytest.raises(FileNotFoundError):
        arrays.read_pixels(spark, where, ["c"])


def test_region_files(spark, tmp_path):
    folder = str(tmp_path / "regions")
    df = spark.range(500).select(F.concat(F.lit("y0_x"), F.col("id") % 3).alias("region_id"), F.col("id").alias("v"), geo.point_wkb(F.col("id").cast("double"), F.lit(2.0)).alias("geometry"))
    for _ in range(2):
        done = sinks.write_region_files(df, folder).collect()
        assert sorted((r["region_id"], r["n"]) for r in done) == [("y0_x0", 167), ("y0_x1", 167), ("y0_x2", 166)]
    assert sorted(p.name for p in (tmp_path / "regions").iterdir()) == ["y0_x0.parquet", "y0_x1.parquet", "y0_x2.parquet"]
    meta = json.loads(pq.read_schema(f"{folder}/y0_x1.parquet").metadata[b"geo"])
    assert meta["version"] == "1.1.0" and meta["primary_column"] == "geometry" and meta["columns"]["geometry"]["covering"]["bbox"]["xmax"] == ["bbox", "xmax"]
    back = spark.read.parquet(folder)
    assert back.count() == 500 and back.where("region_id = 'y0_x1' and bbox.xmin <= 10").count() == 4
    with pytest.raises(Exception, match="a row has no region"):
        sinks.write_region_files(df.withColumn("region_id", F.lit(None).cast("string")), folder).collect()


def test_files(spark, tmp_path):
    source = tmp_path / "in"
    (source / "deep").mkdir(parents=True)
    (source / "a.txt").write_text("one")
    (source / "deep/b.txt").write_text("two")
    (source / "c.bin").write_text("three")
    target = tmp_path / "out"
    target.mkdir()
    assert files.copy(str(source / "a.txt"), str(target)) == str(target / "a.txt") and (target / "a.txt").read_text() == "one"
    with pytest.raises(FileExistsError):
        files.copy(str(source / "a.txt"), str(target / "a.txt"), overwrite=False)
    rows = files.copy_folder(spark, str(source), str(target / "all"), "*.txt").collect()
    assert len(rows) == 2 and (target / "all/deep/b.txt").read_text() == "two" and not (target / "all/c.bin").exists()
    assert files.remove(spark, str(target / "all"), str(target)) and not (target / "all").exists() and not files.remove(spark, str(target / "all"), str(target))
    for wrong in (str(target), str(source), str(target / "../in")):
        with pytest.raises(ValueError):
            files.remove(spark, wrong, str(target))
    assert source.exists()


def test_retrieve(tmp_path):
    kept = str(tmp_path / "kept")
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("in/a.txt", "one")
    url = (tmp_path / "x.zip").as_uri()
    right = "sha256:" + hashlib.sha256((tmp_path / "x.zip").read_bytes()).hexdigest()
    assert files.retrieve(url, kept, right) == f"{kept}/x.zip"
    assert [open(p).read() for p in files.retrieve(url, kept, right, unpack=True)] == ["one"]
    with pytest.raises(ValueError):
        files.retrieve(url, kept, "md5:" + "0" * 32, name="other.zip")
    assert not (tmp_path / "kept/other.zip").exists() and not (tmp_path / "kept/other.zip.part").exists()


def test_object_store():
    made = files.object_store("b", "us-east-1", endpoint="https://x", anonymous=True)
    assert made["spark.hadoop.fs.s3a.bucket.b.endpoint.region"] == "us-east-1" and any("Anonymous" in v for v in made.values())


def test_reprojection(spark, tmp_path):
    shape = geo.box(-120.0, 35.0, -119.0, 36.0)
    for system in (5070, 3857):
        there = geo.reproject(shape, 4326, system)
        x, y = (geo.to_albers if system == 5070 else geo.to_mercator)(-120.0, 35.0)
        assert np.allclose(geo.read_wkb(there)[1][0][0], [x, y])
        assert np.allclose(geo.read_wkb(geo.reproject(there, system, 4326))[1][0], geo.read_wkb(shape)[1][0])
    path = str(tmp_path / "t")
    spark.createDataFrame([(geo.from_wkt("POINT (0 0)"),), (None,)], "geometry binary").write.parquet(path)
    found = Dataset("x", path).features(spark, crs=3857, target_crs=4326)
    assert {r["geometry_wkt"] for r in found.collect()} == {None, "POINT (0 0)"}
    with pytest.raises(ValueError):
        geo.reproject_udf(4326, 1)


def test_extent_albers_and_transform(spark):
    df = spark.createDataFrame([(-120.0, 35.0), (-119.0, 36.0)], "lon double, lat double")
    got = grid.extent_albers(df).first()
    low, high = geo.to_albers(-120.0, 35.0), geo.to_albers(-119.0, 36.0)
    assert np.allclose([got["xmin"], got["ymin"], got["xmax"], got["ymax"]], [*low, *high])
    g = grid.Grid(ny=10, nx=13, cy=4, cx=5, lat0=30.0, lon0=-100.0, dlat=0.5, dlon=0.25)
    a, _, c, _, e, f = g.transform
    assert (a * 3 + c, e * 2 + f) == g.corner(3, 2)


def test_weighted_tau():
    r = np.random.default_rng(1)
    for n, spread in ((5, 3), (300, 6), (1000, 400)):
        x, y, w = r.integers(0, spread, n).astype(float), r.integers(0, spread, n).astype(float), r.integers(1, 5, n)
        many = [np.repeat(v, w) for v in (x, y)]
        s = sum(int((np.sign(many[0] - a) * np.sign(many[1] - b)).sum()) for a, b in zip(*many, strict=True)) // 2
        assert stats.tau_c(x, y, w) == stats.tau_c(*many) and stats.tau_c(x, y, w)[1] == s
        assert stats.tau_c_p_value(x, y, s, w) == pytest.approx(stats.tau_c_p_value(*many, s))
