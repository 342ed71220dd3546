"""Chunked array stores (Zarr, version 2) as pixel tables: each chunk is one unit of reading and of writing."""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.operators.grid import Grid
from cinderspark.sources.files import open_fs

DIMENSIONS = ("latitude", "longitude")


def _encode(raw: bytes, compressor: Mapping | None) -> bytes:
    kind = (compressor or {}).get("id")
    if kind is None:
        return raw
    if kind == "zlib":
        return zlib.compress(raw, compressor.get("level", 1))
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=compressor.get("level", 1)).compress(raw)
    raise ValueError(f"chunks compressed by {kind} are not written")


def _decode(raw: bytes, compressor: Mapping | None, size: int) -> bytes:
    kind = (compressor or {}).get("id")
    if kind is None:
        return raw
    if kind in ("zlib", "gzip"):
        return zlib.decompress(raw, 47)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
    raise ValueError(f"chunks compressed by {kind} are not read")


def _put(where: str, raw: bytes) -> None:
    """Written beside and moved into place, so that a reader or a repeated task never meets half a file."""
    fs, path = open_fs(where)
    fs.create_dir(path.rsplit("/", 1)[0])
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(raw)
    fs.move(part, path)


def _get(where: str) -> bytes | None:
    fs, path = open_fs(where)
    try:
        with fs.open_input_stream(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


def _meta(shape: Sequence[int], chunks: Sequence[int], dtype: np.dtype, compressor: Mapping | None) -> dict:
    fill = "NaN" if dtype.kind == "f" else 0
    return {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype.str, "compressor": compressor, "fill_value": fill, "order": "C", "filters": None}


def write_template(
    where: str, grid: Grid, variables: Sequence[str], dtype: str = "<f4", compressor: Mapping | None = None, attributes: Mapping[str, Mapping[str, object]] | None = None,
) -> None:
    """A store that holds coordinates and the variables' descriptions but no chunk: all values are missing.

    ``attributes`` by variable ("" for the store's own), such as units and descriptions.
    """
    attributes, compressor, kind = attributes or {}, compressor or {"id": "zlib", "level": 1}, np.dtype(dtype)
    _put(f"{where}/.zgroup", b'{"zarr_format": 2}')
    _put(f"{where}/.zattrs", json.dumps(dict(attributes.get("", {}))).encode())
    for v in variables:
        _put(f"{where}/{v}/.zarray", json.dumps(_meta((grid.ny, grid.nx), (grid.cy, grid.cx), kind, compressor)).encode())
        _put(f"{where}/{v}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": DIMENSIONS, **attributes.get(v, {})}).encode())
    for name, origin, step, n in ((DIMENSIONS[0], grid.lat0, grid.dlat, grid.ny), (DIMENSIONS[1], grid.lon0, grid.dlon, grid.nx)):
        _put(f"{where}/{name}/.zarray", json.dumps(_meta([n], [n], np.dtype("<f8"), compressor)).encode())
        _put(f"{where}/{name}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": [name]}).encode())
        _put(f"{where}/{name}/0", _encode((origin + np.arange(n) * step).astype("<f8").tobytes(), compressor))


def describe(where: str, variable: str) -> dict:
    raw = _get(f"{where}/{variable}/.zarray")
    if raw is None:
        raise FileNotFoundError(f"{where} has no array {variable}")
    meta = json.loads(raw)
    if meta["zarr_format"] != 2 or meta["filters"] or len(meta["shape"]) != 2:
        raise ValueError(f"{variable}: only plain two-dimensional arrays of version 2 are read")
    return meta


def _fill(meta: Mapping) -> float:
    return float("nan") if meta["fill_value"] in (None, "NaN") else float(meta["fill_value"])


def write_chunks(pixels: DataFrame, where: str, variables: Sequence[str]) -> DataFrame:
    """Puts pixels (iy, ix, variables) into a store made by ``write_template``; cy, cx, n of the chunks written.

    A chunk is one group and one task's memory, bounded by the store's chunk size. Whole chunks are
    replaced, so pixels must hold all of each chunk they touch; the rest of the store stays. Chunks are
    written when the result's rows are asked for.
    """
    metas = {v: describe(where, v) for v in variables}
    height, width = metas[variables[0]]["chunks"]
    if any(m["chunks"] != [height, width] for m in metas.values()):
        raise ValueError("the variables' chunks differ")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cy, cx = map(int, key)
        iy, ix = rows["iy"].to_numpy() - cy * height, rows["ix"].to_numpy() - cx * width
        for v, meta in metas.items():
            kind = np.dtype(meta["dtype"])
            gap = _fill(meta)
            block = np.full((height, width), gap, kind)
            values = rows[v].to_numpy(float)
            block[iy, ix] = np.where(np.isnan(values), gap, values).astype(kind)
            name = meta.get("dimension_separator", ".").join((str(cy), str(cx)))
            _put(f"{where}/{v}/{name}", _encode(block.tobytes(meta["order"]), meta["compressor"]))
        return pd.DataFrame({"cy": [cy], "cx": [cx], "n": [len(rows)]})

    at = {"cy": F.floor(F.col("iy") / height).cast("int"), "cx": F.floor(F.col("ix") / width).cast("int")}
    chosen = pixels.select("iy", "ix", *[F.col(v).cast("double").alias(v) for v in variables])
    return chosen.groupBy(*[c.alias(k) for k, c in at.items()]).applyInPandas(run, "cy int, cx int, n long")


def read_pixels(spark: SparkSession, where: str, variables: Sequence[str], box: tuple[int, int, int, int] | None = None, keep_missing: bool = False) -> DataFrame:
    """iy, ix and the variables of a store's pixels; fill values and NaN are null.

    Chunks are dealt over tasks and read one at a time. ``box`` (first row, last row, first column, last
    column, inclusive) leaves chunks outside unread. Pixels without any value are left out unless kept.
    """
    metas = {v: describe(where, v) for v in variables}
    first = metas[variables[0]]
    (ny, nx), (height, width) = first["shape"], first["chunks"]
    if any(m["shape"] != [ny, nx] or m["chunks"] != [height, width] for m in metas.values()):
        raise ValueError("the variables' shapes or chunks differ")
    y0, y1, x0, x1 = box or (0, ny - 1, 0, nx - 1)
    y0, y1, x0, x1 = max(y0, 0), min(y1, ny - 1), max(x0, 0), min(x1, nx - 1)
    top, left = y0 // height, x0 // width
    rows, columns = max(y1 // height - top + 1, 0), max(x1 // width - left + 1, 0)

    def block_of(v: str, cy: int, cx: int) -> np.ndarray | None:
        meta, kind = metas[v], np.dtype(metas[v]["dtype"])
        raw = _get(f"{where}/{v}/" + meta.get("dimension_separator", ".").join((str(cy), str(cx))))
        if raw is None:
            return None
        values = np.frombuffer(_decode(raw, meta["compressor"], height * width * kind.itemsize), kind).reshape((height, width), order=meta["order"]).astype(float)
        gap = _fill(meta)
        return values if math.isnan(gap) else np.where(values == gap, np.nan, values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"]:
                cy, cx = top + int(k) // columns, left + int(k) % columns
                blocks = {v: block_of(v, cy, cx) for v in variables}
                if all(b is None for b in blocks.values()) and not keep_missing:
                    continue
                # A band of the chunk at a time keeps the rows in memory few.
                band = max(1, 200_000 // width)
                for start in range(max(y0 - cy * height, 0), min(y1 - cy * height + 1, height), band):
                    stop = min(start + band, y1 - cy * height + 1, height)
                    a, b = max(x0 - cx * width, 0), min(x1 - cx * width + 1, width)
                    iy, ix = np.mgrid[start:stop, a:b]
                    out = {"iy": (iy + cy * height).ravel(), "ix": (ix + cx * width).ravel()}
                    for v, block in blocks.items():
                        out[v] = np.full(iy.size, np.nan) if block is None else block[start:stop, a:b].ravel()
                    found = pd.DataFrame(out)
                    yield found if keep_missing else found.dropna(subset=list(variables), how="all")

    n = rows * columns
    from cinderspark.sources.readers import nan_to_null

    dealt = spark.range(0, n, 1, max(1, min(n, 4096)))
    return nan_to_null(dealt.mapInPandas(run, ", ".join(["iy int", "ix int", *(f"`{v}` double" for v in variables)])))
