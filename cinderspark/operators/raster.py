"""Rasters as pixel tables (iy, ix, variables) and as tiles.

Neighbourhoods of a few pixels are windows or scattered sums and stay in SQL. Large stencils run on
tiles: every pixel goes to the tiles whose halo it is in, and each tile is one Arrow group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S
from cinderspark.operators import kernels

#: Fixed value: what is below it is rounding of the transform, not fire.
TINY = 10e-12


# ---------------------------------------------------------------- neighbourhoods


def shifts(pixels: DataFrame, value: Column | str) -> DataFrame:
    """The four neighbours' values on a dense grid as west, east, south, north; null outside."""
    v = S.col(value)
    row, column = Window.partitionBy("iy").orderBy("ix"), Window.partitionBy("ix").orderBy("iy")
    return pixels.withColumns({"west": F.lag(v).over(row), "east": F.lead(v).over(row), "south": F.lag(v).over(column), "north": F.lead(v).over(column)})


def rolling_mean_3x3(pixels: DataFrame, value: str, name: str) -> DataFrame:
    """Mean of the 3 by 3 block of what is not missing, zeros included: two one-way windows."""
    row = Window.partitionBy("iy").orderBy("ix").rowsBetween(-1, 1)
    column = Window.partitionBy("ix").orderBy("iy").rowsBetween(-1, 1)
    one_way = pixels.withColumns({"_s": F.sum(F.col(value).cast("double")).over(row), "_n": F.count(value).over(row)})
    return one_way.withColumn(name, F.try_divide(F.sum("_s").over(column), F.sum("_n").over(column))).drop("_s", "_n")


def gap_fill(pixels: DataFrame, value: str, name: str = "filled") -> DataFrame:
    """Zero, negative or missing pixels whose four neighbours are all positive take the 3x3 mean.

    All that looks along a row is done in one pass, then all that looks along a column: two shuffles.
    """
    v = F.col(value)
    row, column = Window.partitionBy("iy").orderBy("ix"), Window.partitionBy("ix").orderBy("iy")
    fine = pixels.withColumn("_ok", F.coalesce(v > 0, F.lit(False)))
    along = fine.withColumns(
        {
            "_sides": F.coalesce(F.lag("_ok").over(row) & F.lead("_ok").over(row), F.lit(False)),
            "_s": F.sum(v.cast("double")).over(row.rowsBetween(-1, 1)),
            "_n": F.count(value).over(row.rowsBetween(-1, 1)),
        }
    )
    across = along.withColumns(
        {
            "_ends": F.coalesce(F.lag("_ok").over(column) & F.lead("_ok").over(column), F.lit(False)),
            "_mean": F.try_divide(F.sum("_s").over(column.rowsBetween(-1, 1)), F.sum("_n").over(column.rowsBetween(-1, 1))),
        }
    )
    gap = ~F.col("_ok") & F.col("_sides") & F.col("_ends")
    return across.withColumn(name, F.when(gap, F.col("_mean")).otherwise(v.cast("double"))).drop("_ok", "_sides", "_s", "_n", "_ends", "_mean")


# ---------------------------------------------------------------------- stencils


def _images(axis: str, n: int, reach: int) -> Column:
    """Places within ``reach`` of the grid where an index shows when the edges mirror (the edge itself not repeated)."""
    if n == 1:
        return F.sequence(F.lit(-reach), F.lit(reach))
    period, i = 2 * (n - 1), F.col(axis)
    turns = range(-((reach + n) // period + 1), (reach + n) // period + 2)
    places = F.array(*[c + k * period for k in turns for c in (i, -i)])
    return F.array_distinct(F.filter(places, lambda x: (x >= -reach) & (x <= n - 1 + reach)))


def _scatter(pixels: DataFrame, weights: Sequence[tuple[int, int, float]], ny: int, nx: int) -> DataFrame:
    """Each pixel's columns at every (iy, ix) that a tap reaches it from, with the tap's weight ``_w``.

    Sources hand their values to their targets, so the sums that follow are combined before the
    only shuffle; nothing is joined.
    """
    reach_y, reach_x = max(abs(dy) for dy, _, _ in weights), max(abs(dx) for _, dx, _ in weights)
    taps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(float(w)).alias("w")) for dy, dx, w in weights])
    kept = [c for c in pixels.columns if c not in ("iy", "ix")]
    shown = pixels.withColumn("_y", F.explode(_images("iy", ny, reach_y))).withColumn("_x", F.explode(_images("ix", nx, reach_x)))
    out = shown.select(*kept, "_y", "_x", F.explode(taps).alias("_t"))
    out = out.select((F.col("_y") - F.col("_t.dy")).cast("int").alias("iy"), (F.col("_x") - F.col("_t.dx")).cast("int").alias("ix"), F.col("_t.w").alias("_w"), *kept)
    return out.where(F.col("iy").between(0, ny - 1) & F.col("ix").between(0, nx - 1))


def correlate(pixels: DataFrame, value: str, weights: Sequence[tuple[int, int, float]], ny: int, nx: int, name: str) -> DataFrame:
    """``sum(w * value(iy + dy, ix + dx))``, mirrored at the edges, for kernels of some tens of taps.

    Larger ones go to ``directional_spread``.
    """
    source = pixels.select("iy", "ix", F.col(value).cast("double").alias("_v"))
    return _scatter(source, weights, ny, nx).groupBy("iy", "ix").agg(F.sum(F.col("_w") * F.col("_v")).alias(name))


def masked_mean_step(pixels: DataFrame, value: str, weights, ny: int, nx: int) -> DataFrame:
    """One step of spreading: weighted mean of the positive pixels under the kernel, 0 where none; missing stays missing."""
    v = S.missing(F.col(value).cast("double"))
    known = pixels.select("iy", "ix", F.coalesce(v, F.lit(0.0)).alias("_v"), (F.coalesce(v, F.lit(0.0)) > 0).cast("double").alias("_m"))
    reached = _scatter(known, weights, ny, nx).withColumn("_own", F.lit(None).cast("boolean"))
    # The pixel itself says whether it is missing.
    own = pixels.select("iy", "ix", F.lit(0.0).alias("_w"), F.lit(0.0).alias("_v"), F.lit(0.0).alias("_m"), v.isNotNull().alias("_own"))
    sums = reached.unionByName(own).groupBy("iy", "ix").agg(F.sum(F.col("_w") * F.col("_v")).alias("_a"), F.sum(F.col("_w") * F.col("_m")).alias("_c"), F.max("_own").alias("_own"))
    a, c = (F.when(F.col(x) < F.lit(TINY), F.lit(0.0)).otherwise(F.col(x)) for x in ("_a", "_c"))
    spread = F.when(c > 0, a / c).otherwise(F.lit(0.0))
    # Taps may reach places that are no pixels.
    return sums.where("_own is not null").select("iy", "ix", F.when(F.col("_own"), spread).alias(value))


def correlate_array(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation about the middle with mirrored edges, by FFT."""
    ky, kx = kernel.shape[0] // 2, kernel.shape[1] // 2
    ey, ex = kernel.shape[0] - 1 - ky, kernel.shape[1] - 1 - kx
    # Mirroring wider than the array has to be repeated, which numpy does.
    p = np.pad(a.astype(np.float64), ((ky, ey), (kx, ex)), mode="reflect" if min(a.shape) > 1 else "edge")
    shape = [int(2 ** np.ceil(np.log2(n + k))) for n, k in zip(p.shape, kernel.shape, strict=True)]
    full = np.fft.irfft2(np.fft.rfft2(p, shape) * np.fft.rfft2(kernel[::-1, ::-1].astype(np.float64), shape), shape)
    return full[kernel.shape[0] - 1 : kernel.shape[0] - 1 + a.shape[0], kernel.shape[1] - 1 : kernel.shape[1] - 1 + a.shape[1]]


def spread_steps(a: np.ndarray, kernel: np.ndarray, iterations: int = 3, kind=np.float32) -> list[np.ndarray]:
    """``masked_mean_step`` repeated on an array: the start and the surface after each step."""
    gap = np.isnan(a)
    out = [np.where(gap, 0.0, a).astype(kind)]
    for _ in range(iterations):
        c = correlate_array((out[-1] > 0).astype(np.float64), kernel)
        s = correlate_array(out[-1], kernel)
        c[c < TINY], s[s < TINY] = 0, 0
        out.append(np.divide(s, c, out=np.zeros_like(s), where=c > 0).astype(kind))
    for step in out:
        step[gap] = np.nan
    return out


def spread_array(a: np.ndarray, kernel: np.ndarray, iterations: int = 3) -> np.ndarray:
    return spread_steps(a, kernel, iterations)[-1]


def blur_array(a: np.ndarray, axis_weights: np.ndarray) -> np.ndarray:
    """Separable smoothing with mirrored edges; missing pixels spoil what they touch, as in the array library."""
    k = len(axis_weights) // 2
    out = a.astype(np.float64)
    for axis in (0, 1):
        pad = [(k, len(axis_weights) - 1 - k) if x == axis else (0, 0) for x in (0, 1)]
        p = np.pad(out, pad, mode="reflect" if a.shape[axis] > 1 else "edge")
        n = a.shape[axis]
        out = sum(w * (p[i : i + n] if axis == 0 else p[:, i : i + n]) for i, w in enumerate(axis_weights))
    return out


def with_halo(pixels: DataFrame, tile: int, halo: int, ny: int, nx: int) -> DataFrame:
    """Pixels once for each tile whose halo holds them: ty, tx and the columns."""
    def tiles(i: str, n: int) -> Column:
        return F.sequence(F.floor(F.greatest(F.col(i) - halo, F.lit(0)) / tile).cast("int"), F.floor(F.least(F.col(i) + halo, F.lit(n - 1)) / tile).cast("int"))

    return pixels.withColumn("ty", F.explode(tiles("iy", ny))).withColumn("tx", F.explode(tiles("ix", nx)))


def tile_stencil(pixels: DataFrame, value: str, ny: int, nx: int, tile: int, halo: int, function, names: Sequence[str], kind: str = "float") -> DataFrame:
    """``function`` (array -> one array for each name) over tiles with halo; its results at the tiles' own pixels.

    A tile's array covers the tile and its halo as far as the grid goes (tile + 2 halo squared at most), with NaN where
    the table has no pixel: the grid's edges mirror, gaps do not, and a tile's edges have true neighbours.
    """
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(group["ty"].iloc[0]) * tile, int(group["tx"].iloc[0]) * tile
        y0, x0 = max(ty - halo, 0), max(tx - halo, 0)
        shape = (min(ty + tile + halo, ny) - y0, min(tx + tile + halo, nx) - x0)
        at = (group["iy"].to_numpy() - y0, group["ix"].to_numpy() - x0)
        a, there = np.full(shape, np.nan), np.zeros(shape, bool)
        a[at], there[at] = group[value].to_numpy(float), True
        own = (slice(ty - y0, ty - y0 + tile), slice(tx - x0, tx - x0 + tile))
        iy, ix = np.nonzero(there[own])
        results = function(a) if len(iy) else [a] * len(names)
        flat = {name: r[own][iy, ix].astype(np.float32 if kind == "float" else np.float64) for name, r in zip(names, results, strict=True)}
        return pd.DataFrame({"iy": (iy + ty).astype(np.int32), "ix": (ix + tx).astype(np.int32), **flat})

    schema = "iy int, ix int, " + ", ".join(f"{n} {kind}" for n in names)
    rows = with_halo(pixels.select("iy", "ix", F.col(value).cast("double").alias(value)), tile, halo, ny, nx)
    return rows.groupBy("ty", "tx").applyInPandas(run, schema)


def directional_spread(
    pixels: DataFrame, value: str, wind_kernels: dict[str, np.ndarray], ny: int, nx: int, iterations: int = 3, tile: int = 512, kind: str = "float", snapshots: bool = False
) -> DataFrame:
    """iy, ix and one spread surface for each direction, over tiles whose halo covers all iterations.

    With ``snapshots``, the surface after each step besides, as ``{direction}_0`` (the start) and so on.
    """
    halo = iterations * max(max(k.shape) // 2 for k in wind_kernels.values())
    steps = lambda a, n: spread_steps(a, wind_kernels[n], iterations, np.float32 if kind == "float" else np.float64)
    if not snapshots:
        return tile_stencil(pixels, value, ny, nx, tile, halo, lambda a: [steps(a, n)[-1] for n in wind_kernels], list(wind_kernels), kind)
    names = [f"{n}_{k}" for n in wind_kernels for k in range(iterations + 1)]
    return tile_stencil(pixels, value, ny, nx, tile, halo, lambda a: [s for n in wind_kernels for s in steps(a, n)], names, kind)


def gaussian_smooth(pixels: DataFrame, value: str, ny: int, nx: int, dlat: float, tile: int = 512, name: str = "smooth", kind: str = "float") -> DataFrame:
    w = kernels.gaussian(dlat)
    return tile_stencil(pixels, value, ny, nx, tile, len(w) // 2, lambda a: [blur_array(a, w)], [name], kind)


# -------------------------------------------------------------------- composites


def stack_directions(wide: DataFrame, ids: Sequence[str], value: str = "bp") -> DataFrame:
    """Wide direction columns as rows (ids, direction, value)."""
    lost = [d for d in S.DIRECTIONS if d not in wide.columns]
    if lost:
        raise KeyError(f"no column for {', '.join(lost)}")
    return wide.unpivot(list(ids), list(S.DIRECTIONS), "direction", value)


def composite(layers: Sequence[Column], distribution: Column | str) -> Column:
    """Layers weighted by the normalised distribution; null where it is all zero or has a gap."""
    p = S.col(distribution)
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x.cast("double"))
    products = F.zip_with(F.array(*[c.cast("double") for c in layers]), p, lambda b, x: b * x)
    # A layer's gap counts as nothing, as sums over layers skip it.
    weighted = F.aggregate(products, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0)))
    broken = F.exists(p, lambda x: x.isNull() | F.isnan(x))
    negative = F.coalesce(F.exists(p, lambda x: x < 0), F.lit(False))
    value = F.when(~broken & (total != 0), weighted / total)
    return F.when(negative, F.raise_error(F.lit("negative weight")).cast("double")).otherwise(value)


def combine(smeared: Column | str, original: Column | str) -> Column:
    """The original where it burns or is missing, the smeared where it is zero."""
    return F.when(S.col(original) == 0, S.col(smeared)).otherwise(S.col(original))


# ------------------------------------------------------------------------ levels


def coarsen(pixels: DataFrame, values: Sequence[str], fy: int, fx: int, ny: int, nx: int) -> DataFrame:
    """Block means that skip gaps; blocks cut off by the grid's end are left out."""
    whole = pixels.where((F.col("iy") < ny // fy * fy) & (F.col("ix") < nx // fx * fx))
    return whole.groupBy(F.floor(F.col("iy") / fy).cast("int").alias("iy"), F.floor(F.col("ix") / fx).cast("int").alias("ix")).agg(*[F.avg(v).alias(v) for v in values])


def pyramid(pixels: DataFrame, values: Sequence[str], levels: int, factor: int = 2) -> DataFrame:
    """All levels in one table: level 0 is the grid, each next one averages factor by factor blocks of the last."""
    current = pixels.select("iy", "ix", *[F.col(v).cast("double").alias(v) for v in values])
    out = current.withColumn("level", F.lit(0))
    for level in range(1, levels + 1):
        by = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("iy", "ix")]
        current = current.groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])
        out = out.unionByName(current.withColumn("level", F.lit(level)))
    return out


def resample_nearest(target: DataFrame, source: DataFrame, lon0: float, lat0: float, dlon: float, dlat: float, nx: int, ny: int) -> DataFrame:
    """The target's pixels (iy, ix, lon, lat) with the nearest source pixel's variables; null outside the source."""
    y = F.floor((F.col("lat") - F.lit(lat0)) / F.lit(dlat) + F.lit(0.5))
    x = F.floor((F.col("lon") - F.lit(lon0)) / F.lit(dlon) + F.lit(0.5))
    placed = target.withColumns({"sy": y.cast("int"), "sx": x.cast("int")})
    named = source.withColumnsRenamed({"iy": "sy", "ix": "sx"})
    return placed.join(named, ["sy", "sx"], "left").drop("sy", "sx")


def rasterize_boxes(boxes: DataFrame, lon0: float, lat0: float, dlon: float, dlat: float, nx: int, ny: int) -> DataFrame:
    """How many boxes touch each pixel: iy, ix, n."""
    def span(a, b, origin, step, n):
        at = lambda c: F.floor((F.col(c) - F.lit(origin)) / F.lit(step) + F.lit(0.5)).cast("int")
        return F.when((at(b) >= 0) & (at(a) < n), F.sequence(F.greatest(at(a), F.lit(0)), F.least(at(b), F.lit(n - 1))))

    rows = boxes.withColumn("iy", F.explode(span("ymin", "ymax", lat0, dlat, ny))).withColumn("ix", F.explode(span("xmin", "xmax", lon0, dlon, nx)))
    return rows.groupBy("iy", "ix").agg(F.count(F.lit(1)).alias("n"))


def rasterize_polygons(polygons: DataFrame, geometry: str, lon0: float, lat0: float, dlon: float, dlat: float, nx: int, ny: int) -> DataFrame:
    """How many polygons (WKB) hold each pixel's centre, edges included: iy, ix, n (pixels in none are absent)."""
    bounded = polygons.select(F.col(geometry).alias("_g"), geo.bbox_udf(F.col(geometry)).alias("_box")).select("_g", "_box.*")

    def span(a, b, origin, step, n):
        low, high = F.ceil((F.col(a) - F.lit(origin)) / F.lit(step) - 1e-9), F.floor((F.col(b) - F.lit(origin)) / F.lit(step) + 1e-9)
        low, high = F.greatest(low, F.lit(0)).cast("int"), F.least(high, F.lit(n - 1)).cast("int")
        return F.when(low <= high, F.sequence(low, high))

    lines = bounded.withColumn("iy", F.explode(span("ymin", "ymax", lat0, dlat, ny))).withColumn("ix", F.explode(span("xmin", "xmax", lon0, dlon, nx)))
    x, y = F.lit(lon0) + F.col("ix") * F.lit(dlon), F.lit(lat0) + F.col("iy") * F.lit(dlat)
    return lines.where(geo.contains_udf(F.col("_g"), x, y)).groupBy("iy", "ix").agg(F.count(F.lit(1)).alias("n"))


def reach(dlat: float, window: int = kernels.WINDOW, iterations: int = 3) -> int:
    """How many pixels away the wind-informed surface still depends on its input."""
    return 1 + iterations * (window // 2) + len(kernels.gaussian(dlat)) // 2


def wind_informed_burn_probability(
    pixels: DataFrame, value: str, distribution: DataFrame, ny: int, nx: int, lat0: float, lon0: float, dlat: float, dlon: float,
    window: int = kernels.WINDOW, tile: int = 512, kind: str = "float", wind: dict[str, np.ndarray] | None = None,
) -> DataFrame:
    """iy, ix, bp: gaps filled, spread by direction, weighted by the wind, put where nothing burns, smoothed.

    ``distribution`` has iy, ix and ``distribution`` (eight shares). Kernels are those of the grid's middle, if none are given. Of a part
    of the grid, only pixels ``reach`` away from what is missing have their final values.
    """
    wind = wind or kernels.wind_kernels(lat0 + dlat * (ny // 2), lon0 + dlon * (nx // 2), dlat, dlon, window)
    filled = gap_fill(pixels.select("iy", "ix", value), value, "filled").select("iy", "ix", F.col("filled").alias(value))
    spread = directional_spread(filled, value, wind, ny, nx, tile=tile, kind=kind)
    weighted = spread.join(distribution.select("iy", "ix", "distribution"), ["iy", "ix"])
    weighted = weighted.select("iy", "ix", composite([F.col(d) for d in S.DIRECTIONS], "distribution").alias("smeared"))
    merged = weighted.join(filled, ["iy", "ix"]).select("iy", "ix", combine("smeared", value).alias("merged"))
    return gaussian_smooth(merged, "merged", ny, nx, dlat, tile, "bp", kind)
