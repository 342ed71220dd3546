import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspark.functions import scalar as S
from cinderspark.operators import kernels, raster, weather


def frame(spark, a):
    rows = [(int(y), int(x), None if np.isnan(v) else float(v)) for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "iy int, ix int, v double")


def array(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        if r[name] is not None:
            out[r["iy"], r["ix"]] = r[name]
    return out


@pytest.mark.parametrize(
    "degrees,code",
    [(0, 0), (22.4, 0), (22.5, 1), (22.6, 1), (45, 1), (67.5, 2), (112.5, 3), (157.5, 4), (202.5, 5), (247.5, 6), (292.5, 7), (337.4, 7), (337.5, 0), (337.6, 0), (359.9, 0), (0.1, 0), (360, 0), (-45, 7), (405, 1), (720, 0), (-315, 1)],
)
def test_wind_class(spark, degrees, code):
    assert spark.range(1).select(S.wind_class(F.lit(float(degrees))).alias("c")).first()["c"] == code


def test_missing_direction(spark):
    df = spark.createDataFrame([(None,), (90.0,)], "d double").select(S.wind_class("d").alias("c"))
    assert sorted([r["c"] for r in df.collect()], key=str) == [2, None]


def test_kernels():
    out = kernels.wind_kernels(35.0, -120.0, 0.00027, 0.00033)
    assert list(out) == ["W", "NW", "N", "NE", "E", "SE", "S", "SW"]
    for direction, k in out.items():
        assert k.shape == (81, 81) and k.dtype == np.float32 and k.sum() == pytest.approx(1, abs=1e-5)
        taps = np.argwhere(k > 0)
        assert 200 < len(taps) < 500
        lean = taps.mean(axis=0) - 40
        east, north = kernels.LEANS[direction]
        assert np.sign(np.round(lean[1] / 2)) == np.sign(east) and np.sign(np.round(lean[0] / 2)) == np.sign(north)
    west = np.argwhere(kernels.skewed("W", 30.0, 30.0) > 0)
    metres = (np.linspace(-41, 40, 81) * 30)[west[:, 1]]
    assert -550 <= metres.min() <= -450 and 250 <= metres.max() <= 350
    disc = kernels.circular_mean()
    assert np.array_equal(disc, disc.T) and disc.sum() == pytest.approx(1)
    with pytest.raises(ValueError):
        kernels.weights("square")
    with pytest.raises(ValueError):
        kernels.grid_spacing(np.array([2.0, 1.0]), np.array([0.0, 1.0]))


def test_fft_equals_direct():
    rng = np.random.default_rng(0)
    a, k = rng.random((30, 25)), rng.random((7, 5))
    p = np.pad(a, ((3, 3), (2, 2)), mode="reflect")
    direct = sum(k[i, j] * p[i : i + 30, j : j + 25] for i in range(7) for j in range(5))
    assert np.allclose(raster.correlate_array(a, k), direct, atol=1e-12)


def test_tiles_equal_whole(spark):
    rng = np.random.default_rng(42)
    a = np.where(rng.random((33, 41)) < 0.3, 0, rng.random((33, 41)))
    a[3:5, 7] = np.nan
    names = kernels.wind_kernels(35.0, -120.0, 0.00027, 0.00033, window=9)
    small = {d: names[d] for d in ("W", "NE")}
    got = raster.directional_spread(frame(spark, a), "v", small, 33, 41, iterations=2, tile=16)
    for d, k in small.items():
        assert np.allclose(array(got, d, a.shape), raster.spread_array(a, k, 2), rtol=1e-5, atol=1e-7, equal_nan=True)
    smooth = raster.gaussian_smooth(frame(spark, np.nan_to_num(a)), "v", 33, 41, 0.001, tile=16)
    assert np.allclose(array(smooth, "smooth", a.shape), raster.blur_array(np.nan_to_num(a), kernels.gaussian(0.001)), rtol=1e-5, atol=1e-7)


@pytest.mark.parametrize("gone", [slice(16, 51), slice(48, 64), slice(28, 37), slice(0, 64)])
def test_tiles_of_sparse_rasters(spark, gone):
    """Rows without pixels are gaps, whatever the tiles."""
    rng = np.random.default_rng(8)
    a = np.where(rng.random((64, 64)) < 0.3, 0, rng.random((64, 64)))
    a[gone] = np.nan
    there = frame(spark, a).where("v is not null")
    k = {"N": kernels.wind_kernels(35.0, -120.0, 0.0018, 0.0018, window=5)["N"]}
    want = raster.spread_array(a, k["N"], 2)
    smooth = raster.blur_array(a, kernels.gaussian(0.001))
    for tile in (8, 32, 64):
        got = raster.directional_spread(there, "v", k, 64, 64, iterations=2, tile=tile)
        assert got.count() == there.count()
        assert np.allclose(array(got, "N", a.shape), want, rtol=1e-5, atol=1e-7, equal_nan=True)
        blurred = raster.gaussian_smooth(there.withColumn("v", F.col("v")), "v", 64, 64, 0.001, tile=tile)
        got = array(blurred, "smooth", a.shape)
        known = ~np.isnan(a)
        assert np.allclose(got[known], smooth[known], rtol=1e-5, atol=1e-7, equal_nan=True)


def test_snapshots(spark):
    a = np.where(np.random.default_rng(2).random((12, 14)) < 0.4, 0, 0.5)
    k = {"W": kernels.wind_kernels(35.0, -120.0, 0.0018, 0.0018, window=5)["W"]}
    got = raster.directional_spread(frame(spark, a), "v", k, 12, 14, iterations=2, tile=8, snapshots=True)
    for n, want in enumerate(raster.spread_steps(a, k["W"], 2)):
        assert np.allclose(array(got, f"W_{n}", a.shape), want, rtol=1e-6)


def test_tiles_equal_tap_join(spark):
    rng = np.random.default_rng(1)
    a = np.where(rng.random((12, 14)) < 0.4, 0, rng.random((12, 14)))
    a[2, 2] = np.nan
    k = np.array([[0, 0.2, 0.1], [0.3, 0.1, 0], [0.1, 0.2, 0]])
    by_taps = raster.masked_mean_step(frame(spark, a), "v", kernels.taps(k), 12, 14)
    assert np.allclose(array(by_taps, "v", a.shape), raster.spread_array(a, k, 1), rtol=1e-5, atol=1e-7, equal_nan=True)


def test_impulse_stays_positive():
    a = np.zeros((41, 41))
    a[20, 20] = 1
    out = raster.spread_array(a, kernels.circular_mean(41, 9), 2)
    assert (out >= 0).all() and out[20, 20] > 0


def test_gap_fill(spark):
    a = np.ones((5, 5))
    a[2, 2] = 0
    a[0, 0] = 0
    out = array(raster.gap_fill(frame(spark, a), "v"), "filled", a.shape)
    assert out[2, 2] == pytest.approx(8 / 9) and out[0, 0] == 0
    a[2, 2] = np.nan
    assert array(raster.gap_fill(frame(spark, a), "v"), "filled", a.shape)[2, 2] == pytest.approx(1)


def test_composite(spark):
    rows = [([0.125] * 8,), ([0.0] * 8,), ([1.0] * 8,), ([None] + [0.1] * 7,), ([1.0] + [0.0] * 7,)]
    df = spark.createDataFrame(rows, "p array<double>")
    got = [r["b"] for r in df.select(raster.composite([F.lit(float(k)) for k in range(8)], "p").alias("b")).collect()]
    assert got == [pytest.approx(3.5), None, pytest.approx(3.5), None, 0]
    with pytest.raises(Exception, match="negative weight"):
        spark.createDataFrame([([-0.1] + [0.1] * 7,)], "p array<double>").select(raster.composite([F.lit(1.0)] * 8, "p")).collect()
    with pytest.raises(KeyError):
        raster.stack_directions(df, [])


def test_modal_direction(spark):
    rows = [([0.5, 0, 0, 0, 0.2, 0.1, 0.1, 0.1],), ([0.1, 0.0, 0.1, 0.1, 0.5, 0.1, 0.1, 0.0],), ([0.125] * 8,), ([0.0] * 8,), ([0.0, 0.2, 0.2, 0.2, 0.2, 0.2, 0.0, 0.0],)]
    df = spark.createDataFrame([([float(x) for x in r[0]],) for r in rows], "distribution array<double>")
    assert [r["m"] for r in df.select(weather.modal_direction().alias("m")).collect()] == [0, 4, 0, None, 1]


def test_distribution_without_fire_weather_is_zero(spark):
    hours = spark.createDataFrame([(1, 10.0, None), (1, 20.0, None)], "pixel int, degrees double, code int")
    row = weather.direction_distribution(hours, ["pixel"], "code").first()
    assert row["n_hours"] == 0 and row["distribution"] == [0.0] * 8


def test_humidity_bounds(spark):
    df = spark.createDataFrame([(290.0, 289.0), (290.0, 290.0), (290.0, 300.0)], "t double, d double")
    rh = [r["rh"] for r in df.select(S.relative_humidity("t", "d").alias("rh")).collect()]
    assert 90 < rh[0] < 100 and rh[1] == pytest.approx(100) and rh[2] == 100


def test_wind_vectors(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, -5.0), (-4.0, 0.0), (0.1, 0.1)], "u double, v double")
    got = [(r["s"], r["d"]) for r in df.select(S.wind_speed("u", "v").alias("s"), S.wind_from("u", "v").alias("d")).collect()]
    assert got[0][0] == 5 and got[1] == (5, 360) and got[2] == (4, 90) and got[3][1] == 0
    u, v = S.rotate_wind(F.lit(1.0), F.lit(2.0), F.lit(0.0), F.lit(1.0))
    assert tuple(spark.range(1).select(u, v).first()) == (1, 2)


def test_burn_probability_on_tiles(spark):
    rng = np.random.default_rng(3)
    a = np.where(rng.random((20, 30)) < 0.2, 0, rng.random((20, 30)) * 0.01)
    df = frame(spark, a)
    shares = df.select("iy", "ix", F.array(*[F.lit(0.125)] * 8).alias("distribution"))
    results = [array(raster.wind_informed_burn_probability(df, "v", shares, 20, 30, 35.0, -120.0, 0.00027, 0.00033, window=9, tile=t), "bp", a.shape) for t in (8, 64)]
    assert np.allclose(*results, rtol=1e-4, atol=1e-8) and np.isfinite(results[0]).all()
