"""Stencil weights, made once on the driver: a few thousand taps at most."""

from __future__ import annotations

import math

import numpy as np

from cinderspark.functions.scalar import EARTH_RADIUS_M, METERS_PER_DEGREE

# The ellipse in metres, its shift towards the wind, and the window.
SEMI_MAJOR_M, SEMI_MINOR_M, SHIFT_M, WINDOW = 400.0, 200.0, 110.0, 81
#: Unit vectors (east, north) that each direction's ellipse leans to; order of the kernels.
LEANS = {"W": (-1, 0), "NW": (-1, 1), "N": (0, 1), "NE": (1, 1), "E": (1, 0), "SE": (1, -1), "S": (0, -1), "SW": (-1, -1)}


def haversine(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p, q = math.radians(lat1), math.radians(lat2)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a))


def pixel_size(lat: float, lon: float, dlat: float, dlon: float) -> tuple[float, float]:
    """(north-south, east-west) metres of a cell."""
    return haversine(lat, lon, lat + dlat, lon), haversine(lat, lon, lat, lon + dlon)


def grid_spacing(lats: np.ndarray, lons: np.ndarray) -> tuple[float, float, float, float]:
    """(centre lat, centre lon, dlat, dlon) of ascending coordinates."""
    if not (np.all(np.diff(lats) > 0) and np.all(np.diff(lons) > 0)):
        raise ValueError("coordinates must ascend")
    return float(lats[len(lats) // 2]), float(lons[len(lons) // 2]), float(lats[1] - lats[0]), float(lons[1] - lons[0])


def skewed(direction: str, y_m: float, x_m: float, window: int = WINDOW) -> np.ndarray:
    """Ellipse of ones that leans to ``direction``; rows go north, columns east.

    Offsets run evenly from the floor of minus half the window to that of half the
    window, so that the window's middle lies half a cell low: this is what published results use.
    """
    offsets = np.linspace(-float(window) // 2, float(window) // 2, window)
    east, north = np.meshgrid(offsets * x_m, offsets * y_m)
    lean_east, lean_north = LEANS[direction]
    length = math.hypot(lean_east, lean_north)
    ue, un = lean_east / length, lean_north / length
    along = (east - SHIFT_M * ue) * ue + (north - SHIFT_M * un) * un
    across = -(east - SHIFT_M * ue) * un + (north - SHIFT_M * un) * ue
    return ((along / SEMI_MAJOR_M) ** 2 + (across / SEMI_MINOR_M) ** 2 <= 1).astype(np.float64)


def circular_mean(window: int = WINDOW, diameter: int = 35) -> np.ndarray:
    """Equal weights within half the diameter and one cell, summing to 1."""
    offsets = np.arange(-(window // 2), window // 2 + 1)
    x, y = np.meshgrid(offsets, offsets)
    disc = (np.hypot(x, y) <= diameter // 2 + 1).astype(np.float64)
    return disc / disc.sum()


def weights(method: str, direction: str = "W", y_m: float = 30.0, x_m: float = 30.0, window: int = WINDOW) -> np.ndarray:
    if method == "skewed":
        return skewed(direction, y_m, x_m, window)
    if method == "circular_focal_mean":
        return circular_mean(window)
    raise ValueError(f"unknown method {method!r}")


def wind_kernels(lat: float, lon: float, dlat: float, dlon: float, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Normalised float32 kernels of the eight directions for a place and pixel size."""
    y_m, x_m = pixel_size(lat, lon, dlat, dlon)
    out = {}
    for direction in LEANS:
        k = skewed(direction, y_m, x_m, window)
        out[direction] = (k / k.sum()).astype(np.float32)
    return out


def gaussian(dlat: float, radius_m: float = 300.0) -> np.ndarray:
    """One axis of the separable smoothing kernel: its size follows the radius, its width the size."""
    r = int(radius_m / (dlat * METERS_PER_DEGREE))
    k = max(3, 2 * r + 1)
    sigma = 0.3 * ((k - 1) / 2 - 1) + 0.8
    x = np.arange(k) - (k - 1) / 2
    w = np.exp(-x * x / (2 * sigma * sigma))
    return w / w.sum()


def taps(kernel: np.ndarray) -> list[tuple[int, int, float]]:
    """(dy, dx, weight) of the non-zero cells about the middle."""
    my, mx = kernel.shape[0] // 2, kernel.shape[1] // 2
    return [(int(y) - my, int(x) - mx, float(kernel[y, x])) for y, x in zip(*np.nonzero(kernel), strict=True)]
