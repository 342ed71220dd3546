"""Evaluation statistics: rank correlation, skill, weighted distributions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderspark.functions import scalar as S
from cinderspark.operators.quantiles import exact_quantiles


#: Inversions are counted directly in blocks of this many values, and by merging beyond.
BLOCK = 64


def _inversions(y: np.ndarray, w: np.ndarray | None = None) -> int:
    """Weight of the pairs i < j with y[i] > y[j] (one each without weights): whole blocks compared at once, then bottom-up merging with vector searches."""
    w = np.ones(len(y), np.int64) if w is None else w
    n, total = len(y), 0
    size = -(-n // BLOCK) * BLOCK
    blocks, weights = np.full(size, np.inf), np.zeros(size, np.int64)
    blocks[:n], weights[:n] = y, w
    blocks, weights = blocks.reshape(-1, BLOCK), weights.reshape(-1, BLOCK)
    before = np.triu(np.ones((BLOCK, BLOCK), bool), 1)
    for start in range(0, len(blocks), 256):
        part, own = blocks[start : start + 256], weights[start : start + 256]
        beaten = ((part[:, :, None] > part[:, None, :]) & before) * own[:, None, :]
        total += int((beaten.sum(axis=2) * own).sum())
    order = np.argsort(blocks, axis=1, kind="stable")
    y, w = (np.take_along_axis(a, order, axis=1).ravel()[:n] for a in (blocks, weights))
    width = BLOCK
    while width < n:
        for start in range(0, n - width, 2 * width):
            both, middle = slice(start, start + 2 * width), start + width
            left, right = y[start:middle], y[middle : start + 2 * width]
            up_to = np.concatenate([[0], np.cumsum(w[start:middle])])
            total += int((w[middle : start + 2 * width] * (up_to[-1] - up_to[np.searchsorted(left, right, side="right")])).sum())
            order = np.argsort(y[both], kind="stable")
            y[both], w[both] = y[both][order], w[both][order]
        width *= 2
    return total


def _tallies(w: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Weights of the distinct keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(w), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    return np.add.reduceat(w[order], np.flatnonzero(new)) if len(w) else w


def _tied(w: np.ndarray, *keys: np.ndarray) -> int:
    counts = _tallies(w, *keys)
    return int((counts * (counts - 1) // 2).sum())


def tau_c(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> tuple[float, int]:
    """(Stuart's tau-c, concordant less discordant pairs) in O(n log n); ``w`` counts each point's rows."""
    w = np.ones(len(x), np.int64) if w is None else w
    keep = ~(np.isnan(x) | np.isnan(y))
    x, y, w = x[keep], y[keep], w[keep].astype(np.int64)
    n = int(w.sum())
    m = min(len(np.unique(x)), len(np.unique(y)))
    if m < 2:
        return float("nan"), 0
    order = np.lexsort((y, x))
    discordant = _inversions(y[order], w[order])
    untied = n * (n - 1) // 2 - _tied(w, x) - _tied(w, y) + _tied(w, x, y)
    s = untied - 2 * discordant
    return 2 * s / (n * n * (m - 1) / m), s


def tau_c_p_value(x: np.ndarray, y: np.ndarray, s: int, w: np.ndarray | None = None) -> float:
    """Two-sided p of no association by the normal approximation with ties."""
    from math import erfc, sqrt

    w = np.ones(len(x), np.int64) if w is None else w
    n = int(w.sum())

    def moments(v):
        c = _tallies(w, v).astype(float)
        return (c * (c - 1)).sum() / 2, (c * (c - 1) * (c - 2)).sum(), (c * (c - 1) * (2 * c + 5)).sum()

    x1, x0, x2 = moments(x)
    y1, y0, y2 = moments(y)
    base = n * (n - 1.0)
    variance = (base * (2 * n + 5) - x2 - y2) / 18 + 2 * x1 * y1 / base + x0 * y0 / (9 * base * (n - 2)) if n > 2 else 0.0
    return erfc(abs(s) / sqrt(variance) / sqrt(2)) if variance > 0 else float("nan")


def grouped_tau_c(pairs: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """tau-c, S and p by group, by sorting in Arrow batches: no pair of rows is ever formed.

    A group is one task's work; equal (x, y) points are counted before the shuffle and stay counted,
    so a group takes the memory of its distinct points, not of its rows.
    """
    points = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    points = points.groupBy(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        x_, y_, w = (group[c].to_numpy() for c in ("x", "y", "n"))
        tau, s = tau_c(x_, y_, w)
        return pd.DataFrame({"key": [group["key"].iloc[0]], "tau": [tau], "s": [s], "p_value": [tau_c_p_value(x_, y_, s, w)], "n": [int(w.sum())]})

    kind = dict(pairs.dtypes)[key]
    return points.groupBy("key").applyInPandas(run, f"key {kind}, tau double, s long, p_value double, n long").withColumnRenamed("key", key)


def corr(x: Column | str, y: Column | str) -> Column:
    """Pearson's correlation over the pairs without a null; null without pairs, NaN where one side is constant.

    Spark's own divides by zero there, which fails in ANSI mode. A side is constant if its least and greatest values
    are equal: sums merged from several tasks need not come to exactly zero.
    """
    x, y = S.col(x).cast("double"), S.col(y).cast("double")
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    constant = (F.min(px) == F.max(px)) | (F.min(py) == F.max(py))
    value = F.try_divide(F.covar_pop(x, y), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(F.count(px) > 0, F.when(constant, F.lit(float("nan"))).otherwise(F.coalesce(value, F.lit(float("nan")))))


def pairwise_corr(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """a, b, corr, n for every two of the columns, from one aggregation; rows with a null in either do not count."""
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr(a, b).alias("corr"), F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("n")) for a, b in combinations(names, 2)]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def skill(x: Column | str, y: Column | str) -> list[Column]:
    """Aggregates comparing two scores: corr, bias, means, medians, shares of zero, normalised bias."""
    x, y = S.col(x).cast("double"), S.col(y).cast("double")
    return [
        corr(x, y).alias("corr"),
        F.avg(x - y).alias("bias"),
        F.avg(x).alias("mean_x"),
        F.avg(y).alias("mean_y"),
        F.median(x).alias("median_x"),
        F.median(y).alias("median_y"),
        (F.count_if(x == 0) / F.count(x)).alias("x_fract_zero"),
        (F.count_if(y == 0) / F.count(y)).alias("y_fract_zero"),
        F.try_divide(F.avg(x - y), F.avg(y)).alias("normalized_bias"),
    ]


def hotspots(df: DataFrame, x: str, y: str, q: float, side: str = "high") -> DataFrame:
    """Rows beyond the exact q-quantile of both columns; the two limits are one broadcast row."""
    limits = exact_quantiles(df, [], [x, y], [q]).select(F.col(f"{x}_q")[0].alias("_qx"), F.col(f"{y}_q")[0].alias("_qy"))
    joined = df.join(F.broadcast(limits))
    beyond = (F.col(x) > F.col("_qx")) & (F.col(y) > F.col("_qy")) if side == "high" else (F.col(x) < F.col("_qx")) & (F.col(y) < F.col("_qy"))
    return joined.where(beyond).drop("_qx", "_qy")


def percentile_of_scores(df: DataFrame, value: str, scores: Sequence[float]) -> DataFrame:
    """Percentile rank of each score among the values (mean of strict and weak, ties counted half up)."""
    v = F.col(value).cast("double")
    sums = df.agg(*[F.count_if(v < s).alias(f"l{k}") for k, s in enumerate(scores)], *[F.count_if(v <= s).alias(f"r{k}") for k, s in enumerate(scores)], F.count(v).alias("n"))
    rows = F.array(*[F.struct(F.lit(float(s)).alias("score"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"), F.col("n")) for k, s in enumerate(scores)])
    out = sums.select(F.explode(rows).alias("x")).select("x.*")
    # The kind "rank": (left + right + [some equal]) * 50 / n.
    return out.select("score", ((F.col("l") + F.col("r") + (F.col("l") < F.col("r")).cast("int")) * F.lit(50.0) / F.col("n")).alias("percentile"))


def weighted_histogram(df: DataFrame, value: Column | str, weight: Column | str, low: float, high: float, bins: int) -> DataFrame:
    """bin, center, weight, density: equal bins [low, high), the last one closed; empty bins are absent."""
    v, width = S.col(value), (high - low) / bins
    at = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    inside = df.where((v >= low) & (v <= high))
    binned = inside.groupBy(at.alias("bin")).agg(F.sum(S.col(weight)).alias("weight"))
    # At most `bins` rows reach this window.
    density = F.col("weight") / F.sum("weight").over(Window.partitionBy())
    return binned.select("bin", (F.lit(low) + (F.col("bin") + F.lit(0.5)) * F.lit(width)).alias("center"), "weight", density.alias("density"))


def weighted_mean_median(histogram: DataFrame) -> DataFrame:
    """mean and median of a weighted histogram, the median interpolated where the CDF crosses one half."""
    order = Window.orderBy("bin")
    cdf = F.sum("density").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = histogram.withColumn("cdf", cdf)
    rows = rows.withColumns({"cdf0": F.lag("cdf").over(order), "center0": F.lag("center").over(order)})
    between = F.col("center0") + (F.lit(0.5) - F.col("cdf0")) * (F.col("center") - F.col("center0")) / (F.col("cdf") - F.col("cdf0"))
    crossing = F.when((F.col("cdf") >= 0.5) & ((F.col("cdf0") < 0.5) | F.col("cdf0").isNull()), F.coalesce(between, F.col("center")))
    return rows.agg(F.sum(F.col("center") * F.col("density")).alias("mean"), F.max(crossing).alias("median"))


def bottom_k(df: DataFrame, column: str, k: int, *ties: str) -> DataFrame:
    """The k rows of least value (a top-k report): a TakeOrderedAndProject, no full sort."""
    return df.orderBy(F.col(column).asc_nulls_last(), *ties).limit(k)
