"""Hourly weather to wind-direction distributions during fire weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.functions import scalar as S


def quantile_over_time(hours: DataFrame, pixel: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """Exact quantile by pixel with linear interpolation; missing values are skipped."""
    return hours.groupBy(*pixel).agg(F.percentile(S.missing(F.col(value).cast("double")), F.lit(q)).alias(name))


def direction_counts(code: Column | str) -> list[Column]:
    """Aggregates: hours in each of the eight sectors."""
    return [F.count_if(S.col(code) == k).alias(f"n_{label.lower()}") for k, label in enumerate(S.DIRECTIONS)]


def direction_distribution(hours: DataFrame, pixel: Sequence[str], code: Column | str) -> DataFrame:
    """Share of hours by sector as an array of eight; zeros where there is no hour. Missing codes are skipped."""
    code = S.col(code)
    valid = F.count_if(code >= 0)
    shares = F.array(*[F.when(valid > 0, F.count_if(code == k) / valid).otherwise(F.lit(0.0)) for k in range(8)])
    return hours.groupBy(*pixel).agg(valid.alias("n_hours"), shares.alias("distribution"))


def fire_weather_distribution(hours: DataFrame, pixel: Sequence[str], degrees: str, index: str, q: float = 0.99) -> DataFrame:
    """Wind-direction distribution in the hours whose index exceeds its quantile at the pixel.

    The quantiles (one row a pixel) are joined back; both sides are dealt by pixel, so the
    second aggregation needs no further shuffle.
    """
    threshold = quantile_over_time(hours, pixel, index, q, "_threshold")
    masked = hours.join(threshold, list(pixel))
    code = F.when(F.col(index) > F.col("_threshold"), S.wind_class(degrees))
    return direction_distribution(masked.withColumn("_code", code), pixel, "_code")


def modal_direction(distribution: str = "distribution") -> Column:
    """The most frequent sector, the first of equals; null where all are zero or one is missing."""
    d = F.col(distribution)
    known = ~F.exists(d, lambda p: p.isNull()) & (F.aggregate(d, F.lit(0.0), lambda a, p: a + p) > 0)
    return F.when(known, S.first_argmax(d))


def circular_mean(degrees: Column | str) -> Column:
    """An aggregate: mean direction in [0, 360)."""
    r = F.radians(S.col(degrees))
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))


def incident_hours(incidents: DataFrame, hours: DataFrame, pixel: Sequence[str], hours_each_way: int = 12) -> DataFrame:
    """Each incident (id, when, pixel) with the hours (ts) around it at its pixel, ends included.

    The window is cut into day buckets, so that the range condition becomes an equal join on
    (pixel, day) followed by a filter.
    """
    span = F.expr(f"INTERVAL {hours_each_way} HOURS")
    days = F.sequence(F.to_date(F.col("when") - span), F.to_date(F.col("when") + span))
    left = incidents.withColumn("_day", F.explode(days))
    right = hours.withColumn("_day", F.to_date("ts"))
    near = left.join(right, [*pixel, "_day"]).drop("_day")
    return near.where((F.col("ts") >= F.col("when") - span) & (F.col("ts") <= F.col("when") + span))
