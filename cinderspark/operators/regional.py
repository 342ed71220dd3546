"""Statistics of buildings by geography.

Counts, means and histograms of all levels are one rollup of partial aggregates, so only one row for each
geography and task is shuffled. Medians do not add up: those of large geographies come from bounded
brackets (two more passes, whatever the levels), those of small ones from one aggregation a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.functions import scalar as S
from cinderspark.operators import joins
from cinderspark.operators.quantiles import exact_quantiles


def statistics(values: Sequence[str], histograms: Sequence[str], medians: bool = True) -> list[Column]:
    """Aggregates: building_count; mean and exact median of values; score histograms."""
    out = [F.count(F.lit(1)).alias("building_count")]
    out += [F.avg(v).alias(f"{v}_mean") for v in values]
    out += [F.median(v).cast("float").alias(f"{v}_median") for v in values if medians]
    return out + [S.score_histogram(v).alias(f"{v}_score_hist") for v in histograms]


def _with_medians(stats: DataFrame, found: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``stats`` joined with exact medians, in the columns' order."""
    medians = found.select(*keys, *[F.col(f"{v}_q")[0].cast("float").alias(f"{v}_median") for v in values])
    return stats.join(medians, list(keys), "left").select(*order)


def regional_statistics(buildings: DataFrame, key: Column | str, values: Sequence[str], histograms: Sequence[str] = (), large: bool = False) -> DataFrame:
    """One row for each geography: GEOID and the statistics.

    A task keeps a geography's distinct values for its medians unless ``large``, which suits any size.
    """
    keyed = buildings.withColumn("GEOID", S.col(key))
    if not large:
        return keyed.groupBy("GEOID").agg(*statistics(values, histograms))
    stats = keyed.groupBy("GEOID").agg(*statistics(values, histograms, medians=False))
    order = ["GEOID", *[F.col(c).alias(c) for c in _names(values, histograms)]]
    return _with_medians(stats, exact_quantiles(keyed, ["GEOID"], values, [0.5]), ["GEOID"], values, order)


def _names(values: Sequence[str], histograms: Sequence[str]) -> list[str]:
    return ["building_count", *[f"{v}_mean" for v in values], *[f"{v}_median" for v in values], *[f"{v}_score_hist" for v in histograms]]


def nested_statistics(buildings: DataFrame, levels: Sequence[tuple[str, Column]], values: Sequence[str], histograms: Sequence[str] = (), large: Sequence[str] = ("nation", "state", "county")) -> DataFrame:
    """All levels of a nested geography, whole to finest; all but the medians from one rollup of partial aggregates.

    Returns ``level`` (its name) and ``GEOID``; the whole is level ``nation`` with GEOID ``US``.
    Medians do not add up: those of the ``large`` levels come from bounded brackets
    (``exact_quantiles``), those of finer ones from their few values.
    """
    named = buildings.select("*", *[expr.alias(f"_{name}") for name, expr in levels])
    keys = [f"_{name}" for name, _ in levels]
    rolled = named.rollup(*keys).agg(F.grouping_id().alias("_gid"), *statistics(values, histograms, medians=False))
    level = F.lit("nation")
    geoid = F.lit("US")
    for k, (name, _) in enumerate(levels):
        # The bits of the grouping id are set for the keys that are rolled up.
        gid = (1 << (len(levels) - 1 - k)) - 1
        level = F.when(F.col("_gid") == gid, F.lit(name)).otherwise(level)
        geoid = F.when(F.col("_gid") == gid, F.col(keys[k])).otherwise(geoid)
    stats = rolled.select(level.alias("level"), geoid.alias("GEOID"), *[c for c in rolled.columns if c not in ("_gid", *keys)])
    places = [("nation", F.lit("US")), *((name, F.col(f"_{name}")) for name, _ in levels)]
    kept = [F.struct(F.lit(n).alias("level"), g.alias("GEOID")) for n, g in places if n in large]
    found = None
    if kept:
        each = named.select(F.explode(F.array(*kept)).alias("_p"), *values).select("_p.*", *values)
        found = exact_quantiles(each, ["level", "GEOID"], values, [0.5])
    for name, place in places:
        if name not in large:
            few = named.groupBy(place.alias("GEOID")).agg(*[F.array(F.median(v)).alias(f"{v}_q") for v in values])
            few = few.select(F.lit(name).alias("level"), "GEOID", *[f"{v}_q" for v in values])
            found = few if found is None else found.unionByName(few)
    order = ["level", "GEOID", *_names(values, histograms)]
    return _with_medians(stats, found, ["level", "GEOID"], values, order)


def polygon_statistics(
    buildings: DataFrame, polygons: DataFrame, x: str, y: str, size: float, values: Sequence[str], histograms: Sequence[str] = (), key: str = "GEOID", geometry: str = "geometry",
    large: bool = False,
) -> DataFrame:
    """Statistics of the buildings in each polygon, with the polygons' attributes and shapes.

    A building is in every polygon that its place is in or on. Cells of ``size`` degrees find the candidates; only
    keys and values go through the aggregation, attributes and shapes join its few rows. Polygons of equal shapes
    are one geography until then. Polygons without buildings are absent.
    """
    shapes, members = joins.shape_classes(polygons, key, geometry)
    columns = list(dict.fromkeys([x, y, *values, *histograms]))
    met = joins.spatial_join(buildings.select(*columns), shapes, x, y, "_shape", size).drop("_shape")
    found = regional_statistics(met.drop(*[c for c in (x, y) if c not in (*values, *histograms)]), "_class", values, histograms, large)
    return members.join(found.withColumnRenamed("GEOID", "_class"), "_class").drop("_class").join(polygons, key)


def with_names(statistics_: DataFrame, names: DataFrame, on: str = "GEOID") -> DataFrame:
    """Attributes joined to the few aggregated rows, not to the buildings."""
    return statistics_.join(names, on, "left")


def partition_keys(buildings: DataFrame, geoid: str = "GEOID") -> DataFrame:
    """state_fips and county_fips as text, leading zeros kept."""
    return buildings.withColumns({"state_fips": F.substring(geoid, 1, 2), "county_fips": F.substring(geoid, 3, 3)})


def validate_probabilities(df: DataFrame, array: str, tolerance: float = 1e-5) -> DataFrame:
    """Fails on a negative probability; adds ``sums_to_one``."""
    bad = F.exists(array, lambda p: p < 0)
    total = F.aggregate(array, F.lit(0.0), lambda a, p: a + F.coalesce(p.cast("double"), F.lit(0.0)))
    checked = F.when(bad, F.raise_error(F.lit("negative probability"))).otherwise(F.abs(total - 1) <= F.lit(tolerance))
    return df.withColumn("sums_to_one", checked.cast("boolean"))
