"""Queries on buildings by geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.functions import scalar as S
from cinderspark.operators import regional
from cinderspark.plans import tables as T

VALUES = ("rps_2011", "rps_2047", "bp_2011", "bp_2047", "crps_scott")
HISTOGRAMS = ("rps_2011", "rps_2047")
_B = T.with_sql(b=T.BUILDINGS)


def _text(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)


def _flat(df):
    """Means rounded, histograms as text."""
    out = []
    for name in df.columns:
        if name.endswith("_hist"):
            out.append(_text(name))
        elif name.endswith(("_mean", "_median")):
            out.append(F.round(F.col(name).cast("double"), 6).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def _bins(value: str) -> str:
    edges = [f"CAST({e} AS FLOAT)" for e in S.SCORE_EDGES]
    parts = [f"count(CASE WHEN {value} = 0 THEN 1 END)", f"count(CASE WHEN {value} <> 0 AND {value} <= {edges[0]} THEN 1 END)"]
    parts += [f"count(CASE WHEN {value} > {lo} AND {value} <= {hi} THEN 1 END)" for lo, hi in zip(edges, edges[1:])]
    return " || ',' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


def _statistics_sql(values=VALUES, histograms=HISTOGRAMS) -> str:
    out = ["count(*) AS building_count"]
    out += [f"round(avg({v}), 6) AS {v}_mean" for v in values]
    out += [f"round(CAST(CAST(median(CAST({v} AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS {v}_median" for v in values]
    return ", ".join(out + [f"{_bins(v)} AS {v}_score_hist" for v in histograms])


def by_nation(spark, d):
    return _flat(regional.regional_statistics(T.buildings(spark, d), "n_name", VALUES, HISTOGRAMS, large=True))


def by_prefix(n: int):
    """States and counties are large; tracts are not."""
    return lambda spark, d: _flat(regional.regional_statistics(T.buildings(spark, d), F.substring("GEOID", 1, n), VALUES, HISTOGRAMS, large=n <= 5))


def prefix_sql(n: int) -> str:
    return f"{_B} SELECT substring(GEOID, 1, {n}) AS GEOID, {_statistics_sql()} FROM b GROUP BY ALL"


def rollup(spark, d):
    levels = [("state", F.substring("GEOID", 1, 2)), ("county", F.substring("GEOID", 1, 5)), ("tract", F.col("GEOID"))]
    return _flat(regional.nested_statistics(T.buildings(spark, d), levels, ("rps_2011", "rps_2047"), ("rps_2011",)))


_LEVELS = (("nation", "'US'"), ("state", "substring(GEOID, 1, 2)"), ("county", "substring(GEOID, 1, 5)"), ("tract", "GEOID"))
ROLLUP_SQL = _B + " " + " UNION ALL ".join(
    f"SELECT '{level}' AS level, {key} AS GEOID, {_statistics_sql(('rps_2011', 'rps_2047'), ('rps_2011',))} FROM b GROUP BY {key}" if level != "nation"
    else f"SELECT 'nation' AS level, 'US' AS GEOID, {_statistics_sql(('rps_2011', 'rps_2047'), ('rps_2011',))} FROM b"
    for level, key in _LEVELS
)


def named(spark, d):
    """Statistics by nation with the region's attributes joined to the aggregated rows."""
    b = T.buildings(spark, d)
    stats = _flat(regional.regional_statistics(b, "n_name", ("rps_2011",)))
    nations = T.table(spark, d, "nation").join(T.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return regional.with_names(stats, nations.select(F.col("n_name").alias("GEOID"), F.col("r_name").alias("NAME")))


NAMED_SQL = f"""{_B}, s AS (SELECT n_name AS GEOID, {_statistics_sql(('rps_2011',), ())} FROM b GROUP BY n_name)
SELECT s.*, r_name AS NAME FROM s LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) ON GEOID = n_name"""


def scores(closed: str):
    def run(spark, d):
        b = T.buildings(spark, d)
        return b.groupBy(S.risk_score("rps_2011", closed).alias("score")).agg(F.count(F.lit(1)).alias("n"))

    return run


def scores_sql(closed: str) -> str:
    op = "<=" if closed == "right" else "<"
    whens = " ".join(f"WHEN rps_2011 {op} CAST({e} AS FLOAT) THEN {k + 1}" for k, e in enumerate(S.SCORE_EDGES))
    rest = " ELSE 10" if closed == "left" else ""
    return f"{_B} SELECT CAST(CASE WHEN rps_2011 = 0 THEN 0 {whens}{rest} END AS INTEGER) AS score, count(*) AS n FROM b GROUP BY ALL"


def numpy_bins(spark, d):
    edges = [0.0, *S.SCORE_EDGES]
    return T.buildings(spark, d).groupBy("r_name").agg(S.bin_counts("rps_2011", edges, "left").alias("counts")).select("r_name", _text("counts"))


def numpy_bins_sql() -> str:
    e = [f"CAST({x} AS FLOAT)" for x in (0.0, *S.SCORE_EDGES)]
    parts = [f"count(CASE WHEN rps_2011 >= {lo} AND rps_2011 {'<=' if k == len(e) - 2 else '<'} {hi} THEN 1 END)" for k, (lo, hi) in enumerate(zip(e, e[1:]))]
    return f"{_B} SELECT r_name, {' || chr(44) || '.join(f'CAST({p} AS VARCHAR)' for p in parts)} AS counts FROM b GROUP BY r_name"


def keys(spark, d):
    split = regional.partition_keys(T.buildings(spark, d))
    return split.groupBy("state_fips", "county_fips").agg(F.count(F.lit(1)).alias("n"), F.max("GEOID").alias("last"))


KEYS_SQL = f"{_B} SELECT substring(GEOID, 1, 2) AS state_fips, substring(GEOID, 3, 3) AS county_fips, count(*) AS n, max(GEOID) AS last FROM b GROUP BY ALL"


def fips_lookup(spark, d):
    """Left join of buildings' keys with a lookup that lacks some of them."""
    b = regional.partition_keys(T.buildings(spark, d))
    lookup = T.table(spark, d, "nation").where(F.col("n_nationkey") >= 5)
    lookup = lookup.select(F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("state_fips"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("county_fips"), F.col("n_name").alias("county_name"))
    joined = b.join(lookup, ["state_fips", "county_fips"], "left")
    return joined.groupBy("state_fips", "county_fips", "county_name").agg(F.count(F.lit(1)).alias("n"))


FIPS_SQL = f"""{_B}, k AS (SELECT substring(GEOID, 1, 2) AS state_fips, substring(GEOID, 3, 3) AS county_fips FROM b),
f AS (SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS s, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS c, n_name FROM nation WHERE n_nationkey >= 5)
SELECT state_fips, county_fips, n_name AS county_name, count(*) AS n FROM k LEFT JOIN f ON state_fips = s AND county_fips = c GROUP BY ALL"""


def county_filter(spark, d):
    """One county's buildings by its codes, without the columns of place (star-except)."""
    b = regional.partition_keys(T.buildings(spark, d)).where((F.col("state_fips") == "01") & F.col("county_fips").isin("001", "002", "003", "017", "024"))
    return b.drop("lon", "lat", "n_name", "r_name", "bp_2011", "bp_2047").select("l_orderkey", "l_linenumber", "GEOID", F.round(F.col("rps_2011").cast("double"), 6).alias("rps_2011"))


COUNTY_SQL = f"""{_B} SELECT l_orderkey, l_linenumber, GEOID, round(CAST(rps_2011 AS DOUBLE), 6) AS rps_2011 FROM b
WHERE substring(GEOID, 1, 2) = '01' AND substring(GEOID, 3, 3) IN ('001', '002', '003', '017', '024')"""


def complete_rows(spark, d):
    """Buildings whose values are all known: zero burn probability stands for missing here."""
    b = T.buildings(spark, d)
    known = b.withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in ("bp_2011", "bp_2047")}).na.drop("any", subset=["bp_2011", "bp_2047"])
    return known.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))


COMPLETE_SQL = f"{_B} SELECT r_name, count(*) AS n FROM b WHERE bp_2011 > 0 AND bp_2047 > 0 GROUP BY r_name"


def match_rate(spark, d):
    b = T.buildings(spark, d)
    same = S.risk_score("rps_2011") == S.risk_score("rps_2047")
    return b.groupBy("n_name").agg(F.round(F.avg(same.cast("int")), 9).alias("match_rate"), F.bool_and(F.col("bp_2011") == 0).alias("all_zero"))


def match_sql() -> str:
    score = lambda c: "CASE WHEN " + c + " = 0 THEN 0 " + " ".join(f"WHEN {c} <= CAST({e} AS FLOAT) THEN {k + 1}" for k, e in enumerate(S.SCORE_EDGES)) + " END"
    return f"{_B} SELECT n_name, round(avg(CASE WHEN {score('rps_2011')} = {score('rps_2047')} THEN 1 ELSE 0 END), 9) AS match_rate, bool_and(bp_2011 = 0) AS all_zero FROM b GROUP BY n_name"


def by_polygon(spark, d):
    """Buildings by the triangles that hold them, with a name of each and its shape's centre."""
    b = T.buildings(spark, d).select((F.col("lon") + 0.031).alias("lon"), (F.col("lat") + 0.017).alias("lat"), "rps_2011", "rps_2047")
    named = T.triangles(spark, d).withColumn("NAME", F.concat(F.lit("area "), F.col("area_id")))
    s = regional.polygon_statistics(b, named, "lon", "lat", 1.5, ["rps_2011", "rps_2047"], ["rps_2011"], key="area_id")
    s = s.withColumn("c", geo.centroid_udf("geometry"))
    rounded = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("rps_2011_mean", "rps_2047_mean", "rps_2011_median", "rps_2047_median")]
    return s.select("area_id", "NAME", "building_count", *rounded, F.col("rps_2011_score_hist")[0].alias("zeros"), F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


BY_POLYGON_SQL = T.with_sql(b=T.BUILDINGS, c=T.AREAS, q="SELECT lon + 0.031::DOUBLE AS x, lat + 0.017::DOUBLE AS y, rps_2011, rps_2047 FROM b") + """
SELECT area_id, 'area ' || area_id AS NAME, count(*) AS building_count, round(avg(CAST(rps_2011 AS DOUBLE)), 6) AS rps_2011_mean, round(avg(CAST(rps_2047 AS DOUBLE)), 6) AS rps_2047_mean,
round(CAST(CAST(median(CAST(rps_2011 AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS rps_2011_median, round(CAST(CAST(median(CAST(rps_2047 AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS rps_2047_median,
count(*) FILTER (rps_2011 = 0) AS zeros, round((2 * min(xmin) + min(xmax)) / 3, 6) AS x, round((2 * min(ymin) + min(ymax)) / 3, 6) AS y
FROM q JOIN c ON x >= xmin AND y >= ymin AND (xmax - xmin) * (y - ymin) + (ymax - ymin) * (x - xmin) <= (xmax - xmin) * (ymax - ymin) GROUP BY area_id"""


QUERIES = {
    "regional_stats_polygon": (by_polygon, BY_POLYGON_SQL),
    "regional_stats_nation": (by_nation, f"{_B} SELECT n_name AS GEOID, {_statistics_sql()} FROM b GROUP BY n_name"),
    "regional_stats_state": (by_prefix(2), prefix_sql(2)),
    "regional_stats_county": (by_prefix(5), prefix_sql(5)),
    "regional_stats_tract": (by_prefix(14), prefix_sql(14)),
    "regional_stats_rollup": (rollup, ROLLUP_SQL),
    "regional_stats_named": (named, NAMED_SQL),
    "score_counts_right": (scores("right"), scores_sql("right")),
    "score_counts_left": (scores("left"), scores_sql("left")),
    "score_bins_numpy": (numpy_bins, numpy_bins_sql()),
    "partition_keys": (keys, KEYS_SQL),
    "fips_lookup": (fips_lookup, FIPS_SQL),
    "county_filter": (county_filter, COUNTY_SQL),
    "complete_rows": (complete_rows, COMPLETE_SQL),
    "score_match_rate": (match_rate, match_sql()),
}
