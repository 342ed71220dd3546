"""Queries that compare scores and describe distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from cinderspark.operators import stats
from cinderspark.operators.quantiles import exact_quantiles
from cinderspark.plans import tables as T

_B = T.with_sql(b=T.BUILDINGS)
SCORES = (0.01, 0.1, 0.5, 1.0, 2.5)
PERCENTILES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def _pairs(spark, d):
    """Scores of two models, coarse enough to tie."""
    b = T.buildings(spark, d)
    return b.select("n_name", F.round(F.col("rps_2011").cast("double"), 1).alias("x"), F.round(F.col("rps_2047").cast("double"), 1).alias("y"))


def tau(spark, d):
    t = stats.grouped_tau_c(_pairs(spark, d), "n_name", "x", "y")
    return t.select("n_name", F.round("tau", 9).alias("tau"), "s", "n")


# Concordant less discordant pairs from the counts of distinct points: pairs of points, not of rows.
TAU_SQL = f"""{_B}, r AS (SELECT n_name, round(CAST(rps_2011 AS DOUBLE), 1) AS x, round(CAST(rps_2047 AS DOUBLE), 1) AS y FROM b),
p AS (SELECT n_name, x, y, count(*) AS k FROM r GROUP BY ALL),
s AS (SELECT a.n_name, CAST(sum(a.k * c.k * sign(a.x - c.x) * sign(a.y - c.y)) / 2 AS BIGINT) AS s FROM p a JOIN p c ON a.n_name = c.n_name GROUP BY a.n_name),
m AS (SELECT n_name, count(*) AS n, least(count(DISTINCT x), count(DISTINCT y)) AS m FROM r GROUP BY n_name)
SELECT n_name, round(2.0::DOUBLE * s / (CAST(n AS DOUBLE) * n * (m - 1) / m), 9) AS tau, s, n FROM s JOIN m USING (n_name)"""


def skill(spark, d):
    out = T.buildings(spark, d).groupBy("n_name").agg(*stats.skill("rps_2011", "rps_2047"))
    return out.select("n_name", *[F.round(c, 6).alias(c) for c in out.columns if c != "n_name"])


SKILL_SQL = f"""{_B}, r AS (SELECT n_name, CAST(rps_2011 AS DOUBLE) AS x, CAST(rps_2047 AS DOUBLE) AS y FROM b)
SELECT n_name, round(corr(x, y), 6) AS corr, round(avg(x - y), 6) AS bias, round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y, round(median(x), 6) AS median_x, round(median(y), 6) AS median_y,
round(count(CASE WHEN x = 0 THEN 1 END)::DOUBLE / count(x), 6) AS x_fract_zero, round(count(CASE WHEN y = 0 THEN 1 END)::DOUBLE / count(y), 6) AS y_fract_zero, round(avg(x - y) / avg(y), 6) AS normalized_bias
FROM r GROUP BY n_name"""


def hot(side: str, q: float):
    def run(spark, d):
        b = T.buildings(spark, d).select("l_orderkey", "l_linenumber", "rps_2011", "rps_2047")
        found = stats.hotspots(b, "rps_2011", "rps_2047", q, side)
        return found.select("l_orderkey", "l_linenumber", F.round(F.col("rps_2011").cast("double"), 6).alias("rps_2011"))

    return run


def hot_sql(side: str, q: float) -> str:
    op = ">" if side == "high" else "<"
    return f"""{_B}, q AS (SELECT quantile_cont(CAST(rps_2011 AS DOUBLE), {q}) AS x, quantile_cont(CAST(rps_2047 AS DOUBLE), {q}) AS y FROM b)
SELECT l_orderkey, l_linenumber, round(CAST(rps_2011 AS DOUBLE), 6) AS rps_2011 FROM b, q WHERE rps_2011 {op} x AND rps_2047 {op} y"""


def percentiles(spark, d):
    p = exact_quantiles(T.buildings(spark, d), ["r_name"], ["rps_2011"], PERCENTILES).withColumnRenamed("rps_2011_q", "p")
    return p.select("r_name", *[F.round(F.col("p")[k], 6).alias(f"p{k}") for k in range(len(PERCENTILES))])


PERCENTILES_SQL = f"{_B} SELECT r_name, {', '.join(f'round(quantile_cont(CAST(rps_2011 AS DOUBLE), {x}), 6) AS p{k}' for k, x in enumerate(PERCENTILES))} FROM b GROUP BY r_name"


def of_score(spark, d):
    p = stats.percentile_of_scores(T.buildings(spark, d), "rps_2011", SCORES)
    return p.select("score", F.round("percentile", 9).alias("percentile"))


OF_SCORE_SQL = f"""{_B}, s AS (SELECT CAST(unnest([{', '.join(map(str, SCORES))}]) AS DOUBLE) AS score)
SELECT score, round((count(CASE WHEN rps < score THEN 1 END) + count(CASE WHEN rps <= score THEN 1 END) + CASE WHEN count(CASE WHEN rps = score THEN 1 END) > 0 THEN 1 ELSE 0 END) * 50.0::DOUBLE / count(*), 9) AS percentile
FROM (SELECT CAST(rps_2011 AS DOUBLE) AS rps FROM b), s GROUP BY score"""


def _histogram(spark, d):
    """Burn values of the pixels in 200 bins, weighted by area-like weights."""
    return stats.weighted_histogram(T.pixels(spark, d), "v", "w", 0.0, 0.05, 200)


def histogram(spark, d):
    return _histogram(spark, d).select("bin", F.round("center", 9).alias("center"), F.round("weight", 5).alias("weight"), F.round("density", 9).alias("density"))


_HISTOGRAM = T.with_sql(p=T.PIXELS, k="SELECT CAST(least(floor(v / (0.05::DOUBLE / 200)), 199) AS INTEGER) AS bin, sum(w) AS weight FROM p WHERE v >= 0 AND v <= 0.05::DOUBLE GROUP BY ALL", h="SELECT bin, (bin + 0.5::DOUBLE) * (0.05::DOUBLE / 200) AS center, weight, weight / sum(weight) OVER () AS density FROM k")
HISTOGRAM_SQL = f"{_HISTOGRAM} SELECT bin, round(center, 9) AS center, round(weight, 5) AS weight, round(density, 9) AS density FROM h"


def weighted(spark, d):
    return stats.weighted_mean_median(_histogram(spark, d)).select(F.round("mean", 9).alias("mean"), F.round("median", 9).alias("median"))


WEIGHTED_SQL = f"""{_HISTOGRAM}, c AS (SELECT *, sum(density) OVER (ORDER BY bin) AS cdf FROM h), l AS (SELECT *, lag(cdf) OVER (ORDER BY bin) AS c0, lag(center) OVER (ORDER BY bin) AS x0 FROM c)
SELECT round(sum(center * density), 9) AS mean, round(max(CASE WHEN cdf >= 0.5 AND (c0 < 0.5 OR c0 IS NULL) THEN coalesce(x0 + (0.5 - c0) * (center - x0) / (cdf - c0), center) END), 9) AS median FROM l"""


def bottom(spark, d):
    """The ten customers' areas of least correlation (a top-k report)."""
    b = T.buildings(spark, d).groupBy("GEOID").agg(F.round(stats.corr("rps_2011", "rps_2047"), 6).alias("corr"), F.count(F.lit(1)).alias("n"))
    return stats.bottom_k(b.where(F.col("corr").isNotNull() & ~F.isnan("corr") & (F.col("n") > 5)), "corr", 10, "GEOID")


BOTTOM_SQL = f"""{_B}, c AS (SELECT GEOID, round(corr(CAST(rps_2011 AS DOUBLE), CAST(rps_2047 AS DOUBLE)), 6) AS corr, count(*) AS n FROM b GROUP BY GEOID)
SELECT * FROM c WHERE corr IS NOT NULL AND NOT isnan(corr) AND n > 5 ORDER BY corr, GEOID LIMIT 10"""


def summary(spark, d):
    """Extent, counts and means of the whole."""
    b = T.buildings(spark, d)
    return b.agg(F.count(F.lit(1)).alias("n"), F.round(F.min("lon"), 6).alias("xmin"), F.round(F.max("lat"), 6).alias("ymax"), F.round(F.avg("rps_2011"), 6).alias("mean"))


SUMMARY_SQL = f"{_B} SELECT count(*) AS n, round(min(lon), 6) AS xmin, round(max(lat), 6) AS ymax, round(avg(rps_2011), 6) AS mean FROM b"

PAIRED = ("rps_2011", "rps_2047", "lon")


def pairwise(spark, d):
    return stats.pairwise_corr(T.buildings(spark, d), PAIRED).select("a", "b", F.round("corr", 6).alias("corr"), "n")


PAIRWISE_SQL = _B + " UNION ALL ".join(
    f" SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM b" for a, b in combinations(PAIRED, 2)
)

QUERIES = {
    "kendall_tau_c": (tau, TAU_SQL),
    "score_skill": (skill, SKILL_SQL),
    "hotspots_high": (hot("high", 0.9), hot_sql("high", 0.9)),
    "hotspots_low": (hot("low", 0.3), hot_sql("low", 0.3)),
    "percentiles": (percentiles, PERCENTILES_SQL),
    "percentile_of_score": (of_score, OF_SCORE_SQL),
    "weighted_histogram": (histogram, HISTOGRAM_SQL),
    "weighted_cdf_median": (weighted, WEIGHTED_SQL),
    "bottom_k_corr": (bottom, BOTTOM_SQL),
    "global_summary": (summary, SUMMARY_SQL),
    "pairwise_corr": (pairwise, PAIRWISE_SQL),
}
