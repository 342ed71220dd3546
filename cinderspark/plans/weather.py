"""Queries on hourly weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderspark.functions import scalar as S
from cinderspark.operators import weather
from cinderspark.plans import tables as T
from cinderspark.streaming import incremental

_H = T.with_sql(h=T.HOURS)
_CODE = "CAST(floor((((degrees + 22.5) % 360) + 360) % 360 / 45) AS INTEGER)"
_EMC = """CASE WHEN rh < 10 THEN 0.03229 + 0.281073 * rh - 0.000578 * rh * t_f WHEN rh <= 50 THEN 2.22749 + 0.160107 * rh - 0.01478 * t_f
 WHEN rh <= 100 THEN 21.0606 + 0.005565 * rh * rh - 0.00035 * rh * t_f - 0.483199 * rh END"""
_INDEX = f"""SELECT *, (1 - 2 * m + 1.5 * m * m - 0.5 * m * m * m) * sqrt(1 + wind * wind) AS ffwi, {_CODE} AS code FROM (SELECT *, ({_EMC}) / 30 AS m FROM h)"""
_I = T.with_sql(h=T.HOURS, i=_INDEX)


def _hours(spark, d):
    h = T.hours(spark, d)
    return h.withColumn("ffwi", S.fosberg_index("rh", "t_f", "wind")).withColumn("code", S.wind_class("degrees"))


def classes(spark, d):
    return _hours(spark, d).select("event_id", "code", S.wind_label("code").alias("label"))


_LABELS = " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(S.DIRECTIONS))
CLASSES_SQL = f"{_I} SELECT event_id, code, CASE code {_LABELS} END AS label FROM i"


def shares(df):
    return df.select("pixel", "n_hours", *[F.round(F.col("distribution")[k], 9).alias(f"p_{label.lower()}") for k, label in enumerate(S.DIRECTIONS)])


def histogram(spark, d):
    return shares(weather.direction_distribution(_hours(spark, d), ["pixel"], "code"))


def _shares_sql(code: str) -> str:
    return ", ".join(
        f"round(CASE WHEN count(CASE WHEN {code} >= 0 THEN 1 END) > 0 THEN CAST(count(CASE WHEN {code} = {k} THEN 1 END) AS DOUBLE) / count(CASE WHEN {code} >= 0 THEN 1 END) ELSE 0.0 END, 9) AS p_{x.lower()}"
        for k, x in enumerate(S.DIRECTIONS)
    )


HISTOGRAM_SQL = f"{_I} SELECT pixel, count(CASE WHEN code >= 0 THEN 1 END) AS n_hours, {_shares_sql('code')} FROM i GROUP BY pixel"


def fire_weather(spark, d):
    return shares(weather.fire_weather_distribution(_hours(spark, d), ["pixel"], "degrees", "ffwi", 0.9))


FIRE_SQL = f"""{_I}, q AS (SELECT pixel AS px, quantile_cont(ffwi, 0.9) AS t FROM i GROUP BY pixel),
m AS (SELECT pixel, CASE WHEN ffwi > t THEN code END AS c FROM i JOIN q ON pixel = px)
SELECT pixel, count(CASE WHEN c >= 0 THEN 1 END) AS n_hours, {_shares_sql('c')} FROM m GROUP BY pixel"""


def modal(spark, d):
    return weather.fire_weather_distribution(_hours(spark, d), ["pixel"], "degrees", "ffwi", 0.9).select("pixel", weather.modal_direction().alias("mode"))


MODAL_SQL = f"""{_I}, q AS (SELECT pixel AS px, quantile_cont(ffwi, 0.9) AS t FROM i GROUP BY pixel),
m AS (SELECT pixel, CASE WHEN ffwi > t THEN code END AS c FROM i JOIN q ON pixel = px),
n AS (SELECT pixel, c, count(*) AS k FROM m WHERE c IS NOT NULL GROUP BY pixel, c),
r AS (SELECT pixel, c, row_number() OVER (PARTITION BY pixel ORDER BY k DESC, c) AS place FROM n)
SELECT p.pixel, r.c AS mode FROM (SELECT DISTINCT pixel FROM h) p LEFT JOIN r ON p.pixel = r.pixel AND place = 1"""


def index(spark, d):
    return _hours(spark, d).select("event_id", F.round("ffwi", 6).alias("ffwi"), S.red_flag("rh", F.col("wind") * 2).alias("red_flag"))


INDEX_SQL = f"{_I} SELECT event_id, round(ffwi, 6) AS ffwi, rh < 15 AND 1.4 * (wind * 2) > 35 AS red_flag FROM i"


def p99(spark, d):
    return weather.quantile_over_time(_hours(spark, d), ["pixel"], "ffwi", 0.99, "p99").select("pixel", F.round("p99", 6).alias("p99"))


P99_SQL = f"{_I} SELECT pixel, round(quantile_cont(ffwi, 0.99), 6) AS p99 FROM i GROUP BY pixel"


def rotation(spark, d):
    h = T.hours(spark, d)
    a = F.radians(F.col("event_id") % 90)
    u, v = S.rotate_wind(F.col("wind") - 10, F.col("rh") / 10 - 5, F.sin(a), F.cos(a))
    h = h.withColumns({"u": u, "v": v})
    return h.select("event_id", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"), F.round(S.wind_speed("u", "v"), 6).alias("speed"), F.round(S.wind_from("u", "v"), 5).alias("wind_from"))


ROTATION_SQL = f"""{_H}, a AS (SELECT *, radians(event_id % 90) AS a FROM h),
r AS (SELECT event_id, (wind - 10) * cos(a) - (rh / 10 - 5) * sin(a) AS u, (rh / 10 - 5) * cos(a) + (wind - 10) * sin(a) AS v FROM a),
f AS (SELECT *, sqrt(u * u + v * v) AS s, (((180 + degrees(atan2(u, v))) % 360) + 360) % 360 AS d FROM r)
SELECT event_id, round(u, 6) AS u, round(v, 6) AS v, round(s, 6) AS speed, round(CASE WHEN s < 0.5 THEN 0 WHEN d = 0 THEN 360 ELSE d END, 5) AS wind_from FROM f"""


def humidity(spark, d):
    h = T.hours(spark, d).withColumns({"t": F.lit(270.0) + F.col("t_f") / 2, "td": F.lit(268.0) + F.col("t_f") / 2 - F.col("wind") / 2})
    return h.select("event_id", F.round(S.relative_humidity("t", "td"), 6).alias("rh"), F.round(S.kelvin_to_fahrenheit("t"), 6).alias("t_f"))


_ES = lambda t: f"100 * exp(-6096.9385 / {t} + 16.635794 - 2.711193e-2 * {t} + 1.673952e-5 * {t} * {t} + 2.433502 * ln({t}))"
HUMIDITY_SQL = f"""{_H}, k AS (SELECT event_id, CAST(270 AS DOUBLE) + t_f / 2 AS t, CAST(268 AS DOUBLE) + t_f / 2 - wind / 2 AS td FROM h)
SELECT event_id, round(greatest(0, least(100, 100 * ({_ES('td')}) / ({_ES('t')}))), 6) AS rh, round((t - 273.15) * 9 / 5 + 32, 6) AS t_f FROM k"""


def circular(spark, d):
    return T.hours(spark, d).groupBy("pixel").agg(F.round(weather.circular_mean("degrees"), 5).alias("mean_direction"))


CIRCULAR_SQL = f"""{_H} SELECT pixel, round(((degrees(atan2(avg(sin(radians(degrees))), avg(cos(radians(degrees))))) % 360) + 360) % 360, 5) AS mean_direction FROM h GROUP BY pixel"""


def incidents(spark, d):
    """Around every purchase: how many hours within 12 hours at the same pixel, and their mean direction."""
    events = T.table(spark, d, "events").where(F.col("event_type") == "purchase").select(F.col("event_id").alias("id"), F.col("ts").alias("when"), F.col("user_id").alias("pixel"))
    near = weather.incident_hours(events, T.hours(spark, d), ["pixel"])
    return near.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(weather.circular_mean("degrees"), 4).alias("mean_direction"))


INCIDENTS_SQL = f"""{_H}, e AS (SELECT event_id AS id, ts AS t0, user_id AS px FROM events WHERE event_type = 'purchase')
SELECT id, count(*) AS n, round(((degrees(atan2(avg(sin(radians(degrees))), avg(cos(radians(degrees))))) % 360) + 360) % 360, 4) AS mean_direction
FROM e JOIN h ON pixel = px AND ts BETWEEN t0 - INTERVAL 12 HOUR AND t0 + INTERVAL 12 HOUR GROUP BY id"""


def daily(spark, d):
    counted = incremental.hourly_direction_counts(T.hours(spark, d).select("pixel", "ts", "degrees"))
    return counted.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


DAILY_SQL = f"""{_I} SELECT pixel, strftime(ts, '%Y-%m-%d') AS day, {', '.join(f"count(CASE WHEN code = {k} THEN 1 END) AS n_{x.lower()}" for k, x in enumerate(S.DIRECTIONS))} FROM i GROUP BY ALL"""


def json_events(spark, d):
    """Numbers and text as JSON, nulls kept, read back by field."""
    h = T.hours(spark, d).withColumn("gust", F.when(F.col("wind") > 5, F.col("wind") * 1.5))
    made = h.select("event_id", S.to_json(F.col("pixel"), F.col("gust"), S.wind_label(S.wind_class("degrees")).alias("label")).alias("j"))
    return made.select("event_id", F.get_json_object("j", "$.pixel").cast("long").alias("pixel"), F.get_json_object("j", "$.gust").cast("double").alias("gust"), F.get_json_object("j", "$.label").alias("label"), F.col("j").contains('"gust":null').alias("kept_null"))


JSON_SQL = f"{_I} SELECT event_id, pixel, CASE WHEN wind > 5 THEN wind * 1.5 END AS gust, CASE code {_LABELS} END AS label, NOT wind > 5 AS kept_null FROM i"


QUERIES = {
    "wind_class": (classes, CLASSES_SQL),
    "wind_histogram": (histogram, HISTOGRAM_SQL),
    "fire_weather_histogram": (fire_weather, FIRE_SQL),
    "wind_mode": (modal, MODAL_SQL),
    "fire_weather_index": (index, INDEX_SQL),
    "fire_weather_p99": (p99, P99_SQL),
    "wind_rotate_speed": (rotation, ROTATION_SQL),
    "relative_humidity": (humidity, HUMIDITY_SQL),
    "circular_mean": (circular, CIRCULAR_SQL),
    "incident_window": (incidents, INCIDENTS_SQL),
    "daily_direction_counts": (daily, DAILY_SQL),
    "json_fields": (json_events, JSON_SQL),
}
