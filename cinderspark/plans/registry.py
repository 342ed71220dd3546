"""Named queries over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from cinderspark.plans import evaluation, places, raster, regional, weather

_ALL = {**regional.QUERIES, **weather.QUERIES, **raster.QUERIES, **places.QUERIES, **evaluation.QUERIES}


def queries() -> dict:
    return {name: run for name, (run, _) in _ALL.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
