"""Tables of copies against their SQL: equal shapes are met once, whatever the number of rows that have them."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinderspark.functions import geo
from cinderspark.operators import joins, regional
from cinderspark.plans import registry
from tests.test_oracle import SMALL, plain

#: Copies of a table's rows, and by how much each moves the keys: places are the same after these.
COPIES = 7
MOVED = {"supplier": {"s_suppkey": 80}, "orders": {"o_orderkey": 106 * 10000}}


@pytest.fixture(scope="module")
def copied(tmp_path_factory):
    """The smallest tables with copies of suppliers and orders."""
    d = tmp_path_factory.mktemp("copies")
    for file in os.listdir(SMALL):
        name = file.removesuffix(".parquet")
        moved = ", ".join(f"{key} + i * {by} AS {key}" for key, by in MOVED.get(name, {}).items())
        rows = f"SELECT t.* REPLACE ({moved}) FROM range({COPIES}) r(i), '{SMALL}/{file}' t" if moved else f"FROM '{SMALL}/{file}'"
        duckdb.sql(f"COPY ({rows}) TO '{d}/{file}' (FORMAT parquet)")
    return str(d)


def rows_and_pairs(spark, monkeypatch, name, d, udf):
    """The result's rows, and how many rows the Arrow UDF was given."""
    seen, decide = spark.sparkContext.accumulator(0), getattr(geo, udf).func

    def counted(*columns: pd.Series) -> pd.Series:
        seen.add(len(columns[0]))
        return decide(*columns)

    monkeypatch.setattr(geo, udf, lambda *columns: F.pandas_udf(counted, "boolean")(*columns))
    found = registry.queries()[name](spark, d)
    rows = sorted(tuple(plain(row[c]) for c in sorted(found.columns)) for row in found.collect())
    monkeypatch.undo()
    return rows, seen.value


@pytest.mark.parametrize(("name", "udf"), [("polygon_overlap", "intersects_udf"), ("point_in_polygon", "contains_udf"), ("regional_stats_polygon", "contains_udf")])
def test_copies_meet_once(spark, copied, monkeypatch, name, udf):
    con = duckdb.connect()
    for file in os.listdir(copied):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{copied}/{file}'")
    result = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    want = sorted(tuple(plain(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall())
    rows, pairs = rows_and_pairs(spark, monkeypatch, name, copied, udf)
    once = rows_and_pairs(spark, monkeypatch, name, SMALL, udf)
    assert rows == want and len(rows) == COPIES * len(once[0])
    assert 0 < pairs == once[1]


def test_statistics_of_copies(spark):
    """Keys with equal shapes, one of several shapes, repeated rows, and rows without key or shape."""
    near, far = geo.box(0, 0, 2, 2), geo.box(6, 6, 8, 8)
    rows = [(1, near, "a"), (2, near, "b"), (3, far, "c"), (4, near, "d"), (4, far, "d"), (5, near, "e"), (5, near, "e"), (6, None, "f"), (None, far, "g"), (7, geo.box(3, 3, 4, 4), "h")]
    polygons = spark.createDataFrame(rows, "GEOID int, geometry binary, NAME string")
    buildings = spark.createDataFrame([(1.0, 1.0, 2.0), (0.5, 2.0, 4.0), (7.0, 7.0, 9.0), (5.0, 5.0, 1.0)], "x double, y double, v double")
    found = regional.polygon_statistics(buildings, polygons, "x", "y", 1.0, ["v"])
    got = sorted((r["GEOID"], r["NAME"], r["building_count"], r["v_mean"], r["v_median"]) for r in found.collect())
    once, both = (2, 3.0, 3.0), (3, 5.0, 4.0)
    assert got == [(1, "a", *once), (2, "b", *once), (3, "c", 1, 9.0, 9.0), (4, "d", *both), (4, "d", *both), (5, "e", 4, 3.0, 3.0), (5, "e", 4, 3.0, 3.0)]


@pytest.mark.parametrize("limit", ["SMALL_CELLS", "SMALL_BYTES"])
def test_many_shapes_are_not_broadcast(spark, monkeypatch, limit):
    polygons = spark.createDataFrame([(1, geo.box(0, 0, 4, 4)), (2, geo.box(4, 0, 8, 4)), (3, None)], "id int, geometry binary")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 4.0, 2.0), (3, 9.0, 9.0)], "p int, x double, y double")
    for most, hinted in ((None, True), (1, False)):
        if most:
            monkeypatch.setattr(joins, limit, most)
        met = joins.spatial_join(points, polygons, "x", "y", "geometry", 3.0)
        assert ("strategy=broadcast" in met._jdf.queryExecution().optimizedPlan().toString()) == hinted
        assert sorted((r["p"], r["id"]) for r in met.collect()) == [(1, 1), (2, 1), (2, 2)]
