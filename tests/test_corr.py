"""Correlation where it is not defined."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from cinderspark.operators import stats
from cinderspark.plans import registry
from tests.test_oracle import SMALL, plain


def test_corr(spark):
    c = 0.1 + 0.2
    rows = [("line", float(k), 3.0 - 2 * k) for k in range(7)] + [("one", 1.0, 2.0), ("none", None, 1.0), ("none", 2.0, None), ("pair", 1.0, 2.0), ("pair", 5.0, None)]
    rows += [("flat", c, float(k)) for k in range(37)] + [("level", float(k), c) for k in range(37)] + [("some", 1.0, 1.0), ("some", 2.0, 3.0), ("some", 3.0, 2.0), ("some", None, 9.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    got = {r["g"]: r["corr"] for r in df.groupBy("g").agg(stats.corr("x", "y").alias("corr")).collect()}
    assert got["line"] == pytest.approx(-1) and got["some"] == pytest.approx(0.5) and got["none"] is None
    assert all(math.isnan(got[g]) for g in ("one", "pair", "flat", "level"))
    assert [r["corr"] for r in stats.pairwise_corr(df.where("g = 'none'"), ["x", "y"]).collect()] == [None]
    assert math.isnan(df.where("g = 'flat'").agg(*stats.skill("x", "y")).first()["corr"])


def test_bottom_of_constant_groups(spark, tmp_path):
    """Customers whose buildings all have the same value have no correlation and are left out, as in SQL."""
    for file in os.listdir(SMALL):
        os.symlink(f"{SMALL}/{file}", tmp_path / file)
    os.remove(tmp_path / "lineitem.parquet")
    flat = f"SELECT o_orderkey FROM '{SMALL}/orders.parquet' WHERE o_custkey % 3 = 0"
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN l_orderkey IN ({flat}) THEN 0 ELSE l_tax END AS l_tax) FROM '{SMALL}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    for file in os.listdir(tmp_path):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{tmp_path}/{file}'")
    result = con.execute(registry.oracle_sql()["bottom_k_corr"])
    names = [c[0] for c in result.description]
    want = [tuple(plain(v) for v in row) for row in result.fetchall()]
    assert [tuple(plain(r[c]) for c in names) for r in registry.queries()["bottom_k_corr"](spark, str(tmp_path)).collect()] == want and len(want) == 10
