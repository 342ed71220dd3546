"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from cinderspark.plans import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, sql, name):
    found = registry.queries()[name](spark, SMALL)
    columns = sorted(found.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in found.collect())
    result = sql.execute(registry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert got == want


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_text_operators(monkeypatch):
    """The rest imports and lists its queries where the text operators are gone."""
    import importlib
    import sys

    import __spark_entry__ as entry

    gone = [m for m in sys.modules if m.startswith("cinderspark.llm") or m == "corpus_pipeline"]
    for m in gone:
        monkeypatch.delitem(sys.modules, m)
    real = importlib.import_module

    def absent(name, *rest):
        if name.startswith("cinderspark.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *rest)

    monkeypatch.setattr(entry.importlib, "import_module", absent)
    assert set(entry.queries()) == set(registry.queries())
    assert set(entry.oracle_sql()) == set(registry.oracle_sql())
