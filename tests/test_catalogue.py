"""Every query with an SQL twin gives the twin's rows; the others run."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from medialoom.plans import catalogue

from .conftest import DATA


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(names, records):
    return sorted(tuple(str(plain(r[names.index(n)])) for n in sorted(names)) for r in records)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in catalogue.ORACLES:
        assert got
        return
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
