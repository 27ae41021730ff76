"""Every registered core query against its SQL, or at least its rows."""

from __future__ import annotations

import math

import duckdb
import pytest

from plantpanel.plans import registry

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    assert got
    sql = registry.oracle_sql().get(name)
    if sql:
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert got == sorted((tuple(plain(row[i]) for i in order) for row in rel.fetchall()), key=repr)
