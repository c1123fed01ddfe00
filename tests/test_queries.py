"""Registered queries at the smallest size against DuckDB on the same tables."""

from __future__ import annotations

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")

from pagestrata.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    return con


def rows(values):
    plain = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return sorted(repr(tuple(plain(v) for v in r)) for r in values)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, db, name):
    got = registry.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = db.sql(registry.ORACLES[name])
    assert sorted(want.columns) == names
    assert rows(tuple(r) for r in got.select(*names).collect()) == rows(want.select(*names).fetchall())


def test_flagship_has_rows(spark):
    assert registry.flagship(spark, SF).count() > 0
