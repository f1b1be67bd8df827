"""Every registered query of the library against its oracle SQL in DuckDB."""

import datetime
import math

import duckdb
import pytest

from fringeline import plans

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()
#: No SQL form; see test_operators.py.
ROWS_ONLY = {"e25_surface_deramp", "e25_cubic_deramp", "e30_seasonal"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, (int, float)) and abs(a - b) <= 2e-5 * max(1, abs(b)))


def test_every_query_is_covered():
    assert set(plans.QUERIES) - set(plans.ORACLE_SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_oracle(spark, con, sf_dir, name):
    df = plans.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    found = con.sql(plans.ORACLE_SQL[name])
    assert sorted(found.columns) == cols
    place = [list(found.columns).index(c) for c in cols]
    order = lambda r: tuple((x is None, "" if x is None else x) for x in r)
    ours = sorted((tuple(plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=order)
    want = sorted((tuple(plain(r[i]) for i in place) for r in found.fetchall()), key=order)
    assert len(ours) == len(want) and len(ours) > 0
    for a, b in zip(ours, want):
        assert all(close(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows(spark, sf_dir, name):
    assert plans.QUERIES[name](spark, sf_dir).count() > 0
