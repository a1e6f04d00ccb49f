"""Every query with a SQL twin gives the same rows."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from convograph.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def value(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 5) + 0.0
    return v


def same(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-6 * max(1, abs(x))) for x, y in zip(a, b, strict=True))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    d = QUERIES[name](spark, FOLDER)
    cols = sorted(d.columns)
    rows = sorted((tuple(value(r[c]) for c in cols) for r in d.collect()), key=repr)
    if name not in SQL:
        assert rows
        return
    r = db.execute(SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(value(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert len(rows) == len(want)
    assert all(same(a, b) for a, b in zip(rows, want, strict=True))
