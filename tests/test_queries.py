"""Every query that has SQL gives the rows of that SQL."""

import math

import duckdb
import pytest

from sparkloom.plans import queries as Q
from sparkloom.plans import records  # noqa: F401  registers its queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return [plain(y) for y in x]
    if isinstance(x, bool):
        return x
    try:
        return round(float(x), 5)
    except (TypeError, ValueError):
        return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(name, spark, sf, duck):
    df = Q.QUERIES[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in Q.ORACLE_SQL:
        assert got
        return
    result = duck.execute(Q.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, result.fetchall())
