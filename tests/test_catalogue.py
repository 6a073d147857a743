"""Every query of the catalogue runs on the smallest tables and equals its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from lexloom.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return repr(round(v, 5) + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    got = duck.execute(ORACLES[name])
    columns = [d[0] for d in got.description]
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(df.columns) == sorted(columns)
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())
