from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__
from textloom.plans import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = core.queries()[name](spark, DATA)
    rows = df.collect()
    if name not in core.oracle_sql():
        assert rows
        return
    r = duck.execute(core.oracle_sql()[name])
    columns = [x[0] for x in r.description]
    order = sorted(df.columns)
    assert sorted(columns) == order
    want = sorted((tuple(plain(x[columns.index(c)]) for c in order) for x in r.fetchall()), key=str)
    assert sorted((tuple(plain(x[c]) for c in order) for x in rows), key=str) == want
