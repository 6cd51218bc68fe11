"""Every query against its SQL, and those without SQL for rows and columns, on the smallest tables."""

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the test tables aren't here")


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, int):
        return float(v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if sql := entry.oracle_sql().get(name):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        assert Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()) == rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
