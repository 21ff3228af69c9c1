"""Every named query runs on the smallest tables, and agrees with its SQL where it has one."""

from __future__ import annotations

import math
from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as E


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    v = v.item() if hasattr(v, "item") else v
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, pd.Timestamp) else v


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, sf, duck, name):
    got = E.queries()[name](spark, sf).toPandas()
    sql = E.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark, sf):
    assert E.entry(spark).count() > 0
