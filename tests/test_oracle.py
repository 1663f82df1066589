"""Every query with SQL equals DuckDB on the same tables; every query runs."""

import math

import duckdb
import pandas as pd
import pytest

from bescheid.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "-"
    if isinstance(v, str):
        return v
    if hasattr(v, "isoformat"):
        day, _, time = v.isoformat().partition("T")
        return day if time in ("", "00:00:00") else f"{day}T{time}"
    if type(v).__name__ in ("bool", "bool_"):
        return str(bool(v))
    return repr(round(float(v), 6))


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf, con):
    got = registry.QUERIES[name](spark, sf).toPandas()
    assert len(got) or name in ("due_municipalities",)
    if name in registry.SQL:
        want = con.sql(registry.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
