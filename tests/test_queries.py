"""Every query with SQL gives the rows that DuckDB gives, on the smallest test data."""

import math
import numbers
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from clipyard.plans.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT:
            return "null"
        if isinstance(v, numbers.Integral) and not isinstance(v, bool):
            v = float(v)
        if isinstance(v, float):
            return "null" if math.isnan(v) else f"{v + 0.0:.4f}"
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
