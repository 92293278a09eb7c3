"""Every query against its SQL in DuckDB, on the smallest tables; those without SQL must return rows."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from lakegauge.plans import maintenance, operations, pipelines, registry, relational  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def text(v):
    if v is None or v is pd.NaT or (not isinstance(v, str) and pd.isna(v)):
        return "~"
    return f"{float(v):.5f}" if hasattr(v, "real") and not isinstance(v, bool) else str(v)


def rows(df):
    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sql, name):
    found = registry.QUERIES[name](spark, SF).toPandas()
    if name not in registry.ORACLE:
        assert len(found)
        return
    want = sql.execute(registry.ORACLE[name]).df()
    assert sorted(found.columns) == sorted(want.columns)
    assert rows(found) == rows(want)
