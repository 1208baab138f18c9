"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stationlab.registry import QUERIES as REGISTERED
from stationlab.registry import ROWS_ONLY
from stationlab.sources.testbed import TABLES

# the corpus queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in REGISTERED}
SQL = {k: v for k, v in E.oracle_sql().items() if k in REGISTERED}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False):
        vals = []
        for v in r:
            if v is None or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif isinstance(v, pd.Timestamp):
                vals.append(v.to_pydatetime())
            else:
                vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "temp_roll24" in df.columns
