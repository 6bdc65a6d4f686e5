"""Catalogued queries against their DuckDB oracle on sf0.001 (driver gate in small)."""
import datetime
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from usagelens.plans.catalog import QUERIES
from usagelens.plans.oracle import ORACLE

TABLES = ["customer", "nation", "orders", "events"]


def _canon(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        return v.date()
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_canon(r[c]) for c in cols) for r in pdf[cols].to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 40


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = con.execute(ORACLE[name]).df()
    cs, rs = _rows(sp)
    cd, rd = _rows(dk)
    assert cs == cd
    assert rs == rd


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["country", "total_users"]
