"""Every catalog query against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from barsmith.plans import catalog
from conftest import SF_SMALL
from tools.check_oracle import TABLES, compare, type_diff

NAMES = sorted(catalog.catalog())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    frame = E.queries()[name](spark, SF_SMALL)
    got = frame.toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert compare(got, want) is None
    assert type_diff(frame, duck.sql(E.oracle_sql()[name])) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["symbol", "datetime", "open"] and len(df.columns) == 16
    assert df.count() > 0
