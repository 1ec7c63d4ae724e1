"""Every registered query against its DuckDB statement on sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from candlewick.plans.catalog import QUERIES
from tools.check_oracle import TABLES, rows_of

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) >= set(QUERIES)
    assert set(entry.queries()) >= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "kline_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)
