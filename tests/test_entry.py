"""Driver contract: entry() smoke, and every query against its DuckDB
oracle on the sf0.001 tables (row count, names, types, values)."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from loanmart.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "loan_number" in df.columns


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) - set(entry.LLM_SQL) == set(entry.queries()) - set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_idx = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    a = sorted(tuple(norm(r[i]) for i in s_idx) for r in df.collect())
    b = sorted(tuple(norm(r[i]) for i in d_idx) for r in rel.fetchall())
    assert len(a) == len(b)
    assert a == b
