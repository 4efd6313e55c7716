"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakemart.plans.testdata import QUERIES

# smallest tables by default; LAKEMART_ORACLE_SF_DIR=/root/testdata/sf0.01 for the gate scale
SF_DIR = os.environ.get("LAKEMART_ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["lang", "option", "n_docs", "pct_docs"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    rel = duck.sql(contract.oracle_sql()[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == types
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())
