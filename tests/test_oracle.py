"""Every registered query equals its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from logweave.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: "NULL" if v is None else ("true" if v is True else "false" if v is False else str(v))
    return hashlib.sha256("\n".join(sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["orders", "events", "conversations", "documents", "customer", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["topic", "key", "value"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert _digest(df.columns, rows) == _digest(o_cols, o_rows)
