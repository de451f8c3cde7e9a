"""Every registered query equals its DuckDB oracle (sf0.001 here; the driver runs sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_duckdb import SQL
from tests.conftest import SF0001
from tradeflow.queries import QUERIES

# the training-data queries have tests of their own
KEYS = list(QUERIES)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF0001}/events.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"pnl_rank", "pnl_row_num", "cumulative_pnl"} <= set(df.columns)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF0001)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[key])
    o_cols, o_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
