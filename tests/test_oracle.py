"""Every registered query against its DuckDB oracle (plain triangular SQL)
on sf0.001; set SNAPMETRICS_ORACLE_SF to another folder to widen."""

import collections
import datetime as dt
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("SNAPMETRICS_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "customer", "orders", "lineitem", "documents", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_sql_or_listed():
    # Only queries of the separate subpackage may have no SQL.
    own = {q for q in set(QUERIES) - set(SQL) if not re.fullmatch(r"op\d+_\w+|pipeline", q)}
    assert own == set()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 450
