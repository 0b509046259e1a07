"""Every registered query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from pricetide.oracle import ORACLE
from pricetide.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["lineitem"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# Queries that write and re-read folders are covered in test_io; here they
# run too, but only once each.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else repr(r[i]) for i in order))
    return sorted(out)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PYTHON_NODES if n in plan], "query must stay JVM-side"
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _norm(s_rows, s_cols) == _norm(d_rows, d_cols)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["timestamp", "timestamp_utc", "price", "timezone", "year", "month"]
    assert df.count() > 0
