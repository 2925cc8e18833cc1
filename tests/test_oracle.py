"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from innkeeper import catalog
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# Row-at-a-time Python, cartesian products and nested-loop joins do not scale.
FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
# the training-data queries, present or not, have tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{name}: {node} in plan"
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    g = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in got), key=repr)
    w = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in want), key=repr)
    assert g == w


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.collect()) >= 1
