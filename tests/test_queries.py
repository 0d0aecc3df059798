"""Every core query with SQL gives the rows of an independent SQL engine on the test tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from plumbline.plans import core_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    if isinstance(v, int) and not isinstance(v, bool) and abs(v) < 1_000_000:
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(core_queries.ORACLES))
def test_query_equals_sql(spark, sql, name):
    df = core_queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    q = sql.execute(core_queries.ORACLES[name])
    names = [c[0] for c in q.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in q.fetchall())


@pytest.mark.parametrize("name", sorted(set(core_queries.QUERIES) - set(core_queries.ORACLES)))
def test_other_queries_run(spark, name):
    df = core_queries.QUERIES[name](spark, DATA)
    assert df.columns and df.count() >= 0


def test_queries_bear_the_operators_alone(monkeypatch):
    """The library works without its optional text package."""
    import importlib
    import sys

    import __spark_entry__

    for m in [m for m in sys.modules if m.startswith("plumbline.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "plumbline.llm", None)
    entry = importlib.reload(__spark_entry__)
    assert set(entry.queries()) == set(core_queries.QUERIES)
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
