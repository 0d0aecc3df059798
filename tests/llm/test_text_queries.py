"""The text queries on the test tables; those with SQL give an independent engine's rows."""

import os

import duckdb
import pytest

from plumbline.llm import llm_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(llm_queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("products", "web_fetch_exa", "documents", "eval_items", "brand_registry", "product_research_completions"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = llm_queries.QUERIES[name](spark, DATA)
    q = con.execute(llm_queries.ORACLES[name])
    names = [c[0] for c in q.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(map(tuple, q.fetchall()))


@pytest.mark.parametrize("name", sorted(set(llm_queries.QUERIES) - set(llm_queries.ORACLES)))
def test_other_queries_run(spark, name):
    df = llm_queries.QUERIES[name](spark, DATA)
    assert df.columns and df.count() > 0
