from plumbline.plans import core_queries


def written(spark, path, orders, items):
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double").write.parquet(str(path / "orders.parquet"))
    spark.createDataFrame(items, "l_orderkey bigint, l_quantity double").write.parquet(str(path / "lineitem.parquet"))
    return str(path)


def test_union_of_every_row(spark, tmp_path):
    d = written(spark, tmp_path, [(1, 1, 5.0), (2, 1, None)], [(1, 1.0), (1, 50.0), (3, None)])
    got = sorted((r.attempt, r.origin) for r in core_queries.QUERIES["set10_ledger_union"](spark, d).collect())
    assert got == [(1, "ledger"), (1, "ledger"), (1, "legacy"), (2, "legacy"), (3, "ledger")]


def test_greatest_key_of_the_log(spark, tmp_path):
    full = written(spark, tmp_path / "full", [(7, 1, 1.0), (4, 2, 1.0)], [])
    empty = written(spark, tmp_path / "empty", [], [])
    got = [core_queries.QUERIES["agg12_max_attempt"](spark, d).first().attempt for d in (full, empty)]
    assert got == [7, 0]
