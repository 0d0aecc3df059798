from plumbline.plans import core_queries


def test_specs_of_every_confidence(spark, tmp_path):
    rows = [("p", "b", "Zeta", 0.99), ("p", "b", "alpha", 0.2), ("p", "A", "x", None), ("p", None, "n", 0.95), ("p", "b", "alpha", 0.99), ("q", None, None, 0.99)]
    rows += [("hot", "c", f"n{i:05d}", 0.1) for i in range(20_000)]
    spark.createDataFrame(rows, "product_id string, category string, name string, confidence double").write.parquet(str(tmp_path / "fact_item.parquet"))
    got = {r.product_id: r.names for r in core_queries.QUERIES["top08_sorted_specs"](spark, str(tmp_path)).collect()}
    assert got.pop("hot") == "|".join(f"n{i:05d}" for i in range(20_000))
    assert got == {"p": "n|x|alpha|Zeta"}
