import json

from plumbline.plans import core_queries


def test_category_fact_at_any_position(spark, tmp_path):
    other = {"name": "Weight", "value": "3 kg", "category": "Mechanics"}
    rows = {
        "a": {"facts": [other, {"name": " Product Type ", "value": "inverter"}]},
        "b": {"product_category": "module", "facts": [{"name": "product category", "value": "other"}]},
        "c": {"product_category": " ", "facts": ["x", {"name": "product category", "value": " "}, {"name": "产品类别", "value": "cable"}, {"name": "产品类型", "value": "fuse"}]},
        "d": {"facts": [other]},
        "e": {"facts": "none"},
        "f": {"product_category": 5, "facts": [{"name": "product type", "value": 7}, {"name": "product type"}]},
    }
    spark.createDataFrame([(k, json.dumps(v)) for k, v in rows.items()] + [("g", "[1]"), ("h", "no json")], "product_id string, decision_json string").write.parquet(str(tmp_path / "product_research_completions.parquet"))
    got = {r.product_id: r.category for r in core_queries.QUERIES["prj06_categories"](spark, str(tmp_path)).collect()}
    assert got == {"a": "inverter", "b": "module", "c": "cable", "d": None, "e": None, "f": None}
