import json
from datetime import datetime

from plumbline.operators import nested

SCHEMA = "product_id string, completed_at timestamp, decision_json string, evidence_json string, pre int, url string, kind string"
T = datetime(2026, 1, 1)


def found(spark, data):
    df = spark.createDataFrame([(p, t, d, e, 1, "u", "k") for p, t, d, e in data], SCHEMA)
    return sorted((r.product_id, r.child_kind, r.parent_pos, r.child_pos, r.doc_pos) for r in nested.nested_rows(df).collect())


DECISION = {
    "datasheets": [{"url": "b"}, None, {"url": "zz"}],
    "sources": {"url": "a"},
    "facts": [None, {"name": "x", "evidence_quotes": [{"url": "b"}, None, {"quote": "no url"}]}, {"evidence_quotes": {"url": "a"}}],
    "conflicts": [{"field": "f", "url": "a"}],
    "conclusion_evidence": [{"url": "a"}, "text", 3],
    "classification_evidence_quotes": [],
}
EVIDENCE = [{"url": "a"}, {"url": "b"}, {"url": "a"}, None]


def expected(p):
    return sorted([
        (p, "datasheet", -1, 0, 1), (p, "datasheet", -1, 2, -1), (p, "source", -1, 0, 0), (p, "fact", -1, 1, -1), (p, "fact", -1, 2, -1),
        (p, "quote", 1, 0, 1), (p, "quote", 1, 2, -1), (p, "quote", 2, 0, 0), (p, "conflict", -1, 0, -1), (p, "conclusion", -1, 0, 0),
        (p, "evidence", -1, 0, -1), (p, "evidence", -1, 1, -1), (p, "evidence", -1, 2, -1),
    ])


def test_all_kinds(spark):
    assert found(spark, [("P", T, json.dumps(DECISION), json.dumps(EVIDENCE))]) == expected("P")


def test_repeats_strings_and_wrapped_evidence(spark):
    row = ("P", T, json.dumps(json.dumps(DECISION)), json.dumps({"results": EVIDENCE, "statuses": [{"url": "s"}]}))
    assert found(spark, [row, row]) == expected("P")
    assert found(spark, [("P", T, None, json.dumps({"url": "a"}))]) == [("P", "evidence", -1, 0, -1)]


def test_nulls_unreadable_empty_and_deep(spark):
    assert found(spark, []) == []
    deep = "[" * 100_000
    rows = [("A", None, None, None), ("B", T, "", "{"), ("C", T, '{"facts": NaN}', deep), (None, T, json.dumps(DECISION), "[]"), ("D", T, '{"facts": [[{"a": 1}]], "sources": "x"}', "3")]
    assert found(spark, rows) == []


def test_latest_completion_counts(spark):
    a, b = json.dumps({"facts": [{"name": "old"}]}), json.dumps({"facts": [{}, {}]})
    assert found(spark, [("P", datetime(2026, 1, 2), b, "[]"), ("P", T, a, "[]"), ("P", None, a, "[]")]) == [("P", "fact", -1, 0, -1), ("P", "fact", -1, 1, -1)]


def test_intervals_nest():
    rows = nested.label_nodes(DECISION, nested.DECISION_KINDS, "decision", True)
    facts = {r[5]: r for r in rows if r[1] == "fact"}
    for q in (r for r in rows if r[1] == "quote"):
        inside = [p for p, f in facts.items() if f[2] < q[2] and f[3] > q[3]]
        assert len(inside) == 1


def test_flat_tables_read_their_fields(spark):
    d = {"facts": [{"name": "n", "value": 3, "unit": None, "confidence": 0.5, "evidence_urls": ["a"]}]}
    df = spark.createDataFrame([("P", T, json.dumps(d), "[]")], "product_id string, completed_at timestamp, decision_json string, evidence_json string")
    r = nested.flat_table(df, "fact").collect()[0]
    assert (r.name, r.value, r.unit, r.confidence, r.evidence_urls) == ("n", "3", None, 0.5, ["a"])


def test_one_pass_writes_all_tables(spark, tmp_path):
    df = spark.createDataFrame([("P", T, json.dumps(DECISION), json.dumps(EVIDENCE)), ("Q", T, None, None)], "product_id string, completed_at timestamp, decision_json string, evidence_json string")
    tables = nested.write_flat_tables(df, str(tmp_path / "nodes"))
    assert set(tables) == set(nested.KIND_NAMES)
    for kind, table in tables.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, nested.flat_table(df, kind).collect()))


def test_exchanges(spark):
    df = spark.createDataFrame([("P", T, "{}", "[]")], "product_id string, completed_at timestamp, decision_json string, evidence_json string")
    plan = nested.nested_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
