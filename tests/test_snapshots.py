import json
from datetime import datetime

from plumbline.operators.snapshots import snapshot_changes

SCHEMA = "generation int, product_id string, payload_json string, refreshed_at timestamp, _step string, value int"


def rows(spark, data):
    return spark.createDataFrame([(g, p, j, t, "clash", 1) for g, p, j, t in data], SCHEMA)


def changes(spark, data):
    return {(r.generation, r.product_id): (r.change_kind, r.changed_fields) for r in snapshot_changes(rows(spark, data)).collect()}


T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def test_kinds_and_fields(spark):
    a, b = json.dumps({"n": "x", "u": None}), json.dumps({"n": "y"})
    got = changes(spark, [(1, "P-1", a, T1), (1, "P-2", a, T1), (3, "P-2", b, T1), (3, "p-1", a, T1)])
    assert got == {
        (3, "P-1"): ("removed", ["n"]),
        (3, "P-2"): ("changed", ["n"]),
        (3, "p-1"): ("added", ["n"]),
    }


def test_form_of_the_payload_does_not_count(spark):
    one = '{"a":"\\u00fc","b":{"x":1,"y":[1,2]},"c":null}'
    two = '{\n "b": {"y":[1, 2], "x":1}, "a": "ü"}'
    assert changes(spark, [(1, "P", one, T1), (2, "P", two, T1)]) == {}
    assert changes(spark, [(1, "P", '{"a":1}', T1), (2, "P", '{"a":"1"}', T1)]) == {(2, "P"): ("changed", ["a"])}


def test_latest_row_of_a_generation_counts(spark):
    data = [(1, "P", '{"a":"1"}', T1), (2, "P", '{"a":"1"}', T1), (2, "P", '{"a":"2"}', T2), (2, "P", '{"a":"2"}', T2)]
    assert changes(spark, data) == {(2, "P"): ("changed", ["a"])}


def test_nulls_unreadable_and_empty(spark):
    assert changes(spark, []) == {}
    assert changes(spark, [(1, "P", None, None)]) == {}
    data = [(1, "P", None, None), (2, "P", "not json", None), (None, "Q", "{}", T1), (2, None, "{}", T1)]
    assert changes(spark, data) == {}
    assert changes(spark, [(1, "P", "{}", T1), (2, "Q", "{}", T1)]) == {(2, "P"): ("removed", []), (2, "Q"): ("added", [])}


def test_added_changed_removed_add_up(spark):
    data = [(g, f"P{i}", json.dumps({"v": str(i // (g + 1))}), T1) for g in (1, 2) for i in range(g, 60, g)]
    got = changes(spark, data)
    old = {f"P{i}": i // 2 for i in range(1, 60)}
    new = {f"P{i}": i // 3 for i in range(2, 60, 2)}
    assert sum(k == "removed" for k, _ in got.values()) == len(old.keys() - new.keys())
    assert sum(k == "changed" for k, _ in got.values()) == sum(old[k] != new[k] for k in old.keys() & new.keys())


def test_one_exchange(spark):
    df = spark.createDataFrame([(1, "P", "{}", T1), (2, "P", "{}", T1)], "generation int, product_id string, payload_json string, refreshed_at timestamp")
    plan = snapshot_changes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
