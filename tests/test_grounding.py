from pyspark.sql import functions as F

from plumbline.functions import grounding as g
from plumbline.functions import jsons, render


def test_quote_spans():
    body = "Model PV-42:\n rated  power 42 W, weight\t12 kg. Long text in between. Efficiency 98.5 %."
    got = lambda q: (s := g.quote_span(q, body)) and body[s[0] : s[1]]
    assert got("rated  power 42 W") == "rated  power 42 W"
    assert got("Rated power 42 w") == "rated  power 42 W"
    assert got("pv42 rated-power") == "PV-42:\n rated  power"
    assert got("rated power … efficiency 98.5 %").startswith("rated") and got("rated power ... Efficiency 98.5 %").endswith("%")
    assert [got(q) for q in ("nothing", "", " ", None, "efficiency ... rated power")] == [None] * 5
    assert g.quote_span("x", None) is None and g.quote_span("a" * 600, "a" * 600) is None
    assert g.quote_span("Straße", "die STRASSE hier") == (4, 11)


def test_values():
    yes = [("rated power 42 W", "42", "W"), ("98,5 %", "98.5", "%"), ("IP65 housing", "IP65", None), ("is 12 kg.", "12", "kg"), ("value 42", 42, None)]
    no = [("142 W", "42", "W"), ("42 W to 48 W", "42", "W"), ("40-42 W", "42", "W"), ("42/48 W", "42", None), ("42.5 W", "42", None), ("42 W/m²", "42", "W"), ("IP655", "IP65", None), ("", "1", None), (None, "1", None), ("1", None, None), ("1", " ", None), ("42 kW", "42", "W")]
    assert all(g.states_value(*c) for c in yes), [c for c in yes if not g.states_value(*c)]
    assert not any(g.states_value(*c) for c in no), [c for c in no if g.states_value(*c)]


def test_table_cells():
    body = "| Model | PV-42 | PV-43 |\n|---|---|---|\n| Power | 42 W | 43 W |\n| Weight | | 3 kg |\n\n| Power | 9 W | 9 W |\nModel\tPV-44\nPower\t44 W"
    assert g.table_value(body, "pv 43", "power") == "43 W"
    assert g.table_value(body, "PV-44", "Power") == "44 W"
    assert g.table_value(body, "PV-42", "Weight") is None
    assert [g.table_value(*a) for a in ((None, "a", "b"), (body, "", "Power"), (body, "PV-42", None), (body, "PV-4", "Power"))] == [None] * 4


def test_strict_json():
    assert jsons.strict_object('```json\n{"a": 1}\n```') == {"a": 1}
    for bad in ('{"a":1,"a":2}', '{"a":NaN}', "[1]", 'text {"a":1}', "", None, "[" * 10_000):
        assert jsons.strict_object(bad) is None
    assert jsons.without_keys({"apiKey": 1, "b": [{"API-Key": 2, "c": 3}]}, frozenset({"api_key"})) == {"b": [{"c": 3}]}


def test_snake():
    assert [jsons.snake(k) for k in ("apiKey", "API-Key", "aB2C", "__x--Y", "", "é")] == ["api_key", "api_key", "a_b2_c", "x_y", "", ""]


def merged(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, page string, block string")
    rows = df.select("i", render.merge_managed(F.col("page"), F.col("block")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def test_managed_block(spark):
    a, b = (f"{render.START}\n{x}\n{render.END}" for x in "AB")
    old = f"{render.OLD_START}\nx\n{render.OLD_END}"
    assert merged(spark, [("my notes", "A"), ("my notes\n", "A"), ("my notes\n\n", "\nA\r\n"), (None, "A"), ("", "")]) == [
        f"my notes\n\n{a}\n", f"my notes\n\n{a}\n", f"my notes\n\n{a}\n", f"{a}\n", f"{render.START}\n{render.END}\n"
    ]
    # every byte around the block stays, a block of earlier releases is replaced where it stands
    assert merged(spark, [(f"  top\r\n{a}\n end ", "B"), (f"top {old} end", "B"), (f"top {old} end", f"\n{b}\n")]) == [f"  top\r\n{b}\n end ", f"top {b} end", f"top {b} end"]
    assert merged(spark, [(render.END + render.START, "A"), (render.START, "A"), ("", render.START), (a + a, "B"), (a + old, "B"), ("x", f"y {a}")]) == [None] * 6
