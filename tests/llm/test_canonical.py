import unicodedata as ud

from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import lookalikes as la
from plumbline.llm.canonical import canonical_text, class_links, lookalike_classes, lookalike_pairs

SAME = [
    ("Module ABC-12", "Ｍｏｄｕｌｅ　ＡＢＣ－１２"),
    ("Café", "Café"),
    ("Wert 5", "We​rt 5﻿"),
    ("Nordlumen", "Νоrdlumеn"),
    ("profile", "proﬁle"),
    ("10 kΩ Å", "10 kΩ Å"),
    ("µ-inverter", "μ‑inverter"),
    ("ạ̇", "ạ̇"),
]
DIFFER = [("m2", "m²"), ("abc", "Abc"), ("a", "á"), ("a b", "a  b"), ("a-b", "a–b"), ("O", "0"), ("a\nb", "a b"), ("1", "①")]


def test_fold_pairs():
    for a, b in SAME:
        assert la.fold(a) == la.fold(b), (a, b)
    for a, b in DIFFER:
        assert la.fold(a) != la.fold(b), (a, b)


def spark_fold(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return {r.id: r.canonical for r in canonical_text(df, ["id"]).collect()}


def test_spark_equals_fold(spark):
    texts = [x for pair in SAME + DIFFER for x in pair]
    texts += ["", "​", "́", "́a", "ẹ́̂́", "ế" * 50, "x" * 20_000 + "́", "가각", "\U0001d15e", "\U0001f44d", "à֮̀̕b", "ẛ̣", "\r\n\t", "ｶﾞ", "ẛ̣", "q̣̇"]
    texts += ["".join(chr(0x300 + (i * 7 + k) % 0x70) if k % 3 else chr(0x41 + (i + k) % 26) for k in range(12)) for i in range(40)]
    # bases and marks apart, marks out of order, forms that begin with a mark
    texts += ["ne\u200b\u0301x", "カ\uff9e ab", "e\u200d\u200b\u0323\ufeff\u0301", "ab\u0301\u0323cd", "\U00010400\u0301", "x\ny\u0301", "\u0301\u200bz", "e\t\u0301", "plain e\u200b plain", "\u1100\u1161\u0301"]
    got = spark_fold(spark, texts)
    assert {i: la.fold(t) for i, t in enumerate(texts)} == got


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_fold_is_stable_and_sees_canonical_equivalence(text):
    once = la.fold(text)
    assert la.fold(once) == once
    assert la.fold(ud.normalize("NFD", text)) == once


def test_pairs(spark):
    a, b, c = "Café ABC", "Café ABC", "Ｃａｆé ABC"
    rows = [(1, a), (2, b), (3, a), (4, c), (5, "other"), (6, "other"), (7, None), (8, ""), (9, "​"), (9, "​"), (10, "a‌b")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "id bigint, name string, _class string, canonical string")
    got = sorted((r.id_a, r.id_b) for r in lookalike_pairs(df, "id", "name").collect())
    # 1 and 3 are copies of one text: each is linked with the rows of the other texts, not with one another
    assert got == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4), (8, 9)]
    assert lookalike_pairs(df.limit(0), "id", "name").count() == 0


def test_no_link_is_lost_against_brute_force(spark):
    import random

    rng = random.Random(3)
    swaps = {"a": "аａa", "e": "еｅe", "o": "оοo", " ": "   ", "n": "nn​"}
    texts = ["".join(rng.choice(swaps.get(c, c)) for c in rng.choice(["one name", "a lone note", "nano ohm"])) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, name string")
    got = {(r.id_a, r.id_b) for r in lookalike_pairs(df, "id", "name").collect()}
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if texts[i] != texts[j] and la.fold(texts[i]) == la.fold(texts[j])}
    assert got == want
    classes = lookalike_classes(df, ["id"], "name")
    links = {r.id: r.n_links for r in class_links(classes, ["id"]).collect()}
    assert links == {i: sum(i in p for p in want) for i in range(60)}


def test_two_copies_of_two_texts_are_four_links(spark):
    df = spark.createDataFrame([(1, "Caf\u00e9"), (2, "Cafe\u0301"), (3, "Caf\u00e9"), (4, "Cafe\u0301")], "id bigint, name string")
    assert {(r.id_a, r.id_b) for r in lookalike_pairs(df, "id", "name").collect()} == {(1, 2), (1, 4), (2, 3), (3, 4)}


def test_a_hot_text_is_linked_without_comparing_its_copies(spark):
    rows = [(i, "Nordlumen") for i in range(3000)] + [(3000, "N\u043erdlumen"), (3001, "other")]
    df = spark.createDataFrame(rows, "id bigint, name string")
    got = lookalike_pairs(df, "id", "name").collect()
    assert {(r.id_a, r.id_b) for r in got} == {(i, 3000) for i in range(3000)}
    links = {r.n_links for r in class_links(lookalike_classes(df, ["id"], "name"), ["id"]).where("id < 3000").collect()}
    assert links == {1}


def test_long_runs_of_marks_and_invisible_characters(spark):
    texts = ["a" + "\u200b" * 30_000 + "\u0301", "e" + "\u0301" * 20_000, "\uff21" * 20_000, "x" * 100_000 + "\u0301"]
    assert spark_fold(spark, texts) == {i: la.fold(t) for i, t in enumerate(texts)}
