from pyspark.sql import functions as F

from plumbline.operators import relational as rel
from plumbline.operators.skew import join_hot


def test_next_unfinished_wraps(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "k string")
    done = spark.createDataFrame([("c",), (None,)], "k string")
    assert [r.k for r in rel.next_unfinished(items, done, "k", "a").collect()] == ["b"]
    assert [r.k for r in rel.next_unfinished(items, done, "k", "b").collect()] == ["a"]
    assert [r.k for r in rel.next_unfinished(items, done, "k", None).collect()] == ["a"]
    assert rel.next_unfinished(items.limit(0), done, "k", "a").collect() == []


def test_leading_streak(spark):
    rows = [("x", 1, "F"), ("x", 2, "O"), ("x", 3, "F"), ("x", 4, "F"), ("y", 1, "F"), ("z", 1, None)] + [("w", i, "F") for i in range(20)]
    df = spark.createDataFrame(rows, "k string, t int, o string")
    got = {r.k: r.streak for r in rel.leading_streak(df, "k", ["t"], F.col("o") == "F", 8).collect()}
    assert got == {"x": 2, "y": 1, "z": 0, "w": 8}


def test_distinct_streak(spark):
    df = spark.createDataFrame([(1, "a", "bad"), (2, "b", "ok"), (3, "b", "ok"), (4, "c", "ok")], "t int, k string, o string")
    assert rel.distinct_streak(df, "k", "t", "o", "ok", 9).collect()[0].streak == 2
    assert rel.distinct_streak(df, "k", "t", "o", "ok", 1).collect()[0].streak == 1
    assert rel.distinct_streak(df, "k", "t", "o", "bad", 9).collect()[0].streak == 0


def test_digest_is_order_free_and_sees_every_row(spark):
    rows = [("a", "1"), ("b", None), ("b", None), (None, "2")]
    one, two = (rel.table_digest(spark.createDataFrame(r, "k string, v string").repartition(n), ["k", "v"]).collect() for r, n in ((rows, 1), (rows[::-1], 3)))
    assert one == two and one[0].n_rows == 4
    assert rel.table_digest(spark.createDataFrame(rows[:3], "k string, v string"), ["k", "v"]).collect() != one


def test_folded_counts_keep_first_spelling(spark):
    df = spark.createDataFrame([(2, "ACME"), (1, "Acme "), (3, " "), (4, None), (5, "b")], "i int, n string")
    assert sorted((r.label, r.n) for r in rel.folded_counts(df, "n", "i").collect()) == [("Acme", 2), ("b", 1)]


def test_join_hot_equals_left_join(spark):
    big = spark.createDataFrame([(f"k{i % 7}" if i % 3 else "hot", i) for i in range(300)] + [(None, -1), ("none", -2)], "k string, x int")
    look = spark.createDataFrame([("hot", 100, "H"), *[(f"k{i}", 20, f"v{i}") for i in range(7)]], "k string, n long, v string")
    want = sorted(map(tuple, big.join(look.drop("n"), "k", "left").collect()), key=str)
    for hot in (1, 1000):
        assert sorted(map(tuple, join_hot(big, look, "k", "n", hot).collect()), key=str) == want


def test_class_counts_on_empty_states(spark):
    e = spark.createDataFrame([], "k string, v string")
    one = spark.createDataFrame([("a", None)], "k string, v string")
    assert tuple(rel.snapshot_class_counts(e, e, "k", "v").collect()[0]) == (0, 0, 0, 0)
    assert tuple(rel.snapshot_class_counts(e, one, "k", "v").collect()[0]) == (1, 0, 0, 0)
    assert tuple(rel.snapshot_class_counts(one, one, "k", "v").collect()[0]) == (0, 0, 0, 1)


def test_page_actions(spark):
    schema = "k string, a string, b string, at int"
    old = spark.createDataFrame([("same", "x", None, 1), ("new text", "x", None, 1), ("later", "x", None, 5), ("gone", "x", None, 1), (None, "x", "y", 1)], schema)
    new = spark.createDataFrame([("same", "x", None, 9), ("new text", "x", "y", 1), ("later", "z", None, 4), ("made", "x", None, 1), (None, "x", "y", 1)], schema)
    got = {r.k: r.action for r in rel.page_actions(old, new, "k", ["a", "b"], "at").collect()}
    assert got == {"same": "unchanged", "new text": "updated", "later": "conflict", "gone": "orphaned", "made": "created"}


def test_filter_values_are_checked():
    assert rel.checked_values([" a", "b", "a"], "[a-z]", 2) == ["a", "b"]
    for bad in (["A"], ["a", "b", "c"]):
        try:
            rel.checked_values(bad, "[a-z]", 2)
        except ValueError:
            continue
        raise AssertionError(bad)
