"""One key, source or group of copies holds a third of all rows: results stay whole."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from plumbline.operators.nested import nested_rows
from plumbline.operators.relational import latest_per_key, leading_streak
from plumbline.operators.snapshots import snapshot_changes

T = datetime(2026, 1, 1)


def test_snapshot_with_a_hot_row(spark):
    hot = spark.range(3000).select(F.lit(1).alias("generation"), F.lit("hot").alias("product_id"), F.lit('{"a":"1"}').alias("payload_json"), F.lit(T).alias("refreshed_at"))
    cold = spark.range(6000).select((F.col("id") % 2 + 1).cast("int").alias("generation"), F.concat(F.lit("p"), (F.col("id") / 2).cast("int")).alias("product_id"), F.to_json(F.struct((F.col("id") % 5 > 0).alias("v"))).alias("payload_json"), F.lit(T).alias("refreshed_at"))
    got = {r.change_kind: r.n for r in snapshot_changes(hot.unionByName(cold)).groupBy("change_kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    changed = sum((2 * i % 5 > 0) != ((2 * i + 1) % 5 > 0) for i in range(3000))
    assert got == {"removed": 1, "changed": changed}


def test_nested_with_a_hot_product(spark):
    d = json.dumps({"facts": [{"evidence_quotes": [{"url": "u"}]}]})
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("product_id"), F.lit(T).alias("completed_at"), F.lit(d).alias("decision_json"), F.lit('{"url":"u"}').alias("evidence_json"))
    assert nested_rows(rows).count() == 2001 * 3


def test_latest_and_streak_with_a_hot_key(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("k"), F.col("id").alias("t"))
    assert {r.k: r.t for r in latest_per_key(rows, ["k"], ["t"], ["k", "t"]).collect()}["hot"] == 8997
    streak = leading_streak(rows, "k", ["t"], F.col("t") > 8000, 500)
    assert {r.k: r.streak for r in streak.collect()}["hot"] == len([t for t in range(0, 9000, 3) if t > 8000])
