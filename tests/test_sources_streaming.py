from datetime import datetime

import pytest

from plumbline.sources import readers
from plumbline.sources.store import PartitionedStore, SnapshotStore
from plumbline.streaming import catalogue

SCHEMA = readers.PRODUCT_SCHEMA + ", extra int"
T = [datetime(2026, 1, d) for d in range(1, 6)]


def product(pid, name, at):
    return (pid, "B", None, name, "EA", T[0], at, 1)


def test_store_swaps_whole_generations(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert store.generation() == 0 and store.read(spark) is None
    for g in (1, 2, 3, 4):
        assert store.write(spark.createDataFrame([(g,)], "x int")) == g
        assert [r.x for r in store.read(spark).collect()] == [g]
    with pytest.raises(ValueError):
        store.write(spark.createDataFrame([], "x int"), refuse_empty=True)
    assert store.generation() == 4


def test_stream_equals_batch(spark, tmp_path):
    rows = [product("a", "old", T[1]), product("a", "new", T[3]), product("b", "x", None), product(None, "y", T[1]), product("a", "late", T[2]), product("b", "x", None), product("c", "tie1", T[1]), product("c", "tie2", T[1])]
    src = str(tmp_path / "in")
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    store = SnapshotStore(spark, str(tmp_path / "state"))
    for _ in range(2):
        catalogue.run_upserts(spark, src, store, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.product_id, r.product_name) for r in store.read(spark).collect())
    assert got == [("a", "new"), ("b", "x"), ("c", "tie2")]
    batch = catalogue.upsert(None, spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(str, batch.collect())) == sorted(map(str, store.read(spark).collect()))


def test_stream_into_parts_rewrites_only_touched_ones(spark, tmp_path):
    src, store = str(tmp_path / "in"), PartitionedStore(spark, str(tmp_path / "state"), "product_id", parts=16)
    assert store.read(spark) is None
    first = [product(f"p{i}", "old", T[1]) for i in range(40)] + [product(None, "y", T[1])]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    catalogue.run_upserts(spark, src, store, str(tmp_path / "cp")).awaitTermination()
    before = store.manifest()
    assert set(before.values()) == {1} and store.read(spark).count() == 40
    spark.createDataFrame([product("p3", "new", T[2]), product("p3", "late", T[0])], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    catalogue.run_upserts(spark, src, store, str(tmp_path / "cp")).awaitTermination()
    changed = {k for k, g in store.manifest().items() if g != before[k]}
    assert len(changed) == 1
    assert {r.product_id: r.product_name for r in store.read(spark).collect()} == {f"p{i}": "new" if i == 3 else "old" for i in range(40)}
    assert store.merge(spark, spark.createDataFrame([product(None, "z", T[4])], SCHEMA), catalogue.upsert) == 2
    for g in range(3, 6):
        assert store.merge(spark, spark.createDataFrame([product("p3", f"n{g}", T[3])], SCHEMA), catalogue.upsert) == g
    assert store.read(spark).count() == 40


def test_since_is_inclusive(spark, tmp_path):
    src = str(tmp_path / "p")
    spark.createDataFrame([product("a", "n", T[1]), product("b", "n", T[2])], SCHEMA).write.parquet(src)
    assert [r.product_id for r in readers.catalogue_from_parquet(spark, src, "2026-01-03").collect()] == ["b"]
    assert readers.catalogue_from_parquet(spark, src, "2026-01-02").count() == 2


def test_windows_drop_what_is_too_late(spark, tmp_path):
    src = str(tmp_path / "e")
    for batch in ([("a", datetime(2026, 1, 1, 1)), ("a", datetime(2026, 1, 1, 9))], [("a", datetime(2026, 1, 1, 2)), ("a", datetime(2026, 1, 1, 20))], [("a", datetime(2026, 1, 1, 21))]):
        spark.createDataFrame(batch, "event_type string, ts timestamp").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("event_type string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = catalogue.event_counts(stream).writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert {(r.window_start.hour, r.n) for r in spark.table("counts").collect()} >= {(1, 1), (9, 1)}


def test_schema_is_checked(spark):
    with pytest.raises(ValueError):
        readers.checked(spark.createDataFrame([(1,)], "product_id int"), readers.PRODUCT_SCHEMA)


def test_registry_file(spark, tmp_path):
    f = tmp_path / "r.json"
    f.write_text('[{"brand_code":"A","manufacturer":"Acme","alias_list":["x","y"],"web_domain":"a.example","secret":1},{"brand_code":"A","manufacturer":" ","alias_list":["X"],"web_domain":null}]')
    r = readers.registry_from_json(spark, str(f))
    assert r.columns == ["brand_code", "manufacturer", "kind", "alias_list", "web_domain"]
    assert sorted((v.rule, v.value) for v in readers.registry_violations(r).collect()) == [("blank", "A"), ("duplicate_alias", "x"), ("duplicate_code", "A")]


def test_alias_map(spark):
    got = {(r.key, r.value) for r in readers.alias_map(spark, '{" ACME ": ["a.example", "b.example", "a.example"], "x": "y"}').collect()}
    assert got == {("acme", "a.example"), ("acme", "b.example"), ("x", "y")}
    assert readers.alias_map(spark, None).count() == readers.alias_map(spark, " ").count() == 0
    for bad in ('{"a": "x", "a": "y"}', '{"a": "x", "A": "y"}', '{"a": [1]}', '{"a": []}', '{" ": "x"}', "[]", '{"a": "' + '", "b": "'.join("xy") + '"', '{"a": ' + str(["x" * (i + 1) for i in range(51)]).replace("'", '"') + "}"):
        with pytest.raises(ValueError):
            readers.alias_map(spark, bad)


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1, "secret": 2}')
    (tmp_path / "b.json").write_text('{"y": "ü"}', encoding="utf-8")
    got = sorted((r.path[-6:], r.x, r.y) for r in readers.json_files(spark, str(tmp_path), "x int, y string").collect())
    assert got == [("a.json", 1, None), ("b.json", None, "ü")]
    with pytest.raises(ValueError):
        readers.json_files(spark, str(tmp_path), "x int", most_bytes=5)
    (tmp_path / "c.json").write_text("[1")
    with pytest.raises(Exception, match="no JSON object"):
        readers.json_files(spark, str(tmp_path), "x int").collect()


def test_a_frozen_reading_does_not_change(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    kept = readers.frozen(spark.read.parquet(path))
    spark.range(9).write.mode("overwrite").parquet(path)
    assert kept.count() == 3
