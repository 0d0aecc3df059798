from plumbline.session import PARTS, bounded_list, cut, ensure_checkpoint_dir, read_table, spread

import pytest


def test_spread_goes_by_its_parameter_and_not_by_size(spark):
    few, many = spark.range(100).coalesce(1), spark.range(100).repartition(64)
    assert spread(few, "id", 3).rdd.getNumPartitions() == spread(many, "id", 3).rdd.getNumPartitions() == 3
    assert spread(few, "id").rdd.getNumPartitions() == int(spark.conf.get(PARTS))
    assert sorted(r.id for r in spread(few, "id").collect()) == list(range(100))
    assert spread(spark.range(0), "id").count() == 0
    kept = spark.conf.get(PARTS)
    spark.conf.unset(PARTS)
    spark.conf.set(PARTS, "0")
    assert spread(few, "id") is few and spread(many, "id") is many
    spark.conf.set(PARTS, kept)


def test_no_folder_of_one_machine_on_a_cluster():
    class Nothing:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    @staticmethod
                    def getCheckpointDir():
                        return Nothing()

                return Sc

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="share"):
        ensure_checkpoint_dir(Session)


def test_cut_is_reliable_and_equal(spark):
    df = cut(spark.range(10).repartition(3))
    assert sorted(r.id for r in df.collect()) == list(range(10))
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()


def test_bounded_list_refuses_large_columns(spark):
    assert bounded_list(spark.range(5), "id", 5) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        bounded_list(spark.range(6), "id", 5)


def test_read_table(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").count() == 3
