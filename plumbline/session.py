"""Session helpers shared by operators and queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Setting: the number of parts into which operators that do much work per row spread their input; unset, they take it as it comes.
PARTS = "spark.plumbline.parts"


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("PLUMBLINE_CHECKPOINT_DIR", "/tmp/plumbline-checkpoint"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(PARTS, cores if cores.isdigit() else "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of one data directory, schema as stored (no inference pass)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder that the session names in ``spark.checkpoint.dir``; without one there is none that all executors share."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        # a session of one machine has no other executors; only there is a folder of its own right
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.environ.get("PLUMBLINE_CHECKPOINT_DIR", "/tmp/plumbline-checkpoint")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and returns it without lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def bounded_list(df: DataFrame, column: str, bound: int) -> list:
    """Distinct non-null values of ``column`` on the driver; refuses to collect more than ``bound``."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} distinct values; this column must be a small dimension")
    return sorted(r[0] for r in rows)


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``df`` hashed by ``key`` into ``parts`` parts, by default the number in the setting PARTS; as it is where neither is given.

    The size of the input plays no part: the setting says whether files come in too few parts for the cores.
    """
    parts = parts or int(df.sparkSession.conf.get(PARTS, "0"))
    return df.repartition(parts, key) if parts else df
