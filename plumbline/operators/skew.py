"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def join_hot(big: DataFrame, lookup: DataFrame, key: str, weight: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join of ``big`` with ``lookup`` (unique in the string column ``key``).

    ``weight`` says how many rows of ``big`` a key has. The ``hot_keys`` heaviest keys are broadcast, a
    number that does not grow with the data; any other key then holds less than 1/hot_keys of the
    rows and goes through a shuffle join. Rows served by the broadcast take part in that join under a
    spread key that matches nothing, so they do not meet in one task. Null keys match nothing.
    """
    payload = [c for c in lookup.columns if c not in (key, weight)]
    packed = lookup.select(F.col(key), F.col(weight), F.struct(F.lit(1).alias("_one"), *payload).alias("_p"))
    hot = packed.orderBy(F.col(weight).desc(), F.col(key)).limit(hot_keys).select(key, F.col("_p").alias("_hot"))
    spread = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*[c for c in big.columns]), F.lit(4096)).cast("string"))
    first = big.join(F.broadcast(hot), key, "left").withColumn("_k", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(spread))
    cold = packed.select(F.col(key).alias("_k"), F.col("_p").alias("_cold"))
    joined = first.join(cold, "_k", "left").withColumn("_p", F.coalesce("_hot", "_cold"))
    return joined.select(*big.columns, *[F.col(f"_p.{c}").alias(c) for c in payload])
