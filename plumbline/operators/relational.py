"""Generic relational operators of the engine: latest rows, anti-join queues, streaks, merges, digests.

All are functions of DataFrames. None collects a group whose size grows with the data; each states
what nulls, ties and repeated rows mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the greatest in ``order`` (nulls smallest), ties broken by the other columns.

    Partial maxima are taken before the shuffle, so a key with a third of all rows costs one row per task.
    """
    rest = [c for c in columns if c not in keys and c not in order]
    top = F.max(F.struct(*order, *rest)).alias("_top")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_top.{c}").alias(c) for c in columns if c not in keys])


def next_unfinished(items: DataFrame, finished: DataFrame, key: str, after: str | None) -> DataFrame:
    """The first item without a finished row behind ``after``, else the first of all: at most one row.

    Null keys are no items. Plans as a left anti join and a top-1, never a sort of the whole table.
    """
    todo = items.select(key).where(F.col(key).isNotNull()).distinct().join(finished.select(key), key, "left_anti")
    wrapped = F.lit(False) if after is None else F.col(key) <= F.lit(after)
    return todo.orderBy(wrapped, key).limit(1)


def leading_streak(df: DataFrame, key: str, order: list[str], matches: Column, limit: int) -> DataFrame:
    """(key, streak): how many of the newest rows in a row match, among the newest ``limit``.

    Null outcomes do not match. Rows tied in ``order`` count in the order of the remaining columns of
    ``order``. The first rows per key are found by a window with a rank filter, which Spark cuts off
    in the map tasks (WindowGroupLimit), so a key with very many rows is not sorted in one task.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    top = df.select(key, *order, F.coalesce(matches, F.lit(False)).alias("_m")).withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= limit)
    first_miss = F.min(F.when(~F.col("_m"), F.col("_rn")))
    return top.groupBy(key).agg(F.coalesce(first_miss - 1, F.count(F.lit(1))).cast("bigint").alias("streak"))


def distinct_streak(df: DataFrame, key: str, order: str, outcome: str, wanted: str, limit: int) -> DataFrame:
    """One row: number of distinct keys in the newest unbroken run of ``wanted``, at most ``limit``."""
    last_other = df.agg(F.max(F.when(~F.col(outcome).eqNullSafe(wanted), F.col(order))).alias("_stop")).scalar()
    run = df.where(last_other.isNull() | (F.col(order) > last_other))
    return run.agg(F.least(F.countDistinct(key), F.lit(limit)).alias("streak"))


def zero_filled_counts(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """(column, n) for every value of a fixed list, zero where there is no row."""
    spine = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return spine.join(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")), column, "left").select(column, F.coalesce("_n", F.lit(0)).alias("n"))


def folded_counts(df: DataFrame, column: str, order: str) -> DataFrame:
    """(label, n): counts by case-folded trimmed text, labelled with the spelling that comes first in ``order``; blanks left out."""
    label = F.trim(column)
    return df.where(label != "").groupBy(F.lower(label).alias("_k")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col(order), label.alias("label"))).alias("_f")).select(F.col("_f.label").alias("label"), "n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def merge_by_url(df: DataFrame, key: Column, keep: list[str], best: list[Column], collect: str) -> DataFrame:
    """Rows with one dedupe key become one: the best row's columns and the distinct sorted values of ``collect``.

    ``best`` is compared in order, greatest wins, nulls smallest, ties by the kept columns. The values of
    ``collect`` per page are a small dimension; distinct pairs are formed before the shuffle.
    """
    rows = df.withColumn("_key", key).where(F.col("_key").isNotNull())
    top = rows.groupBy("_key").agg(F.max(F.struct(*[b.alias(f"_b{i}") for i, b in enumerate(best)], *keep)).alias("_t"))
    said = rows.select("_key", collect).distinct().groupBy("_key").agg(F.array_sort(F.collect_list(collect)).alias(collect))
    return top.join(said, "_key", "left").select(F.col("_key").alias("dedupe_key"), *[F.col(f"_t.{c}").alias(c) for c in keep], collect)


def table_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n_rows, digest): the same for the same bag of rows in any order and partitioning; one combining aggregate.

    Each row is hashed over its values with their lengths, so neighbouring fields cannot run together;
    60 bits of each hash are summed in 128 bits. The digest is text.
    """
    text = F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns])
    part = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).cast("string").alias("digest"))


def catalogue_checksum(df: DataFrame, key: str, value: str, prefix: int = 4) -> DataFrame:
    """One row, ``checksum``: SHA-256 over ordered (key NUL value LF), in two levels.

    Keys are put into 16^prefix buckets by their hash and ordered (lower case, then raw) within each;
    the bucket digests, a number that does not grow, are hashed in order. A change in one row touches
    one bucket. Null keys are left out; a null value counts as empty.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.substring(F.sha2(key, 256), 1, prefix).alias("_b"), F.struct(F.lower(key).alias("l"), F.col(key).alias("k"), F.coalesce(value, F.lit("")).alias("v")).alias("_r"))
    line = lambda r: F.concat(r["k"], F.lit("\x00"), r["v"], F.lit("\n"))
    buckets = rows.groupBy("_b").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("_r")), line), ""), 256).alias("_d"))
    return buckets.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_d"))), lambda x: x["_d"]), ""), 256).alias("checksum"))


def snapshot_class_counts(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """One row: added, removed, changed, unchanged keys between two states; null-safe on the value."""
    a = old.select(key, F.struct(F.col(value)).alias("_old"))
    b = new.select(key, F.struct(F.col(value)).alias("_new"))
    j = a.join(b, key, "full_outer")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    same = F.col("_old").eqNullSafe(F.col("_new"))
    return j.agg(
        F.count_if(F.col("_old").isNull()).alias("added"),
        F.count_if(F.col("_new").isNull()).alias("removed"),
        F.count_if(both & ~same).alias("changed"),
        F.count_if(both & same).alias("unchanged"),
    )


def page_actions(current: DataFrame, desired: DataFrame, key: str, fields: list[str], stamp: str) -> DataFrame:
    """(key, action): created, unchanged, updated, conflict or orphaned, by null-safe equality of all ``fields``.

    A page that differs and whose ``stamp`` is later than the one the desired version was made from is a
    conflict: somebody changed it in between. Keys are unique on both sides; null keys are no pages.
    """
    a = current.where(F.col(key).isNotNull()).select(key, F.struct(*fields).alias("_a"), F.col(stamp).alias("_at"))
    b = desired.where(F.col(key).isNotNull()).select(key, F.struct(*fields).alias("_b"), F.col(stamp).alias("_from"))
    action = (
        F.when(F.col("_a").isNull(), "created").when(F.col("_b").isNull(), "orphaned").when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged")
        .when(F.col("_at") > F.col("_from"), "conflict").otherwise("updated")
    )
    return a.join(b, key, "full_outer").select(key, action.alias("action"))


def checked_values(values: list[str], pattern: str, most: int) -> list[str]:
    """Values of a filter, trimmed and once each; an error if one does not match ``pattern`` or there are more than ``most``."""
    import re

    out = list(dict.fromkeys(v.strip() for v in values))
    bad = [v for v in out if not re.fullmatch(pattern, v)]
    if bad or len(out) > most:
        raise ValueError(f"not a filter value: {bad}" if bad else f"more than {most} values")
    return out


def usage_totals(df: DataFrame, group: str, column: str, fields: list[str]) -> DataFrame:
    """(group, field, total) of the ``fields`` of a JSON object that hold whole numbers from zero; anything else does not count."""
    used = df.select(group, F.explode(F.from_json(column, "map<string,string>")).alias("field", "v")).where(F.col("field").isin(*fields) & F.col("v").rlike("^[0-9]+$"))
    return used.groupBy(group, "field").agg(F.sum(F.col("v").try_cast("bigint")).alias("total"))
