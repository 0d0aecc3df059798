"""Scans of the catalogue and the registry from files and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCT_SCHEMA = "product_id string, brand_code string, family_code string, product_name string, unit_of_measure string, created_at timestamp, updated_at timestamp"
REGISTRY_SCHEMA = "brand_code string, manufacturer string, kind string, alias_list array<string>, web_domain string"


def checked(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in order and cast; missing columns are an error, others are not read."""
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(schema)
    missing = [f.name for f in want if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in want])


def catalogue_from_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 16, fetch_size: int = 10_000, **options: str) -> DataFrame:
    """The catalogue of a database; with a partition column and bounds the scan is spread over executors."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size).options(**options)
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return checked(reader.load(), PRODUCT_SCHEMA)


def catalogue_from_parquet(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The catalogue of parquet files; ``since`` is inclusive and is pushed to the scan where the file has it."""
    df = checked(spark.read.parquet(path), PRODUCT_SCHEMA)
    return df if since is None else df.where(F.coalesce("updated_at", "created_at") >= F.lit(since).cast("timestamp"))


def registry_from_json(spark: SparkSession, path: str) -> DataFrame:
    """The registry from a JSON file, one object per line or one list; unknown fields are not read."""
    return spark.read.schema(REGISTRY_SCHEMA).json(path, multiLine=True)


def registry_violations(registry: DataFrame, most_aliases: int = 20) -> DataFrame:
    """(rule, value) of entries that break the registry's rules: blank code or name, duplicate code, alias or domain, too many aliases."""
    r = registry.select("brand_code", "manufacturer", "alias_list", "web_domain")
    dup = lambda df, rule: df.where(F.col("value").isNotNull()).groupBy("value").count().where("count > 1").select(F.lit(rule).alias("rule"), "value")
    parts = [
        dup(r.select(F.col("brand_code").alias("value")), "duplicate_code"),
        dup(r.select(F.lower("web_domain").alias("value")), "duplicate_domain"),
        dup(r.select(F.explode(F.transform("alias_list", F.lower)).alias("value")), "duplicate_alias"),
        r.where(F.size("alias_list") > most_aliases).select(F.lit("too_many_aliases").alias("rule"), F.col("brand_code").alias("value")),
        r.where((F.trim(F.coalesce("brand_code", F.lit(""))) == "") | (F.trim(F.coalesce("manufacturer", F.lit(""))) == "")).select(F.lit("blank").alias("rule"), F.col("brand_code").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def frozen(df: DataFrame) -> DataFrame:
    """One consistent reading of a source that changes: it is read once and written to the shared checkpoint folder."""
    from plumbline.session import cut

    return cut(df)


def alias_map(spark: SparkSession, text: str | None, most_keys: int = 500, most_values: int = 50) -> DataFrame:
    """(key, value) of a map that an operator configures as JSON, each value a text or a list of texts.

    Keys and values are trimmed, keys in lower case. A key that stands twice, other types, blanks and
    more than ``most_keys`` keys or ``most_values`` values of one key are errors; no text is an empty map.
    """
    from plumbline.functions.jsons import strict_object

    given = {} if text is None or not text.strip() else strict_object(text)
    if given is None:
        raise ValueError("the map is no JSON object with different keys")
    rows: list[tuple[str, str]] = []
    if len(given) > most_keys:
        raise ValueError(f"more than {most_keys} keys")
    for key, values in given.items():
        listed = values if isinstance(values, list) else [values]
        if not key.strip() or not listed or len(listed) > most_values or not all(isinstance(v, str) and v.strip() for v in listed):
            raise ValueError(f"not a list of up to {most_values} texts: {key!r}")
        rows += [(key.strip().lower(), v.strip()) for v in dict.fromkeys(listed)]
    if len({k.strip().lower() for k in given}) < len(given):
        raise ValueError("keys differ by letter case only")
    return spark.createDataFrame(rows, "key string, value string")


def json_files(spark: SparkSession, path: str, schema: str, most_bytes: int = 1_000_000) -> DataFrame:
    """One row per JSON file with the columns of ``schema`` and its path; a file over ``most_bytes`` or without a JSON object is an error.

    The sizes are checked by a listing; a file's content is read by the task that parses it.
    """
    files = spark.read.format("binaryFile").load(path)
    large = files.where(F.col("length") > most_bytes).select("path").limit(1).collect()
    if large:
        raise ValueError(f"larger than {most_bytes} bytes: {large[0][0]}")
    text = F.decode("content", "UTF-8")
    object_text = F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), text)
    checked_text = F.coalesce(object_text, F.raise_error(F.concat(F.lit("no JSON object: "), "path")).cast("string"))
    return files.select("path", F.from_json(checked_text, schema).alias("v")).select("path", "v.*")
