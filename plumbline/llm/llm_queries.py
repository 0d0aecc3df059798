"""Queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import boilerplate, canonical, leaks, packing, registry_match, splitting
from plumbline.llm.sql import ORACLES  # noqa: F401
from plumbline.session import cut, read_table


def _lookalike_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both tables with their look-alike class; both go through the operator together."""
    tables = (("products", "row_id", "product_name"), ("web_fetch_exa", "fetch_id", "content"))
    parts = [read_table(spark, sf_dir, table).select(F.lit(table).alias("src_table"), F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")) for table, key, text in tables]
    return cut(canonical.lookalike_classes(parts[0].unionByName(parts[1]), ["src_table", "id"], "text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.class_pairs(_lookalike_classes(spark, sf_dir), "id", ["src_table"])


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its look-alike class and its number of links."""
    return canonical.class_links(_lookalike_classes(spark, sf_dir), ["src_table", "id"], ["src_table"])


def p2_canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read_table(spark, sf_dir, "products").select("row_id", "product_name")
    return canonical.canonical_text(names, ["row_id"], "product_name").select("row_id", F.col("canonical").alias("canonical_name"))


def p2_canonical_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "web_fetch_exa").select("fetch_id", "content")
    return canonical.canonical_text(pages, ["fetch_id"], "content").select("fetch_id", F.col("canonical").alias("canonical_content"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [read_table(spark, sf_dir, t) for t in ("products", "product_research_completions", "brand_registry")]
    return registry_match.matched_records(*tables).select("src_field", "record_key", "brand_code")


def p3_unmatched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [read_table(spark, sf_dir, t) for t in ("products", "product_research_completions", "brand_registry")]
    rows = registry_match.matched_records(*tables).where("brand_code = '-'")
    return rows.groupBy("src_field", "value").agg(F.count(F.lit(1)).alias("n"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.line_verdicts(read_table(spark, sf_dir, "web_fetch_exa")).where("not is_main").select("fetch_id", "line_no")


def p6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text(read_table(spark, sf_dir, "web_fetch_exa"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_documents(read_table(spark, sf_dir, "documents"))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every document is packed whole and once, in containers within the capacity."""
    rows = packing.pack_documents(read_table(spark, sf_dir, "documents"))
    per = rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("piece_no").alias("last"), F.countDistinct("piece_no").alias("pieces"), F.sum("n_tokens").alias("tokens"),
        F.max(F.struct("piece_no", "token_start", "n_tokens")).alias("end"), F.max("container_tokens").alias("most"),
    )
    once = (F.col("n") == F.col("last") + 1) & (F.col("pieces") == F.col("n")) & (F.col("end.token_start") + F.col("end.n_tokens") == F.col("tokens"))
    return per.select("doc_id", once.alias("once"), (F.col("most") <= packing.CAPACITY).alias("fits"))


def p9_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of each text put together again from its pieces without their overlaps, and whether all pieces keep the limit."""
    documents = read_table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    rows = splitting.split_documents(documents)
    core = F.struct("piece_no", F.expr("substring(piece, core_start - char_start + 1)").alias("s"))
    built = rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(core)), lambda x: x["s"]), "").alias("built"), F.max("n_tokens").alias("most"))
    fits = F.coalesce(F.col("most") <= splitting.LIMIT, F.lit(True))
    return documents.join(built, "doc_id", "left").select("doc_id", F.md5(F.coalesce("built", "text")).alias("text_md5"), fits.alias("fits"))


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p2_canonical_names": p2_canonical_names, "p2_canonical_pages": p2_canonical_pages, "p3_found": p3_found, "p3_unmatched_values": p3_unmatched_values, "p6_found": p6_found, "p6_main_text": p6_main_text, "p7_containers": p7_containers, "p7_packed": p7_packed, "p8_found": p8_found, "p9_pieces": p9_pieces, "p9_rebuilt": p9_rebuilt}
