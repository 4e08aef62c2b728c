"""The pN queries of the problems tagged llm over a data folder's whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.llm import bpe, contamination, duplicates, matching, truncation
from tarazi.llm.profiles import profiles
from tarazi.sources.records import table


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "store_item", "id", "name_raw", "brand", "unit_value", "unit_type", "pack", "ean")
    products = table(spark, folder, "product", "id", "name", "brand", "unit_value", "unit_type", "pack", "ean")
    decisions = table(spark, folder, "product_match_snap", "store_item_id", "product_id", "snapshot_date", "loaded_at")
    return profiles(items, products, decisions)


def p5_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Undecided listings with the registered product they are and a confidence."""
    decisions = table(spark, folder, "product_match_snap", "store_item_id", "product_id", "snapshot_date", "loaded_at")
    return matching.match_registry(_profiles(spark, folder), decisions)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_matches(spark, folder).select("store_item_id", "product_id")


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every listing with its group of listings of one product."""
    return duplicates.same_items(_profiles(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.pairs_of(p7_groups(spark, folder))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document's text by byte_bpe_50k."""
    return bpe.encode_corpus(table(spark, folder, "documents", "doc_id", "text"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation items and the documents that hold a passage of them."""
    return contamination.leaked(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_item", "item_id", "text")).select("item_id", "doc_id")


def _cut(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated(table(spark, folder, "documents", "doc_id", "source", "text"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text was cut."""
    return _cut(spark, folder).where(F.col("cut")).select("doc_id").distinct()


def p10_share(spark: SparkSession, folder: str) -> DataFrame:
    """Of each source the share of its texts that is cut."""
    return truncation.truncation_report(_cut(spark, folder))


QUERIES = {f.__name__: f for f in (p5_found, p5_matches, p7_found, p7_groups, p8_ids, p9_found, p10_found, p10_share)}
ORACLES: dict[str, str] = {}
