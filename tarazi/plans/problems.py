"""The pN queries of the general problems over a data folder's whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.operators import history, instants, quantities, rejects, rolling
from tarazi.sources.records import table

ENTITY, MEASURES = ["store_item_id", "price_point_key"], ["price_qepik", "regular_price_qepik"]


def classified(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_record", "batch_id", "row_num", "source", "business_date", "payload")
    return rejects.classify(raw, table(spark, folder, "retailer", "code", "feed_tz"), table(spark, folder, "store_snap", "retailer_code", "store_code"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded records whose instant falls on another day in Baku than their business date."""
    return instants.on_another_day(classified(spark, folder)).select("batch_id", "row_num")


def p1_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Every loaded record with its one UTC instant."""
    return rejects.loaded(classified(spark, folder)).select("batch_id", "row_num", "source", "time_text", "observed_at")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Listings whose two sizes differ and records whose old price is not above the price."""
    items = quantities.size_conflicts(table(spark, folder, "store_item", "id", "unit_value", "unit_type", "name_raw"))
    prices = quantities.old_price_not_above(classified(spark, folder))
    return items.select(F.lit("store_item").alias("tab"), F.col("id").alias("id1"), F.lit(0).cast("long").alias("id2")).unionByName(
        prices.select(F.lit("raw_record").alias("tab"), F.col("batch_id").alias("id1"), F.col("row_num").cast("long").alias("id2"))
    )


def p2_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded and named size of every listing in g, ml or pieces."""
    return quantities.listing_sizes(table(spark, folder, "store_item", "id", "unit_value", "unit_type", "name_raw"))


def p3_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of a store's price zone and a listing's product, with its period."""
    stores = history.latest_snapshots(table(spark, folder, "store_snap", "store_key", "snapshot_date", "price_zone", "loaded_at"), "store_key", "snapshot_date", history.zone_payload(), "loaded_at")
    matches = history.latest_snapshots(
        table(spark, folder, "product_match_snap", "store_item_id", "snapshot_date", "product_id", "loaded_at"), "store_item_id", "snapshot_date", F.col("product_id").cast("string"), "loaded_at"
    )
    kinds = (("store", stores), ("store_item", matches))
    parts = [history.versions(snaps).select(F.lit(kind).alias("entity"), "entity_id", "payload", "valid_from", "valid_to", "last_seen") for kind, snaps in kinds]
    return parts[0].unionByName(parts[1])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_versions(spark, folder).select("entity", "entity_id", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"))


def p4_rolling(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, counts and averages over 7 and 30 days of every calendar day of every item and price point."""
    facts = table(spark, folder, "fct_price_daily", *ENTITY, "observed_date", "observed_at", *MEASURES)
    return rolling.trailing(rolling.daily_values(facts, ENTITY, "observed_date", "observed_at", MEASURES), ENTITY, MEASURES)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    cases = rolling.below_share(p4_rolling(spark, folder), "price_qepik", 7, "regular_price_qepik", 30, 85)
    return cases.select(*ENTITY, F.date_format("obs_day", "yyyy-MM-dd").alias("obs_day"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.rejected(classified(spark, folder)).select("batch_id", "row_num")


def p6_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected records with their reason."""
    return rejects.rejected(classified(spark, folder))


QUERIES = {f.__name__: f for f in (p1_found, p1_instants, p2_found, p2_sizes, p3_found, p3_versions, p4_found, p4_rolling, p6_found, p6_rejected)}
