"""Queries over the tables of the feeds: current prices, serving extracts, review, checks and lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarazi.functions import scalars
from tarazi.operators import quality, rejects, selection
from tarazi.operators.instants import baku_day
from tarazi.plans.gold import half_away
from tarazi.sources.records import table


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    """One row an item, price point and day: of several deliveries the one observed last."""
    keys, kept = ["store_item_id", "price_point_key", "observed_date"], ["price_qepik", "regular_price_qepik", "old_price_qepik", "is_promo", "available", "n_stores"]
    rows = table(spark, folder, "fct_price_daily", *keys, "retailer_code", "observed_at", *kept)
    last = F.max_by(F.struct("retailer_code", *kept), F.struct("observed_at", *kept))
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    """The product last decided for each listing."""
    snaps = table(spark, folder, "product_match_snap", "store_item_id", "product_id", "snapshot_date", "loaded_at").where(F.col("product_id").isNotNull())
    return snaps.groupBy("store_item_id").agg(F.max_by("product_id", F.struct("snapshot_date", "loaded_at", "product_id")).alias("product_id"))


def _current(spark: SparkSession, folder: str) -> DataFrame:
    """Last price of each item and price point with its product; products in quarantine are left out."""
    last = _daily(spark, folder).groupBy("store_item_id", "price_point_key").agg(F.max_by(F.struct("retailer_code", "observed_date", "price_qepik", "is_promo", "available"), "observed_date").alias("r")).select("store_item_id", "price_point_key", "r.*")
    good = table(spark, folder, "product", "id", "quarantined", "category").where(~F.coalesce("quarantined", F.lit(False))).select(F.col("id").alias("product_id"), "category")
    return last.join(_decided(spark, folder), "store_item_id").join(good, "product_id")


def feed_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder)


def feed_current(spark: SparkSession, folder: str) -> DataFrame:
    return _current(spark, folder)


def price_history(spark: SparkSession, folder: str, categories=("Beverages", "Frozen"), since="2026-01-01", until=None, retailer=None) -> DataFrame:
    """Lowest and highest price by day and retailer for listings of some categories, from a day on."""
    items = selection.filtered(table(spark, folder, "store_item", "id", "category"), category=list(categories)).select(F.col("id").alias("store_item_id"))
    days = selection.filtered(_daily(spark, folder), observed_date=(since, until), retailer_code=retailer)
    shown = days.join(items, "store_item_id", "left_semi")
    return shown.groupBy("observed_date", "retailer_code").agg(F.min("price_qepik").alias("lowest"), F.max("price_qepik").alias("highest"), F.count("price_qepik").alias("n"))


def price_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Price points of a product by their current price; equal prices share a rank."""
    rank = F.rank().over(Window.partitionBy("product_id").orderBy("price_qepik"))
    return _current(spark, folder).where(F.col("price_qepik").isNotNull() & F.col("available")).select("product_id", "store_item_id", "price_point_key", "price_qepik", rank.alias("rank_in_product"))


def weighted_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Mean price by retailer and month, each row weighed by its number of stores."""
    rows = _daily(spark, folder).where(F.col("price_qepik").isNotNull() & F.col("n_stores").isNotNull())
    sums = rows.groupBy("retailer_code", F.trunc("observed_date", "month").alias("month_start")).agg(F.sum(F.col("price_qepik").cast("long") * F.col("n_stores")).alias("s"), F.sum("n_stores").alias("n"))
    return sums.select("retailer_code", "month_start", F.round(F.col("s") / F.nullif(F.col("n"), F.lit(0)), 4).alias("weighted_price"), F.col("n").alias("weight"))


def top_movers(spark: SparkSession, folder: str, days: int = 30, size: int = 20) -> DataFrame:
    """The items and price points whose price moved most over the last days; ties by their keys."""
    daily = _daily(spark, folder).where(F.col("price_qepik") > 0)
    last = daily.agg(F.max("observed_date")).scalar()
    recent = daily.where(F.col("observed_date") > F.date_sub(last, days)).groupBy("store_item_id", "price_point_key").agg(F.min_by("price_qepik", "observed_date").cast("long").alias("price_ago"), F.max_by("price_qepik", "observed_date").cast("long").alias("price_now"))
    moved = recent.withColumn("change_bp", half_away((F.col("price_now") - F.col("price_ago")) * 10000, F.col("price_ago"))).where(F.col("change_bp") != 0)
    return moved.orderBy(F.desc(F.abs("change_bp")), "store_item_id", "price_point_key").limit(size)


def _last_stores(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["retailer_code", "store_code", "store_name", "store_format", "price_zone"]
    snaps = table(spark, folder, "store_snap", "store_key", "snapshot_date", "loaded_at", *kept)
    return snaps.groupBy("store_key").agg(F.max_by(F.struct(*kept), F.struct("snapshot_date", "loaded_at", *kept)).alias("r")).select("store_key", "r.*").withColumn("price_zone", F.nullif(F.upper(F.trim("price_zone")), F.lit("")))


def dim_store(spark: SparkSession, folder: str) -> DataFrame:
    """Stores as of their last snapshot."""
    return _last_stores(spark, folder)


def dim_retailer(spark: SparkSession, folder: str) -> DataFrame:
    stores = _last_stores(spark, folder).groupBy(F.col("retailer_code").alias("code")).agg(F.count(F.lit(1)).alias("stores"))
    return table(spark, folder, "retailer", "code", "name", "price_model").join(stores, "code", "left").select("code", "name", "price_model", F.coalesce("stores", F.lit(0)).alias("stores"))


def zone_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Of each zoned retailer the zone of most stores, by name where equal, and the zones that choosing it leaves out."""
    zoned = table(spark, folder, "retailer", "code", "price_model").where(F.col("price_model") == "zoned").select(F.col("code").alias("retailer_code"))
    zones = _last_stores(spark, folder).where(F.col("price_zone").isNotNull()).join(zoned, "retailer_code").groupBy("retailer_code", "price_zone").agg(F.count(F.lit(1)).alias("n"))
    chosen = zones.groupBy("retailer_code").agg(F.min_by("price_zone", F.struct(-F.col("n"), F.col("price_zone"))).alias("zone"), F.array_sort(F.collect_list("price_zone")).alias("all"))
    return chosen.select("retailer_code", "zone", F.array_join(F.array_except("all", F.array("zone")), ",").alias("excluded"), (F.size("all") > 1).alias("requires_zone_choice"))


def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    """Listings whose last decision waits for review, surest first."""
    snaps = table(spark, folder, "product_match_snap", "store_item_id", "product_id", "snapshot_date", "loaded_at", "status", "confidence", "method")
    last = snaps.groupBy("store_item_id").agg(F.max_by(F.struct("status", "confidence", "method", "product_id"), F.struct("snapshot_date", "loaded_at", "status", "confidence", "method", "product_id")).alias("r")).select("store_item_id", "r.*")
    names = table(spark, folder, "store_item", "id", "name_raw").select(F.col("id").alias("store_item_id"), "name_raw")
    return last.where(F.col("status") == "pending_review").join(names, "store_item_id").select("store_item_id", "name_raw", "product_id", "method", F.col("confidence").cast("double").alias("confidence")).orderBy(F.desc("confidence"), "store_item_id")


def registry_members(spark: SparkSession, folder: str) -> DataFrame:
    """Of each product its listings, retailers and the listing seen first, as the registry is loaded for a further run."""
    items = table(spark, folder, "store_item", "id", "retailer_code", "first_seen")
    held = _decided(spark, folder).join(items, F.col("id") == F.col("store_item_id"))
    return held.groupBy("product_id").agg(F.count(F.lit(1)).alias("listings"), F.array_join(F.array_sort(F.collect_set("retailer_code")), ",").alias("retailers"), F.min_by("id", F.struct("first_seen", "id")).alias("representative"))


def record_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Each landed record with the file that it came from."""
    batches = table(spark, folder, "ingest_batch", "batch_id", "landing_path", "file_sha256", "status")
    return table(spark, folder, "raw_record", "batch_id", "row_num", "record_hash").join(batches, "batch_id", "left")


def pending_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that wait for loading, with their place in the queue: stores first, then by day, source and number."""
    waiting = table(spark, folder, "ingest_batch", "batch_id", "source", "kind", "business_date", "status").where(F.col("status") == "ingested")
    return waiting.select("batch_id", "source", "kind", "business_date").orderBy(F.col("kind") != "stores", "business_date", "source", "batch_id")


def event_props(spark: SparkSession, folder: str) -> DataFrame:
    """Events by a field of their JSON properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events", "props", "value").groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def price_gap(spark: SparkSession, folder: str) -> DataFrame:
    """A retailer's lowest current price of a product against the lowest and the highest of all retailers."""
    own = _current(spark, folder).where(F.col("price_qepik").isNotNull()).groupBy("product_id", "retailer_code").agg(F.min("price_qepik").cast("long").alias("price_qepik"))
    of_product = Window.partitionBy("product_id")
    spread = own.select("*", F.min("price_qepik").over(of_product).alias("_low"), F.max("price_qepik").over(of_product).alias("_high"), F.count(F.lit(1)).over(of_product).alias("retailers")).where(F.col("retailers") > 1)
    return spread.select("product_id", "retailer_code", "price_qepik", "retailers", selection.premium_bp(F.col("price_qepik"), F.col("_low")).alias("premium_bp"), selection.gap_bp(F.col("price_qepik"), F.col("_high")).alias("gap_bp"))


def gtin_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """A well-formed code for every product of the registry, of its number."""
    code = selection.gtin13(F.lit(200_000_000_000) + F.col("id"))
    return table(spark, folder, "product", "id").select("id", code.alias("code"), scalars.valid_gtin(code).alias("is_valid"))


def product_page(spark: SparkSession, folder: str) -> DataFrame:
    """A page of the products whose name holds a word, with the number of all of them."""
    named = table(spark, folder, "product", "id", "name").where(F.lower("name").like("%yumurta%"))
    return selection.page(named, [F.col("name"), F.col("id")], 5, 20)


def quarantine_reasons(spark: SparkSession, folder: str, percent: int = 300, days: int = 7) -> DataFrame:
    """Products whose listings look like different goods, with every reason that holds.

    Sizes or global barcodes that differ, or typical ordinary prices of the last days that are too far apart.
    """
    items = table(spark, folder, "store_item", "id", "unit_type", "unit_value", "pack", "ean", "ean_kind").withColumnRenamed("id", "store_item_id")
    held = _decided(spark, folder).join(items, "store_item_id")
    size = held.where(F.coalesce("unit_type", F.lit("")) != "kg_bulk").groupBy("product_id").agg(F.countDistinct(F.struct("unit_type", F.coalesce("unit_value", F.lit(0)).alias("v"), F.coalesce("pack", F.lit(0)).alias("p"))).alias("n")).where(F.col("n") > 1).select("product_id", F.lit("size_conflict").alias("reason"))
    code = held.where(F.col("ean_kind") == "global").groupBy("product_id").agg(F.countDistinct("ean").alias("n")).where(F.col("n") > 1).select("product_id", F.lit("ean_conflict").alias("reason"))
    daily = _daily(spark, folder)
    last = daily.agg(F.max("observed_date")).scalar()
    typical = daily.where((F.col("observed_date") > F.date_sub(last, days)) & F.col("old_price_qepik").isNull()).groupBy("store_item_id").agg(F.percentile("price_qepik", F.lit(0.5)).alias("p"))
    spread = quality.group_spread(_decided(spark, folder).join(typical, "store_item_id"), ["product_id"], "p", percent).where(F.col("n") > 1).select("product_id", F.lit("price_spread").alias("reason"))
    return size.unionByName(code).unionByName(spread).groupBy("product_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


def feed_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Figures that a run is judged by: check, subject and value; their limits are the caller's."""
    def figure(rows: DataFrame, check: str, value, subject: str | None = None) -> DataFrame:
        named = value.cast("double").alias("value")
        by = rows.groupBy(F.col(subject).alias("subject")).agg(named) if subject else rows.agg(named).select(F.lit("all").alias("subject"), "value")
        return by.select(F.lit(check).alias("check_name"), "subject", "value")

    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    batches = table(spark, folder, "ingest_batch", "source", "status")
    items = table(spark, folder, "store_item", "category", "unit_type")
    daily = _daily(spark, folder)
    today = daily.where(F.col("observed_date") == daily.agg(F.max("observed_date")).scalar())
    parts = [
        figure(batches, "stuck_batches", F.count(F.when(F.col("status").isin("ingested", "failed"), 1))),
        figure(batches, "rejected_batch_share", share(F.col("status") == "rejected"), "source"),
        figure(today, "median_price", F.percentile("price_qepik", F.lit(0.5)), "retailer_code"),
        figure(items, "unmapped_categories", F.count(F.when(F.col("category") == "Uncategorized", 1))),
        figure(items, "unit_coverage", share(F.col("unit_type").isNotNull())),
        figure(review_queue(spark, folder), "review_backlog", F.count(F.lit(1))),
        figure(table(spark, folder, "product", "quarantined"), "quarantine_share", share(F.coalesce("quarantined", F.lit(False)))),
    ]
    return reduce(DataFrame.unionByName, parts)


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The first gate that stops each batch by its number of rows, also of batches without any."""
    batches = table(spark, folder, "ingest_batch", "batch_id", "row_count")
    counts = table(spark, folder, "raw_record", "batch_id").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    joined = batches.join(counts, "batch_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    gate = F.when(F.col("n") == 0, "empty_batch").when(F.col("row_count").isNull(), "no_count").when(F.col("row_count") != F.col("n"), "count_differs")
    return joined.select("batch_id", "n", gate.alias("gate"))


def model_tests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that break a rule of a table: unique and stated keys, known values, partners in other tables."""
    item, product, record = (table(spark, folder, t, *c) for t, c in (("store_item", ("id", "retailer_code", "sku")), ("product", ("id",)), ("raw_record", ("batch_id", "row_num"))))
    fact, batch, shop = table(spark, folder, "fct_price_daily", "store_item_id", "retailer_code", "price_qepik"), table(spark, folder, "ingest_batch", "batch_id", "status"), table(spark, folder, "retailer", "code")
    orphans = lambda rows, key, parent, to: rows.where(F.col(key).isNotNull()).join(parent.select(F.col(to).alias(key)), key, "left_anti")
    rules = {
        "store_item_id_unique": quality.duplicate_keys(item, ["id"]), "store_item_sku_unique": quality.duplicate_keys(item, ["retailer_code", "sku"]), "product_id_unique": quality.duplicate_keys(product, ["id"]),
        "record_unique": quality.duplicate_keys(record, ["batch_id", "row_num"]), "fact_item_known": orphans(fact, "store_item_id", item, "id"), "fact_retailer_known": orphans(fact, "retailer_code", shop, "code"),
        "record_batch_known": orphans(record, "batch_id", batch, "batch_id"), "fact_price_stated": fact.where(F.col("price_qepik").isNull()), "batch_status_known": batch.where(~F.col("status").isin("ingested", "silver_done", "rejected", "failed")),
    }
    return reduce(DataFrame.unionByName, [rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures") for name, rows in rules.items()])


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.classify(table(spark, folder, "raw_record"), table(spark, folder, "retailer"), table(spark, folder, "store_snap"))


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Price observations of the feeds: loaded records, the first of each source, SKU, store and day.

    An old price that is not above the price is no claim and becomes null; the end of a
    promotion is a date or null; the day is that of the observation in Baku, else the business date.
    """
    loaded = rejects.loaded(_classified(spark, folder))
    claim = F.when(F.col("old_price_qepik") > F.col("price_qepik"), F.col("old_price_qepik"))
    kept = loaded.select(
        "source", "sku", "store_code", F.coalesce(baku_day("observed_at"), "business_date").alias("observed_date"), "batch_id", "row_num", "name", "brand", "ean", "category_raw", "price_qepik", claim.alias("old_price_qepik"),
        F.to_date(F.regexp_extract("promo_until", r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date")).alias("promo_until"), "available", "observed_at",
    )
    keys = ["source", "sku", "store_code", "observed_date"]
    rest = [c for c in kept.columns if c not in keys]
    return kept.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("batch_id", "row_num")).alias("r")).select(*keys, "r.*")


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records that do not load by source and reason."""
    return rejects.rejected(_classified(spark, folder)).groupBy("source", F.col("error").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        feed_daily, feed_current, price_history, price_rank, weighted_prices, top_movers, dim_store, dim_retailer, zone_choice, review_queue, registry_members, record_lineage, pending_batches, event_props, price_gap, gtin_numbers,
        product_page, quarantine_reasons, feed_checks, batch_counts, model_tests, observations, reject_counts,
    )
}
