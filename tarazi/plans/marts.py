"""The registered queries of the reference's operators over a data folder's whole tables."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.functions import scalars
from tarazi.operators import cascade, quality, rejects, upserts
from tarazi.plans import adapter, gold
from tarazi.session import published
from tarazi.sources.records import table
from tarazi.streaming import windows as streams


class _Models:
    """The models of one folder, built on each other when they are asked for.

    The item dimension and the fact are tables in a warehouse: they are published once to the
    shared folder, and the marts of all queries read them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.obs = adapter.observations(spark, folder)
        self.daily = gold.daily_price(self.obs)
        self.regular = gold.regular_price(self.daily)
        self.fact0 = gold.daily_fact(self.regular)

    @cached_property
    def items(self) -> DataFrame:
        return published(self.spark, self.folder, "items", lambda: adapter.items(self.obs))

    @cached_property
    def products(self) -> DataFrame:
        return gold.dim_product(self.items)

    @cached_property
    def fact(self) -> DataFrame:
        return published(self.spark, self.folder, "fact", lambda: gold.with_product(self.fact0, self.items, self.products))

    @cached_property
    def ref(self) -> DataFrame:
        return gold.retailer_regular_daily(self.fact)

    @cached_property
    def cells(self) -> DataFrame:
        return gold.period_price_point(self.fact)

    @cached_property
    def levels(self) -> DataFrame:
        return gold.period_retailer(self.cells, self.products)

    @cached_property
    def index(self) -> DataFrame:
        return gold.price_index(self.levels)

    @cached_property
    def promos(self) -> DataFrame:
        return gold.promo_analysis(self.fact, self.ref)

    @cached_property
    def basket(self) -> DataFrame:
        quantities = self.products.select("category", F.lit(2).cast("long").alias("quantity")).distinct()
        return gold.basket_definition(self.products, quantities)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _model(pick):
    return lambda spark, folder: pick(_Models(spark, folder))


_AVERAGES = ("regular_price_avg", "effective_price_avg", "promo_share")


def fact_incremental(spark: SparkSession, folder: str, days: int = 7) -> DataFrame:
    """The fact of a first load without the late deliveries, after its last days are replaced by a load of everything.

    Late deliveries (here those without stock) change the last days only; what is older stays as it was.
    """
    obs = _Models(spark, folder).obs
    load = lambda rows: gold.daily_fact(gold.regular_price(gold.daily_price(rows)))
    return upserts.rewrite_window(load(obs.where("available")), load(obs), "observed_date", days)


def zone_consistency(m: _Models) -> DataFrame:
    cells = m.obs.groupBy("retailer_code", "store_item_id", "observed_date").agg(F.countDistinct("price_qepik").alias("n"))
    return cells.groupBy("retailer_code").agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(F.col("n") > 1, 1)).alias("mixed"))


def history_hash(m: _Models) -> DataFrame:
    """Hash of each item's prices in their order of days; the list is bounded by its days."""
    entry = F.struct("observed_date", F.concat(F.date_format("observed_date", "yyyy-MM-dd"), F.lit("="), F.col("price_qepik").cast("string")).alias("e"))
    return m.fact0.groupBy("store_item_id", "price_point_key").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]), ",").cast("binary")).alias("history"))


def latest_promotions(m: _Models) -> DataFrame:
    shown = m.promos.select("store_item_id", "price_point_key", "observed_date", "real_discount_bp")
    return shown.orderBy(F.desc("observed_date"), F.desc_nulls_last("real_discount_bp"), "store_item_id", "price_point_key").limit(50)


def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return upserts.first_of_each(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, folder, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey").withColumn("stated", F.lit(3).cast("long"))
    lines = table(spark, folder, "lineitem", "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    return quality.reconciliation(orders, "o_orderkey", "stated", ("lines", lines))


def batch_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return quality.reconciliation(table(spark, folder, "ingest_batch", "batch_id", "row_count"), "batch_id", "row_count", ("raw", table(spark, folder, "raw_record", "batch_id")))


def trailing_median(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "raw_record", "source", "business_date").groupBy("source", "business_date").agg(F.count(F.lit(1)).alias("n"))
    return quality.against_trailing_median(counts, "source", "business_date", "n")


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "retailer", "code").withColumnRenamed("code", "source")
    return quality.freshness(sources, table(spark, folder, "raw_record", "source", "business_date"), "source", "business_date", F.lit("2026-04-18").cast("date"))


def ean_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "store_item", "ean", "ean_kind", "unit_type", "unit_value", "pack").where(F.col("ean_kind") == "global")
    return quality.conflicting(items, "ean", ["unit_type", "unit_value", "pack"])


def gtin_check(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "store_item", "id", "ean").select("id", scalars.valid_gtin(F.col("ean")).alias("is_valid"))


def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "store_item", "id", "name_raw").select("id", scalars.normalize_text(F.col("name_raw")).alias("norm"))


def fingerprint_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of the listings, exact and tolerant ones, with the percentage."""
    parts = table(spark, folder, "store_item", "id", "name_raw").select("id", scalars.name_parts(F.col("name_raw")).alias("p"))
    return parts.select("id", scalars.fingerprint(F.col("p")).alias("fingerprint"), scalars.loose_fingerprint(F.col("p")).alias("loose"), F.col("p.fat").alias("fat"))


def cascade_match(spark: SparkSession, folder: str) -> DataFrame:
    """Products of the listings by barcode, fingerprints and similar names."""
    return cascade.cascade(table(spark, folder, "store_item"))


def cascade_review(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of the listings that the cascade leaves for review."""
    return cascade.review_candidates(table(spark, folder, "store_item"))


def record_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded records beyond the first of their source, SKU, store and day, with the price that was kept."""
    loaded = rejects.parse_records(table(spark, folder, "raw_record")).where(F.col("error").isNull())
    keys = ["source", "sku", "store_code", "business_date"]
    rows = loaded.select("batch_id", "row_num", *keys, "price_qepik")
    first = rows.groupBy(*keys).agg(F.min(F.struct("batch_id", "row_num", "price_qepik")).alias("kept"))
    joined = rows.alias("r").join(first.alias("f"), reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]))
    later = (F.col("r.batch_id") != F.col("kept.batch_id")) | (F.col("r.row_num") != F.col("kept.row_num"))
    return joined.where(later).select("r.*", F.col("kept.price_qepik").alias("kept_price_qepik"), (F.col("r.price_qepik") != F.col("kept.price_qepik")).alias("conflicting"))


def lineage_union(spark: SparkSession, folder: str) -> DataFrame:
    count = lambda name, kind: table(spark, folder, name, "source").groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "source", "n")
    return count("raw_record", "raw").unionByName(count("ingest_batch", "batch"))


def sha_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """First batch of each content of each source."""
    return table(spark, folder, "ingest_batch", "source", "file_sha256", "batch_id").groupBy("source", "file_sha256").agg(F.min("batch_id").alias("batch_id"))


def match_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Pairwise precision and recall of decided products against global barcodes."""
    snaps = table(spark, folder, "product_match_snap", "store_item_id", "product_id", "snapshot_date", "loaded_at").where(F.col("product_id").isNotNull())
    last = snaps.groupBy("store_item_id").agg(F.max_by("product_id", F.struct("snapshot_date", "loaded_at", "product_id")).alias("product"))
    items = table(spark, folder, "store_item", "id", "ean", "ean_kind").where((F.col("ean_kind") == "global") & F.col("ean").isNotNull())
    return quality.pair_counts(last.join(items, F.col("id") == F.col("store_item_id")).select("product", "ean"), "product", "ean")


def basket_saving(m: _Models) -> DataFrame:
    """The basket at the best single price point of the last day that has all of it, against its cheapest split over all."""
    split = gold.best_split(m.fact, m.basket).agg(F.sum("cost_qepik").alias("split_qepik"), F.count(F.lit(1)).alias("items"))
    whole = gold.cheapest_basket(m.fact, m.basket).where("is_complete")
    best = whole.where(F.col("observed_date") == whole.agg(F.max("observed_date")).scalar()).agg(F.min(F.struct("total_qepik", "price_point_key")).alias("b"))
    return best.select("b.price_point_key", F.col("b.total_qepik").alias("single_qepik"), split.select("split_qepik").scalar().alias("split_qepik"), split.select("items").scalar().alias("items")).withColumn("saving_qepik", F.col("single_qepik") - F.col("split_qepik"))


def product_search(spark: SparkSession, folder: str) -> DataFrame:
    """A page of the products whose name holds a word."""
    return table(spark, folder, "part", "p_partkey", "p_name", "p_brand").where(F.lower("p_name").like("%ring%")).orderBy("p_name", "p_partkey").offset(20).limit(50)


def scd2_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """History of the customers' segment after a snapshot in which those of some nations moved."""
    now = table(spark, folder, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    day = lambda d: F.lit(d).cast("date")
    current = now.select("*", day("2026-01-01").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    moved = now.withColumn("c_mktsegment", F.when(F.col("c_nationkey") < 5, "MOVED").otherwise(F.col("c_mktsegment")))
    return upserts.snapshot(current, moved, ["c_custkey"], ["c_mktsegment", "c_nationkey"], day("2026-02-01"))


def item_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "store_item", "retailer_code", "sku", "brand", "ean", "first_seen", "last_seen")
    old, new = rows.where(F.col("first_seen") < F.lit("2026-01-01").cast("date")), rows.where(F.col("last_seen") >= F.lit("2025-12-01").cast("date"))
    return upserts.upsert(old, new, ["retailer_code", "sku"], {"brand": "keep", "ean": "keep", "first_seen": "least", "last_seen": "greatest"})


def append_once(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return upserts.append_new(orders.where(F.col("o_orderstatus") == "F"), orders, ["o_orderkey"]).drop("o_orderstatus")


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by hour and type: an extension, the batch form of the streaming windows."""
    return streams.hourly(table(spark, folder, "events", "ts", "event_type", "value"))


QUERIES = {
    "daily_price_mode": _model(lambda m: m.daily),
    "regular_price": _model(lambda m: m.regular),
    "fact_daily": _model(lambda m: m.fact0),
    "fact_incremental": fact_incremental,
    "ref_regular": _model(lambda m: m.ref),
    "period_price_point": _model(lambda m: _rounded(m.cells, *_AVERAGES)),
    "period_retailer": _model(lambda m: _rounded(m.levels, *_AVERAGES)),
    "price_index": _model(lambda m: m.index),
    "competitiveness": _model(lambda m: gold.competitiveness(m.cells)),
    "promo_analysis": _model(lambda m: m.promos),
    "promo_summary": _model(lambda m: gold.promo_summary(m.promos)),
    "category_trend": _model(lambda m: gold.category_trend(m.index, m.promos, m.fact)),
    "price_current": _model(lambda m: gold.price_current(m.fact)),
    "price_changes": _model(lambda m: gold.price_changes(m.fact)),
    "price_movers": _model(lambda m: gold.price_movers(m.fact)),
    "basket_definition": _model(lambda m: m.basket),
    "cheapest_basket": _model(lambda m: gold.cheapest_basket(m.fact, m.basket)),
    "custom_basket_split": _model(lambda m: gold.best_split(m.fact, m.basket)),
    "basket_saving": _model(basket_saving),
    "dim_date": _model(lambda m: gold.dim_date(m.obs)),
    "dim_product": _model(lambda m: m.products),
    "dim_category": _model(lambda m: gold.dim_category(m.products)),
    "dim_price_point": _model(lambda m: gold.dim_price_point(m.daily)),
    "dim_store_item": _model(lambda m: m.items),
    "zone_consistency": _model(zone_consistency),
    "price_jumps": _model(lambda m: quality.jumps(m.fact0, ["store_item_id", "price_point_key"], "observed_date", "price_qepik")),
    "quarantine_price_spread": _model(lambda m: quality.group_spread(m.fact.where(~F.col("is_promo")), ["product_key"], "price_qepik", 300)),
    "latest_promotions_topn": _model(latest_promotions),
    "history_hash": _model(history_hash),
} | {
    f.__name__: f
    for f in (
        dedupe_first, duplicate_keys, reconciliation, batch_reconciliation, trailing_median, freshness, ean_conflicts, gtin_check, normalize_text, fingerprint_blocks, cascade_match, cascade_review, record_duplicates,
        lineage_union, sha_dedupe, match_quality, product_search, scd2_snapshot, item_upsert, append_once, event_windows,
    )
}
