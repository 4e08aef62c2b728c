"""Price observations read from the order tables of a data folder.

A nation is a price zone, its region the retailer, a part's brand the product and its type the
category; the list price is the extended price by piece, in hundredths.  A discount of 8 per
cent or more is a promotion whose old price is the list price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.sources.records import table


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """One row a line item: retailer_code, price_zone, price_point_key, store_id, product_key, category, store_item_id, observed_date, prices, available."""
    lines = table(spark, folder, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    parts = table(spark, folder, "part", "p_partkey", "p_brand", "p_type")
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation", "n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, folder, "region", "r_regionkey", "r_name")
    zones = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    joined = lines.join(zones, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    pieces = F.col("l_quantity").cast("long")
    off = F.round(F.col("l_discount") * 100).cast("long")
    point = F.concat_ws(":", "r_name", "n_name")
    sized = joined.select(
        F.col("r_name").alias("retailer_code"),
        F.col("n_name").alias("price_zone"),
        point.alias("price_point_key"),
        F.col("l_suppkey").alias("store_id"),
        F.col("p_brand").alias("product_key"),
        F.col("p_type").alias("category"),
        F.concat_ws("|", "p_brand", "p_type", point).alias("store_item_id"),
        F.to_date("l_shipdate").alias("observed_date"),
        F.call_function("div", cents * 2 + pieces, pieces * 2).alias("list_price"),
        off.alias("off"),
        (F.col("l_returnflag") != "R").alias("available"),
    )
    promo = F.col("off") >= 8
    price = F.when(promo, F.call_function("div", F.col("list_price") * 2 * (100 - F.col("off")) + 100, F.lit(200).cast("long"))).otherwise(F.col("list_price"))
    return sized.select("*", price.alias("price_qepik"), F.when(promo, F.col("list_price")).alias("old_price_qepik")).drop("list_price", "off")


def items(obs: DataFrame) -> DataFrame:
    """Item dimension of the observations."""
    return obs.select("store_item_id", "retailer_code", "price_point_key", "product_key", "category").distinct()
