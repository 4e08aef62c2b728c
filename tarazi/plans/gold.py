"""Dimensional models and marts as functions from DataFrame to DataFrame.

Money is whole qepik.  Medians of prices are rounded half to even, shares of hundred per cent
(bp) half away from zero, as noted at each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarazi.config import SETTINGS


def half_even(x: Column) -> Column:
    """A double rounded half to even, as a long."""
    return F.bround(x, 0).cast("long")


def half_away(numerator: Column, denominator: Column) -> Column:
    """A quotient of longs rounded half away from zero; null for a denominator of null or zero, which has to be positive otherwise."""
    d = F.when(denominator != 0, denominator)
    return F.signum(numerator).cast("long") * F.call_function("div", F.abs(numerator) * 2 + d, d * 2)


def share_pct(share: Column) -> Column:
    """A share as per cent with one decimal; noise of the summation is rounded off first, so it decides no tie."""
    return F.round(F.round(share * 100, 6), 1)


def median(x: str | Column) -> Column:
    return F.percentile(x, F.lit(0.5))


def daily_price(obs: DataFrame) -> DataFrame:
    """One row an item, price point and day: the price of most stores, the smallest of equally frequent ones.

    Prices and old prices are counted by value, each combined before its shuffle, and the most
    frequent value is taken from the counts; a group never holds more than its distinct values.
    """
    keys = ["store_item_id", "retailer_code", "price_point_key", "price_zone", "observed_date"]
    values = F.array(F.struct(F.lit(0).alias("kind"), F.col("price_qepik").alias("v")), F.struct(F.lit(1).alias("kind"), F.col("old_price_qepik").alias("v")))
    stated = obs.select(*keys, "available", F.explode(values).alias("x")).where("x.kind = 0 or x.v is not null")
    counted = stated.groupBy(*keys, "x.kind", "x.v").agg(F.count(F.lit(1)).alias("n"), F.bool_or("available").alias("available"))
    price = F.col("kind") == 0
    mode = lambda which: -F.max(F.when(which & F.col("v").isNotNull(), F.struct("n", (-F.col("v")).alias("least"))))["least"]
    return counted.groupBy(*keys).agg(
        mode(price).alias("price_qepik"),
        mode(~price).alias("old_price_qepik"),
        F.bool_or("available").alias("available"),
        F.sum(F.when(price, F.col("n"))).alias("n_stores"),
        F.count(F.when(price & F.col("v").isNotNull(), 1)).alias("n_distinct_prices"),
    )


def regular_price(daily: DataFrame) -> DataFrame:
    """Adds is_promo, the last ordinary price at or before the day, and whether it was observed or only claimed."""
    promo = F.coalesce(F.col("old_price_qepik") > F.col("price_qepik"), F.lit(False))
    before = Window.partitionBy("store_item_id", "price_point_key").orderBy("observed_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flagged = daily.withColumn("is_promo", promo).withColumn("_ordinary", F.last(F.when(~promo, F.col("price_qepik")), ignorenulls=True).over(before))
    return flagged.select(
        *daily.columns,
        "is_promo",
        F.coalesce("_ordinary", "old_price_qepik").alias("regular_price_qepik"),
        F.when(F.col("is_promo") & F.col("_ordinary").isNull(), F.lit("claimed")).otherwise(F.lit("observed")).alias("regular_price_source"),
    )


def daily_fact(regular: DataFrame) -> DataFrame:
    return regular.drop("price_zone").withColumn("date_key", F.date_format("observed_date", "yyyyMMdd").cast("int"))


def with_product(fact: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The fact with each item's product and the product's category; AQE broadcasts the dimensions while they are small."""
    return fact.join(items.select("store_item_id", "product_key"), "store_item_id").join(products.select("product_key", "category"), "product_key")


def retailer_regular_daily(fact: DataFrame) -> DataFrame:
    """Median of a retailer's ordinary prices by day and product."""
    return fact.where(~F.col("is_promo")).groupBy("observed_date", "product_key", "retailer_code").agg(half_even(median("price_qepik")).alias("regular_price_qepik"))


def period_price_point(fact: DataFrame, period: str = "quarter", min_days: int = SETTINGS.index_min_days) -> DataFrame:
    """Averages of a period by product and price point, for cells with enough distinct days."""
    return (
        fact.groupBy("product_key", "price_point_key", "retailer_code", F.trunc("observed_date", period).alias("period_start"))
        .agg(
            F.avg("regular_price_qepik").alias("regular_price_avg"),
            F.avg("price_qepik").alias("effective_price_avg"),
            F.avg(F.col("is_promo").cast("int")).alias("promo_share"),
            F.countDistinct("observed_date").alias("n_days"),
        )
        .where(F.col("n_days") >= min_days)
    )


def period_retailer(cells: DataFrame, products: DataFrame) -> DataFrame:
    """Price points of a retailer averaged to the retailer."""
    return (
        cells.join(products.select("product_key", "category"), "product_key")
        .groupBy("product_key", "category", "retailer_code", "period_start")
        .agg(F.avg("regular_price_avg").alias("regular_price_avg"), F.avg("effective_price_avg").alias("effective_price_avg"), F.avg("promo_share").alias("promo_share"))
    )


def price_index(levels: DataFrame) -> DataFrame:
    """Geometric mean of price relatives to the first period over matched pairs, by category and in all.

    The change against the period before is that of the rounded index.
    """
    first = levels.agg(F.min("period_start")).scalar()
    base = levels.where(F.col("period_start") == first).select("product_key", "retailer_code", F.col("regular_price_avg").alias("base_regular"), F.col("effective_price_avg").alias("base_effective"))
    relatives = levels.join(base, ["product_key", "retailer_code"]).select(
        "period_start", "category", F.ln(F.col("regular_price_avg") / F.col("base_regular")).alias("ln_regular"), F.ln(F.col("effective_price_avg") / F.col("base_effective")).alias("ln_effective")
    )
    rolled = relatives.groupingSets([["period_start", "category"], ["period_start"]], "period_start", "category").agg(
        F.grouping("category").alias("_all"),
        F.round(F.exp(F.avg("ln_regular")) * 100, 2).alias("index_regular"),
        F.round(F.exp(F.avg("ln_effective")) * 100, 2).alias("index_effective"),
        F.count(F.lit(1)).alias("n_items"),
    )
    named = rolled.withColumn("category", F.when(F.col("_all") == 1, F.lit("All categories")).otherwise(F.col("category"))).drop("_all")
    before = F.lag("index_regular").over(Window.partitionBy("category").orderBy("period_start"))
    return named.withColumn("change_pct", F.round((F.col("index_regular") / F.when(before != 0, before) - 1) * 100, 2))


def competitiveness(cells: DataFrame) -> DataFrame:
    """Price points against the median of at least three retailers, and how often they are cheapest, ties included.

    The cheapest other retailer comes from the two lowest retailer levels, without a join of
    retailers with each other.
    """
    keys = ["product_key", "period_start"]
    level = cells.groupBy(*keys, "retailer_code").agg(median("regular_price_avg").alias("price"))
    market = level.groupBy(*keys).agg(
        median("price").alias("market_median"), F.count(F.lit(1)).alias("n"), F.min(F.struct("price", "retailer_code")).alias("_low"), F.array_sort(F.collect_list("price")).alias("_prices")
    ).where(F.col("n") >= 3)
    own_is_lowest = F.col("_low.retailer_code") == F.col("retailer_code")
    other = F.when(own_is_lowest, F.get("_prices", F.lit(1))).otherwise(F.col("_low.price"))
    compared = cells.join(market, keys)
    return compared.groupBy("period_start", "price_point_key", "retailer_code").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.round(F.exp(F.avg(F.ln(F.col("regular_price_avg") / F.col("market_median")))) * 100, 2).alias("price_index_vs_market"),
        share_pct(F.avg((F.col("regular_price_avg") <= F.coalesce(other, F.lit(1e12))).cast("int"))).alias("share_cheapest_pct"),
        share_pct(F.avg("promo_share")).alias("promo_share_pct"),
    )


def promo_analysis(fact: DataFrame, regular: DataFrame, gap_bp: int = SETTINGS.inflated_gap_bp) -> DataFrame:
    """Each promotion day against the median ordinary price of the other retailers.

    The reference is computed once for each day, product and retailer that has promotions, by
    an equi-join on day and product.
    """
    promo = fact.where("is_promo")
    asked = promo.select("observed_date", "product_key", F.col("retailer_code").alias("_own")).distinct()
    market = (
        asked.join(regular, ["observed_date", "product_key"])
        .where(F.col("retailer_code") != F.col("_own"))
        .groupBy("observed_date", "product_key", F.col("_own").alias("retailer_code"))
        .agg(half_even(median("regular_price_qepik")).alias("market_ref_qepik"), F.count(F.lit(1)).alias("_n"))
    )
    joined = promo.join(market, ["observed_date", "product_key", "retailer_code"], "left")
    old, price, own, ref = (F.col(c) for c in ("old_price_qepik", "price_qepik", "regular_price_qepik", "market_ref_qepik"))
    judged = joined.select(
        "observed_date", "product_key", "store_item_id", "price_point_key", "retailer_code", "category", price, old, own, "regular_price_source", ref,
        F.coalesce("_n", F.lit(0)).alias("market_ref_retailers"),
        half_away((old - price) * 10000, old).alias("claimed_discount_bp"),
        half_away((ref - price) * 10000, ref).alias("real_discount_bp"),
        half_away((old - own) * 10000, own).alias("claim_vs_own_regular_bp"),
        F.coalesce((ref * 100 >= old * 33) & (ref <= old * 3), F.lit(False)).alias("ref_reliable"),
        "available",
    )
    return judged.withColumns(
        {
            "inflated_flag": F.col("ref_reliable") & F.coalesce(F.col("claimed_discount_bp") - F.col("real_discount_bp") > gap_bp, F.lit(False)),
            "fake_flag": F.col("ref_reliable") & F.coalesce(price >= ref, F.lit(False)),
        }
    )


def promo_summary(promos: DataFrame, period: str = "quarter") -> DataFrame:
    reliable = lambda c: F.when(F.col("ref_reliable"), F.col(c))
    return promos.groupBy(F.trunc("observed_date", period).alias("period_start"), "retailer_code").agg(
        F.count(F.lit(1)).alias("promo_price_days"),
        half_even(median("claimed_discount_bp")).alias("median_claimed_bp"),
        half_even(median(reliable("real_discount_bp"))).alias("median_real_bp"),
        share_pct(F.avg(reliable("inflated_flag").cast("int"))).alias("inflated_share_pct"),
        share_pct(F.avg(reliable("fake_flag").cast("int"))).alias("fake_share_pct"),
    )


def category_trend(index: DataFrame, promos: DataFrame, fact: DataFrame, period: str = "quarter") -> DataFrame:
    start = F.trunc("observed_date", period).alias("period_start")
    days = fact.groupBy(start, "category").agg(F.count(F.lit(1)).alias("_days"))
    promo = promos.groupBy(start, "category").agg(F.count(F.lit(1)).alias("_promo"), half_even(median(F.when(F.col("ref_reliable"), F.col("real_discount_bp")))).alias("median_real_bp"))
    share = promo.join(days, ["period_start", "category"]).select("period_start", "category", share_pct(F.col("_promo") / F.col("_days")).alias("promo_share_pct"), "median_real_bp")
    return index.join(share, ["period_start", "category"], "left")


def price_current(fact: DataFrame) -> DataFrame:
    """Latest row of each item and price point, by aggregation before the shuffle."""
    kept = ["retailer_code", "product_key", "observed_date", "price_qepik", "old_price_qepik", "regular_price_qepik", "is_promo", "available"]
    last = fact.groupBy("store_item_id", "price_point_key").agg(F.max_by(F.struct(*kept), F.col("observed_date")).alias("_r"))
    last_day = fact.agg(F.max("observed_date")).scalar()
    return last.select("store_item_id", "price_point_key", "_r.*", F.datediff(last_day, F.col("_r.observed_date")).alias("days_since_observed"))


def price_changes(fact: DataFrame) -> DataFrame:
    before = F.lag("regular_price_qepik").over(Window.partitionBy("store_item_id", "price_point_key").orderBy("observed_date"))
    moves = fact.withColumn("_before", before).where(F.col("_before") > 0)
    now, old = F.col("regular_price_qepik"), F.col("_before")
    bp = (now - old) * 10000.0 / old
    return moves.groupBy("observed_date", "retailer_code", "category").agg(
        F.count(F.when(now > old, 1)).alias("n_increases"),
        F.count(F.when(now < old, 1)).alias("n_decreases"),
        F.count(F.lit(1)).alias("n_compared"),
        F.round(F.avg(F.when(now > old, bp)), 4).alias("avg_increase_bp"),
        F.round(F.avg(F.when(now < old, bp)), 4).alias("avg_decrease_bp"),
    )


def price_movers(fact: DataFrame, days: int = SETTINGS.movers_days) -> DataFrame:
    """Change of the median ordinary price between the last day and ``days`` before it; only those two days are read further."""
    last_day = fact.agg(F.max("observed_date")).scalar()
    ends = fact.where((F.col("observed_date") == last_day) | (F.col("observed_date") == F.date_sub(last_day, days)))
    at = ends.groupBy("product_key", "retailer_code", "observed_date").agg(half_even(median("regular_price_qepik")).alias("price"))
    now = at.where(F.col("observed_date") == last_day).select("product_key", "retailer_code", "observed_date", F.col("price").alias("price_now_qepik"))
    ago = at.where(F.col("observed_date") != last_day).select("product_key", "retailer_code", F.col("price").alias("price_ago_qepik"))
    return now.join(ago, ["product_key", "retailer_code"]).where(F.col("price_ago_qepik") > 0).withColumn("change_bp", half_away((F.col("price_now_qepik") - F.col("price_ago_qepik")) * 10000, F.col("price_ago_qepik")))


def dim_product(items: DataFrame) -> DataFrame:
    """Products with the category of most of their items, and their numbers of retailers and items."""
    return items.groupBy("product_key").agg(
        F.expr("mode() WITHIN GROUP (ORDER BY category)").alias("category"), F.countDistinct("retailer_code").alias("retailer_count"), F.count(F.lit(1)).alias("store_item_count")
    )


def dim_price_point(daily: DataFrame) -> DataFrame:
    points = daily.select("price_point_key", "retailer_code", "price_zone").distinct()
    whole = F.col("price_zone") == "all"
    return points.select("*", (~whole).alias("requires_zone_choice"), F.when(whole, F.col("retailer_code")).otherwise(F.concat("retailer_code", F.lit(" (zone "), "price_zone", F.lit(")"))).alias("label"))


def dim_category(products: DataFrame) -> DataFrame:
    """Categories numbered in their order; there are as many rows as categories, so one task numbers them."""
    return products.select("category").distinct().withColumn("category_key", F.row_number().over(Window.orderBy("category")))


def dim_date(days: DataFrame, day: str = "observed_date") -> DataFrame:
    """Calendar from the first to the last day."""
    bounds = days.agg(F.min(day).alias("a"), F.max(day).alias("b")).where(F.col("a").isNotNull())
    d = F.col("date_day")
    return bounds.select(F.explode(F.sequence("a", "b")).alias("date_day")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
        (F.weekday(d) + 1).alias("iso_weekday"),
        F.date_format(d, "E").alias("weekday_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def basket_definition(products: DataFrame, quantities: DataFrame, min_retailers: int = SETTINGS.basket_min_retailers, per_category: int = SETTINGS.basket_items_per_category) -> DataFrame:
    """Top products of each category by retailers, then fewest items, then key."""
    n = products.agg(F.max("retailer_count")).scalar()
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("retailer_count"), "store_item_count", "product_key"))
    top = products.where(F.col("retailer_count") >= F.least(F.lit(min_retailers), n)).withColumn("_rank", rank).where(F.col("_rank") <= per_category)
    return top.join(quantities, "category").select("product_key", "category", "quantity")


def cheapest_basket(fact: DataFrame, basket: DataFrame) -> DataFrame:
    """Cost of the basket by day and price point; complete ones are ranked within their day."""
    needed = basket.select("product_key", "quantity")
    priced = fact.where("available").join(needed, "product_key").groupBy("observed_date", "price_point_key", "product_key", "quantity").agg(F.min("price_qepik").alias("_price"))
    totals = priced.groupBy("observed_date", "price_point_key").agg(F.count(F.lit(1)).alias("items_available"), F.sum(F.col("_price") * F.col("quantity")).alias("total_qepik"))
    n = basket.agg(F.count(F.lit(1))).scalar()
    complete = F.col("items_available") == F.col("items_total")
    marked = totals.withColumn("items_total", n).withColumn("is_complete", complete)
    rank = F.rank().over(Window.partitionBy("observed_date", "is_complete").orderBy("total_qepik"))
    return marked.withColumn("rank_overall", F.when(F.col("is_complete"), rank))


def best_split(fact: DataFrame, basket: DataFrame) -> DataFrame:
    """The basket on the last day that has any of it: each product at its cheapest price point, the smallest key of equally cheap ones."""
    offered = fact.where("available").join(basket.select("product_key", "quantity"), "product_key")
    on = offered.where(F.col("observed_date") == offered.agg(F.max("observed_date")).scalar())
    best = on.groupBy("product_key", "quantity").agg(F.min(F.struct("price_qepik", "price_point_key")).alias("_b"))
    return best.select("product_key", "quantity", "_b.price_point_key", "_b.price_qepik", (F.col("_b.price_qepik") * F.col("quantity")).alias("cost_qepik"))
