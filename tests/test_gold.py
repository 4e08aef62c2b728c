"""Golden values of a small hand-built market: 4 chains, 4 products, 14 days."""

from datetime import date, timedelta

import pytest

from tarazi.plans import gold

BASE = {"r1": 900, "r2": 1000, "r3": 1000, "r4": 1100}
START = date(2026, 9, 14)
LAST = START + timedelta(13)


@pytest.fixture(scope="module")
def market(spark):
    rows = []
    for r, base in BASE.items():
        for p in range(1, 5):
            for d in range(14):
                price, old = base if d < 7 else base * 11 // 10, None
                if d == 13 and (r, p) == ("r3", 1):
                    price, old = 800, 1600
                if d == 13 and (r, p) == ("r4", 2):
                    price, old = 1000, 1210
                rows.append((f"{r}{p}", r, f"{r}:all", "all", START + timedelta(d), price, old, True))
    obs = spark.createDataFrame(rows, "store_item_id string, retailer_code string, price_point_key string, price_zone string, observed_date date, price_qepik long, old_price_qepik long, available boolean")
    items = spark.createDataFrame([(f"{r}{p}", r, f"{r}:all", p, "Dairy & Eggs") for r in BASE for p in range(1, 5)], "store_item_id string, retailer_code string, price_point_key string, product_key long, category string")
    products = gold.dim_product(items)
    fact = gold.with_product(gold.daily_fact(gold.regular_price(gold.daily_price(obs))), items, products).cache()
    return fact, products


def test_price_index(market):
    fact, products = market
    index = gold.price_index(gold.period_retailer(gold.period_price_point(fact, "week"), products))
    got = {(r.category, r.period_start): (r.index_regular, r.change_pct, r.n_items) for r in index.collect()}
    assert got[("All categories", START)] == (100.0, None, 16)
    assert got[("All categories", START + timedelta(7))][0] == 110.0
    assert got[("Dairy & Eggs", START + timedelta(7))][1] == 10.0


def test_competitiveness(market):
    fact, _ = market
    rows = {r.retailer_code: r for r in gold.competitiveness(gold.period_price_point(fact, "week")).collect() if r.period_start == START}
    assert {k: r.price_index_vs_market for k, r in rows.items()} == {"r1": 90, "r2": 100, "r3": 100, "r4": 110}
    assert (rows["r1"].share_cheapest_pct, rows["r4"].share_cheapest_pct, rows["r1"].n_products) == (100, 0, 4)


def test_promotions(market):
    fact, _ = market
    rows = {r.retailer_code: r for r in gold.promo_analysis(fact, gold.retailer_regular_daily(fact)).collect()}
    a, b = rows["r3"], rows["r4"]
    assert (a.claimed_discount_bp, a.market_ref_qepik, a.real_discount_bp, a.inflated_flag, a.fake_flag, a.ref_reliable, a.regular_price_qepik, a.claim_vs_own_regular_bp) == (5000, 1100, 2727, True, False, True, 1100, 4545)
    assert (b.claimed_discount_bp, b.market_ref_qepik, b.real_discount_bp, b.inflated_flag, b.claim_vs_own_regular_bp) == (1736, 1100, 909, False, 0)


def test_basket(market, spark):
    fact, products = market
    basket = gold.basket_definition(products, spark.createDataFrame([("Dairy & Eggs", 2)], "category string, quantity long"))
    rows = {r.price_point_key: (r.total_qepik, r.rank_overall, r.is_complete) for r in gold.cheapest_basket(fact, basket).collect() if r.observed_date == LAST}
    assert rows == {"r1:all": (3960, 2, True), "r2:all": (4400, 3, True), "r3:all": (3800, 1, True), "r4:all": (4420, 4, True)}
    split = {r.product_key: (r.price_point_key, r.cost_qepik) for r in gold.best_split(fact, basket).collect()}
    assert split == {1: ("r3:all", 1600), 2: ("r1:all", 1980)}


def test_current(market):
    fact, _ = market
    r = gold.price_current(fact).where("store_item_id = 'r31'").first()
    assert (r.price_qepik, r.old_price_qepik, r.is_promo, r.days_since_observed) == (800, 1600, True, 0)


def test_calendar(spark):
    days = spark.createDataFrame([(date(2026, 1, 31),), (date(2026, 2, 2),), (None,)], "observed_date date")
    assert [(r.date_key, r.iso_weekday, r.is_weekend) for r in gold.dim_date(days).orderBy("date_key").collect()] == [(20260131, 6, True), (20260201, 7, True), (20260202, 1, False)]
    assert gold.dim_date(days.where("false")).count() == 0


def test_rounding_half_away(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 3), (1, 0), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(gold.half_away(F.col("a"), F.col("b"))).collect()] == [3, -3, 2, None, None]
    doubles = spark.createDataFrame([(100.5,), (101.5,), (101.7,)], "x double")
    assert [r[0] for r in doubles.select(gold.half_even(F.col("x"))).collect()] == [100, 102, 102]
