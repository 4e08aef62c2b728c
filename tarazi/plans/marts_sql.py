"""Oracle SQL of the mart queries: the same adapter, then each model."""

OBS = """obs AS (
  SELECT r_name AS retailer_code, n_name AS price_zone, concat(r_name, ':', n_name) AS price_point_key, l_suppkey AS store_id, p_brand AS product_key, p_type AS category,
    concat(p_brand, '|', p_type, '|', r_name, ':', n_name) AS store_item_id, CAST(l_shipdate AS DATE) AS observed_date, l_returnflag <> 'R' AS available,
    CASE WHEN off >= 8 THEN (list * 2 * (100 - off) + 100) // 200 ELSE list END AS price_qepik, CASE WHEN off >= 8 THEN list END AS old_price_qepik
  FROM (SELECT *, (CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT)) // (CAST(l_quantity AS BIGINT) * 2) AS list, CAST(round(l_discount * 100) AS BIGINT) AS off FROM lineitem) l
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey
), items AS (SELECT DISTINCT store_item_id, retailer_code, price_point_key, product_key, category FROM obs),
products AS (SELECT product_key, mode(category ORDER BY category) AS category, count(DISTINCT retailer_code) AS retailer_count, count(*) AS store_item_count FROM items GROUP BY 1)"""
DAILY = """daily AS (
  SELECT store_item_id, retailer_code, price_point_key, price_zone, observed_date, mode(price_qepik ORDER BY price_qepik) AS price_qepik, mode(old_price_qepik ORDER BY old_price_qepik) AS old_price_qepik,
    bool_or(available) AS available, count(*) AS n_stores, count(DISTINCT price_qepik) AS n_distinct_prices FROM obs GROUP BY 1, 2, 3, 4, 5
)"""
REGULAR = """regular AS (
  SELECT *, coalesce(old_price_qepik > price_qepik, false) AS is_promo,
    last_value(CASE WHEN NOT coalesce(old_price_qepik > price_qepik, false) THEN price_qepik END IGNORE NULLS) OVER (PARTITION BY store_item_id, price_point_key ORDER BY observed_date ROWS UNBOUNDED PRECEDING) AS ordinary FROM daily
), fact0 AS (
  SELECT store_item_id, retailer_code, price_point_key, observed_date, price_qepik, old_price_qepik, available, n_stores, n_distinct_prices, is_promo, coalesce(ordinary, old_price_qepik) AS regular_price_qepik,
    CASE WHEN is_promo AND ordinary IS NULL THEN 'claimed' ELSE 'observed' END AS regular_price_source, CAST(strftime(observed_date, '%Y%m%d') AS INTEGER) AS date_key FROM regular
), fact AS (SELECT f.*, i.product_key, p.category FROM fact0 f JOIN items i USING (store_item_id) JOIN products p USING (product_key))"""
FACT = f"WITH {OBS}, {DAILY}, {REGULAR}"
REF = "ref AS (SELECT observed_date, product_key, retailer_code, CAST(round_even(quantile_cont(price_qepik, 0.5), 0) AS BIGINT) AS regular_price_qepik FROM fact WHERE NOT is_promo GROUP BY 1, 2, 3)"
CELLS = """cells AS (SELECT product_key, price_point_key, retailer_code, CAST(date_trunc('quarter', observed_date) AS DATE) AS period_start, avg(regular_price_qepik) AS regular_price_avg, avg(price_qepik) AS effective_price_avg,
  avg(CAST(is_promo AS INTEGER)) AS promo_share, count(DISTINCT observed_date) AS n_days FROM fact GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT observed_date) >= 4)"""
LEVELS = """levels AS (SELECT product_key, category, retailer_code, period_start, avg(regular_price_avg) AS regular_price_avg, avg(effective_price_avg) AS effective_price_avg, avg(promo_share) AS promo_share
  FROM cells JOIN products USING (product_key) GROUP BY 1, 2, 3, 4)"""
INDEX = """index0 AS (
  SELECT period_start, CASE WHEN grouping(category) = 1 THEN 'All categories' ELSE category END AS category, round(100 * exp(avg(a)), 2) AS index_regular, round(100 * exp(avg(b)), 2) AS index_effective, count(*) AS n_items
  FROM (SELECT l.period_start, l.category, ln(l.regular_price_avg / b.regular_price_avg) AS a, ln(l.effective_price_avg / b.effective_price_avg) AS b FROM levels l
        JOIN levels b USING (product_key, retailer_code) WHERE b.period_start = (SELECT min(period_start) FROM levels)) GROUP BY GROUPING SETS ((period_start, category), (period_start))
), idx AS (SELECT *, round((index_regular / nullif(lag(index_regular) OVER (PARTITION BY category ORDER BY period_start), 0) - 1) * 100, 2) AS change_pct FROM index0)"""
BP = "CAST(sign({n}) AS BIGINT) * ((abs({n}) * 2 + {d}) // ({d} * 2))"
PROMO = f"""promo AS (
  SELECT p.observed_date, p.product_key, p.store_item_id, p.price_point_key, p.retailer_code, p.category, p.price_qepik, p.old_price_qepik, p.regular_price_qepik, p.regular_price_source, m.r AS market_ref_qepik,
    coalesce(m.n, 0) AS market_ref_retailers, {BP.format(n='((p.old_price_qepik - p.price_qepik) * 10000)', d='nullif(p.old_price_qepik, 0)')} AS claimed_discount_bp,
    {BP.format(n='((m.r - p.price_qepik) * 10000)', d='nullif(m.r, 0)')} AS real_discount_bp, {BP.format(n='((p.old_price_qepik - p.regular_price_qepik) * 10000)', d='nullif(p.regular_price_qepik, 0)')} AS claim_vs_own_regular_bp,
    coalesce(m.r * 100 >= p.old_price_qepik * 33 AND m.r <= p.old_price_qepik * 3, false) AS ref_reliable, p.available
  FROM fact p LEFT JOIN (SELECT a.observed_date, a.product_key, a.retailer_code, CAST(round_even(quantile_cont(b.regular_price_qepik, 0.5), 0) AS BIGINT) AS r, count(*) AS n
    FROM (SELECT DISTINCT observed_date, product_key, retailer_code FROM fact WHERE is_promo) a JOIN ref b ON a.observed_date = b.observed_date AND a.product_key = b.product_key AND a.retailer_code <> b.retailer_code GROUP BY 1, 2, 3) m
    ON m.observed_date = p.observed_date AND m.product_key = p.product_key AND m.retailer_code = p.retailer_code WHERE p.is_promo
), promos AS (SELECT *, ref_reliable AND coalesce(claimed_discount_bp - real_discount_bp > 1500, false) AS inflated_flag, ref_reliable AND coalesce(price_qepik >= market_ref_qepik, false) AS fake_flag FROM promo)"""
SUMMARY = """SELECT CAST(date_trunc('quarter', observed_date) AS DATE) AS period_start, retailer_code, count(*) AS promo_price_days, CAST(round_even(quantile_cont(claimed_discount_bp, 0.5), 0) AS BIGINT) AS median_claimed_bp,
  CAST(round_even(quantile_cont(real_discount_bp, 0.5) FILTER (WHERE ref_reliable), 0) AS BIGINT) AS median_real_bp, round(round(avg(CAST(inflated_flag AS INTEGER)) FILTER (WHERE ref_reliable) * 100, 6), 1) AS inflated_share_pct,
  round(round(avg(CAST(fake_flag AS INTEGER)) FILTER (WHERE ref_reliable) * 100, 6), 1) AS fake_share_pct FROM promos GROUP BY 1, 2"""
BASKET = """basket AS (SELECT product_key, category, CAST(2 AS BIGINT) AS quantity FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY retailer_count DESC, store_item_count, product_key) AS rk FROM products
  WHERE retailer_count >= least(5, (SELECT max(retailer_count) FROM products))) WHERE rk <= 2)"""
CHEAPEST = """SELECT observed_date, price_point_key, items_available, total_qepik, n AS items_total, items_available = n AS is_complete,
  CASE WHEN items_available = n THEN rank() OVER (PARTITION BY observed_date, items_available = n ORDER BY total_qepik) END AS rank_overall
  FROM (SELECT observed_date, price_point_key, count(*) AS items_available, CAST(sum(price * quantity) AS BIGINT) AS total_qepik FROM
    (SELECT observed_date, price_point_key, product_key, quantity, min(price_qepik) AS price FROM fact JOIN basket USING (product_key) WHERE available GROUP BY 1, 2, 3, 4) GROUP BY 1, 2), (SELECT count(*) AS n FROM basket)"""

ORACLES = {
    "daily_price_mode": f"WITH {OBS}, {DAILY} SELECT * FROM daily",
    "regular_price": f"{FACT} SELECT store_item_id, retailer_code, price_point_key, price_zone, observed_date, price_qepik, old_price_qepik, available, n_stores, n_distinct_prices, is_promo, coalesce(ordinary, old_price_qepik) AS regular_price_qepik, CASE WHEN is_promo AND ordinary IS NULL THEN 'claimed' ELSE 'observed' END AS regular_price_source FROM regular",
    "fact_daily": f"{FACT} SELECT * FROM fact0",
    "fact_incremental": f"""{FACT}, first AS ({FACT.replace('), items AS', ' WHERE l_returnflag <> ' + chr(39) + 'R' + chr(39) + '), items AS', 1)} SELECT * FROM fact0), d AS (SELECT max(observed_date) - 7 AS d FROM first)
      SELECT * FROM fact0 WHERE observed_date >= (SELECT d FROM d) UNION ALL SELECT * FROM first WHERE observed_date < (SELECT d FROM d)""",
    "ref_regular": f"{FACT}, {REF} SELECT * FROM ref",
    "period_price_point": f"{FACT}, {CELLS} SELECT product_key, price_point_key, retailer_code, period_start, round(regular_price_avg, 6) AS regular_price_avg, round(effective_price_avg, 6) AS effective_price_avg, round(promo_share, 6) AS promo_share, n_days FROM cells",
    "period_retailer": f"{FACT}, {CELLS}, {LEVELS} SELECT product_key, category, retailer_code, period_start, round(regular_price_avg, 6) AS regular_price_avg, round(effective_price_avg, 6) AS effective_price_avg, round(promo_share, 6) AS promo_share FROM levels",
    "price_index": f"{FACT}, {CELLS}, {LEVELS}, {INDEX} SELECT * FROM idx",
    "competitiveness": f"""{FACT}, {CELLS}, level AS (SELECT product_key, period_start, retailer_code, quantile_cont(regular_price_avg, 0.5) AS price FROM cells GROUP BY 1, 2, 3),
        market AS (SELECT product_key, period_start, quantile_cont(price, 0.5) AS med FROM level GROUP BY 1, 2 HAVING count(*) >= 3)
        SELECT c.period_start, c.price_point_key, c.retailer_code, count(*) AS n_products, round(100 * exp(avg(ln(c.regular_price_avg / m.med))), 2) AS price_index_vs_market,
        round(round(avg(CAST(c.regular_price_avg <= coalesce((SELECT min(l.price) FROM level l WHERE l.product_key = c.product_key AND l.period_start = c.period_start AND l.retailer_code <> c.retailer_code), 1e12) AS INTEGER)) * 100, 6), 1) AS share_cheapest_pct,
        round(round(avg(c.promo_share) * 100, 6), 1) AS promo_share_pct FROM cells c JOIN market m USING (product_key, period_start) GROUP BY 1, 2, 3""",
    "promo_analysis": f"{FACT}, {REF}, {PROMO} SELECT * FROM promos",
    "promo_summary": f"{FACT}, {REF}, {PROMO} {SUMMARY}",
    "category_trend": f"""{FACT}, {REF}, {PROMO}, {CELLS}, {LEVELS}, {INDEX}, d AS (SELECT CAST(date_trunc('quarter', observed_date) AS DATE) AS period_start, category, count(*) AS days FROM fact GROUP BY 1, 2),
        p AS (SELECT CAST(date_trunc('quarter', observed_date) AS DATE) AS period_start, category, count(*) AS n, CAST(round_even(quantile_cont(real_discount_bp, 0.5) FILTER (WHERE ref_reliable), 0) AS BIGINT) AS median_real_bp FROM promos GROUP BY 1, 2)
        SELECT i.*, CASE WHEN p.n IS NOT NULL THEN round(round(p.n::DOUBLE / d.days * 100, 6), 1) END AS promo_share_pct, p.median_real_bp FROM idx i LEFT JOIN (p JOIN d USING (period_start, category)) ON p.period_start = i.period_start AND p.category = i.category""",
    "price_current": f"{FACT} SELECT store_item_id, price_point_key, retailer_code, product_key, observed_date, price_qepik, old_price_qepik, regular_price_qepik, is_promo, available, date_diff('day', observed_date, (SELECT max(observed_date) FROM fact)) AS days_since_observed FROM fact QUALIFY row_number() OVER (PARTITION BY store_item_id, price_point_key ORDER BY observed_date DESC) = 1",
    "price_changes": f"""{FACT}, m AS (SELECT *, lag(regular_price_qepik) OVER (PARTITION BY store_item_id, price_point_key ORDER BY observed_date) AS prev FROM fact)
        SELECT observed_date, retailer_code, category, count(*) FILTER (WHERE regular_price_qepik > prev) AS n_increases, count(*) FILTER (WHERE regular_price_qepik < prev) AS n_decreases, count(*) AS n_compared,
        round(avg((regular_price_qepik - prev) * 10000.0::DOUBLE / prev) FILTER (WHERE regular_price_qepik > prev), 4) AS avg_increase_bp, round(avg((regular_price_qepik - prev) * 10000.0::DOUBLE / prev) FILTER (WHERE regular_price_qepik < prev), 4) AS avg_decrease_bp
        FROM m WHERE prev > 0 GROUP BY 1, 2, 3""",
    "price_movers": f"""{FACT}, t AS (SELECT product_key, retailer_code, observed_date, CAST(round_even(quantile_cont(regular_price_qepik, 0.5), 0) AS BIGINT) AS price FROM fact GROUP BY 1, 2, 3), l AS (SELECT max(observed_date) AS d FROM fact)
        SELECT n.product_key, n.retailer_code, n.observed_date, n.price AS price_now_qepik, o.price AS price_ago_qepik, {BP.format(n='((n.price - o.price) * 10000)', d='o.price')} AS change_bp
        FROM t n, t o, l WHERE n.observed_date = l.d AND o.observed_date = l.d - 28 AND n.product_key = o.product_key AND n.retailer_code = o.retailer_code AND o.price > 0""",
    "basket_definition": f"WITH {OBS}, {BASKET} SELECT * FROM basket",
    "cheapest_basket": f"{FACT}, {BASKET} {CHEAPEST}",
    "custom_basket_split": f"""{FACT}, {BASKET} SELECT product_key, quantity, min_by(price_point_key, (price_qepik, price_point_key)) AS price_point_key, min(price_qepik) AS price_qepik, min(price_qepik) * quantity AS cost_qepik
        FROM fact JOIN basket USING (product_key) WHERE available AND observed_date = (SELECT max(observed_date) FROM fact JOIN basket USING (product_key) WHERE available) GROUP BY product_key, quantity""",
    "dim_date": f"WITH {OBS} SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date_day, CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start, isodow(d) AS iso_weekday, strftime(d, '%a') AS weekday_name, isodow(d) >= 6 AS is_weekend FROM (SELECT unnest(generate_series(CAST(min(observed_date) AS TIMESTAMP), CAST(max(observed_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM obs)",
    "dim_product": f"WITH {OBS} SELECT * FROM products",
    "dim_category": f"WITH {OBS} SELECT category, row_number() OVER (ORDER BY category) AS category_key FROM (SELECT DISTINCT category FROM products)",
    "dim_price_point": f"WITH {OBS} SELECT DISTINCT price_point_key, retailer_code, price_zone, price_zone <> 'all' AS requires_zone_choice, CASE WHEN price_zone = 'all' THEN retailer_code ELSE concat(retailer_code, ' (zone ', price_zone, ')') END AS label FROM obs",
    "dim_store_item": f"WITH {OBS} SELECT * FROM items",
    "zone_consistency": f"WITH {OBS} SELECT retailer_code, count(*) AS cells, count(*) FILTER (WHERE n > 1) AS mixed FROM (SELECT retailer_code, store_item_id, observed_date, count(DISTINCT price_qepik) AS n FROM obs GROUP BY 1, 2, 3) GROUP BY 1",
    "price_jumps": f"{FACT} SELECT store_item_id, price_point_key, observed_date, price_qepik, prev AS previous FROM (SELECT *, lag(price_qepik) OVER (PARTITION BY store_item_id, price_point_key ORDER BY observed_date) AS prev FROM fact0) WHERE prev > 0 AND (CAST(price_qepik AS DOUBLE) / prev > 2.5 OR CAST(price_qepik AS DOUBLE) / prev < 0.4)",
    "quarantine_price_spread": f"{FACT} SELECT product_key, min(price_qepik) AS lowest, max(price_qepik) AS highest, count(*) AS n FROM fact WHERE NOT is_promo GROUP BY 1 HAVING max(price_qepik) * 100 > min(price_qepik) * 300",
    "latest_promotions_topn": f"{FACT}, {REF}, {PROMO} SELECT store_item_id, price_point_key, observed_date, real_discount_bp FROM promos ORDER BY observed_date DESC, real_discount_bp DESC NULLS LAST, store_item_id, price_point_key LIMIT 50",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dedupe_first": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1",
    "reconciliation": "SELECT o_orderkey, stated, lines, stated - lines AS difference FROM (SELECT o_orderkey, CAST(3 AS BIGINT) AS stated, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines FROM orders) WHERE stated <> lines",
    "batch_reconciliation": "SELECT batch_id, stated, raw, stated - raw AS difference FROM (SELECT b.batch_id, CAST(b.row_count AS BIGINT) AS stated, (SELECT count(*) FROM raw_record r WHERE r.batch_id = b.batch_id) AS raw FROM ingest_batch b) WHERE stated IS DISTINCT FROM raw",
    "trailing_median": "SELECT source, business_date, n, m AS trailing_median, n / m AS ratio FROM (SELECT source, business_date, n, CASE WHEN count(n) OVER w >= 4 THEN quantile_cont(n, 0.5) OVER w END AS m FROM (SELECT source, business_date, count(*) AS n FROM raw_record GROUP BY 1, 2) WINDOW w AS (PARTITION BY source ORDER BY business_date ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))",
    "freshness": "SELECT r.code AS source, max(business_date) AS last_day, coalesce(date_diff('day', max(business_date), DATE '2026-04-18'), 9999) AS lag_days FROM retailer r LEFT JOIN raw_record ON source = r.code GROUP BY 1",
    "ean_conflicts": "SELECT ean, count(DISTINCT struct_pack(a := unit_type, b := unit_value, c := pack)) AS n FROM store_item WHERE ean_kind = 'global' GROUP BY ean HAVING count(DISTINCT struct_pack(a := unit_type, b := unit_value, c := pack)) > 1",
    "gtin_check": """SELECT id, coalesce(regexp_full_match(ean, '[0-9]+') AND length(ean) IN (8, 12, 13, 14) AND (10 - (SELECT sum(CAST(substr(ean, length(ean) - i, 1) AS INTEGER) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END) FROM (SELECT unnest(generate_series(1, length(ean) - 1)) AS i)) % 10) % 10 = CAST(right(ean, 1) AS INTEGER), false) AS is_valid
        FROM (SELECT id, CASE WHEN regexp_full_match(ean, '[0-9]+') THEN ean END AS ean FROM store_item)""",
    "normalize_text": "SELECT id, trim(regexp_replace(strip_accents(lower(translate(name_raw, 'ƏəIıİÖöÜüÇçŞşĞğ', 'aaiiioouuccssgg'))), '\\s+', ' ', 'g')) AS norm FROM store_item",
    "lineage_union": "SELECT 'raw' AS kind, source, count(*) AS n FROM raw_record GROUP BY 2 UNION ALL SELECT 'batch', source, count(*) FROM ingest_batch GROUP BY 2",
    "sha_dedupe": "SELECT any_value(source) AS source, file_sha256, min(batch_id) AS batch_id FROM ingest_batch GROUP BY source, file_sha256",
    "match_quality": "WITH l AS (SELECT store_item_id, max_by(product_id, (snapshot_date, loaded_at, product_id)) AS p FROM product_match_snap WHERE product_id IS NOT NULL GROUP BY 1), j AS (SELECT p AS a, ean AS b FROM l JOIN store_item ON id = store_item_id WHERE ean_kind = 'global' AND ean IS NOT NULL) SELECT f AS found, t AS real, r AS \"right\", r / nullif(f, 0) AS \"precision\", r / nullif(t, 0) AS recall FROM (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS f FROM (SELECT count(*) AS n FROM j GROUP BY a)), (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS t FROM (SELECT count(*) AS n FROM j GROUP BY b)), (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS r FROM (SELECT count(*) AS n FROM j GROUP BY a, b))",
    "product_search": "SELECT p_partkey, p_name, p_brand FROM part WHERE lower(p_name) LIKE '%ring%' ORDER BY p_name, p_partkey LIMIT 50 OFFSET 20",
    "history_hash": f"{FACT} SELECT store_item_id, price_point_key, md5(string_agg(concat(strftime(observed_date, '%Y-%m-%d'), '=', price_qepik), ',' ORDER BY observed_date)) AS history FROM fact0 GROUP BY 1, 2",
    "scd2_snapshot": """WITH a AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer), b AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer)
        SELECT a.c_custkey, a.c_mktsegment, a.c_nationkey, DATE '2026-01-01' AS valid_from, CASE WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN DATE '2026-02-01' END AS valid_to FROM a JOIN b USING (c_custkey)
        UNION ALL SELECT b.c_custkey, b.c_mktsegment, b.c_nationkey, DATE '2026-02-01', NULL FROM a JOIN b USING (c_custkey) WHERE a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""",
    "item_upsert": """WITH o AS (SELECT retailer_code, sku, brand, ean, first_seen, last_seen FROM store_item WHERE first_seen < DATE '2026-01-01'), n AS (SELECT retailer_code, sku, brand, ean, first_seen, last_seen FROM store_item WHERE last_seen >= DATE '2025-12-01')
        SELECT coalesce(o.retailer_code, n.retailer_code) AS retailer_code, coalesce(o.sku, n.sku) AS sku, coalesce(o.brand, n.brand) AS brand, coalesce(o.ean, n.ean) AS ean, least(o.first_seen, n.first_seen) AS first_seen, greatest(o.last_seen, n.last_seen) AS last_seen FROM o FULL JOIN n ON o.retailer_code = n.retailer_code AND o.sku = n.sku""",
    "append_once": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') e WHERE e.o_orderkey = o.o_orderkey)",
    "event_windows": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
ORACLES["basket_saving"] = f"""{FACT}, {BASKET}, whole AS ({CHEAPEST}), split AS ({ORACLES["custom_basket_split"].split("basket AS", 1)[1].split("rk <= 2)", 1)[1].lstrip(") ")}),
  best AS (SELECT price_point_key, total_qepik FROM whole WHERE is_complete AND observed_date = (SELECT max(observed_date) FROM whole WHERE is_complete) ORDER BY total_qepik, price_point_key LIMIT 1)
  SELECT (SELECT price_point_key FROM best) AS price_point_key, (SELECT total_qepik FROM best) AS single_qepik, CAST(sum(cost_qepik) AS BIGINT) AS split_qepik, count(*) AS items, (SELECT total_qepik FROM best) - CAST(sum(cost_qepik) AS BIGINT) AS saving_qepik FROM split"""
