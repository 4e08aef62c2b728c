"""Oracle SQL of the queries over the tables of the feeds."""

_KEPT = "price_qepik DESC NULLS LAST, regular_price_qepik DESC NULLS LAST, old_price_qepik DESC NULLS LAST, is_promo DESC NULLS LAST, available DESC NULLS LAST, n_stores DESC NULLS LAST"
DAILY = f"""daily AS (SELECT store_item_id, price_point_key, observed_date, retailer_code, price_qepik, regular_price_qepik, old_price_qepik, is_promo, available, n_stores FROM fct_price_daily
  QUALIFY row_number() OVER (PARTITION BY store_item_id, price_point_key, observed_date ORDER BY observed_at DESC NULLS LAST, {_KEPT}) = 1)"""
DECIDED = "decided AS (SELECT store_item_id, product_id FROM product_match_snap WHERE product_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store_item_id ORDER BY snapshot_date DESC, loaded_at DESC NULLS LAST, product_id DESC) = 1)"
CURRENT = """cur AS (SELECT l.store_item_id, price_point_key, retailer_code, observed_date, price_qepik, is_promo, available, product_id, p.category
  FROM (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY store_item_id, price_point_key ORDER BY observed_date DESC) = 1) l JOIN decided USING (store_item_id) JOIN product p ON p.id = product_id AND NOT coalesce(p.quarantined, false))"""
STORES = """stores AS (SELECT store_key, retailer_code, store_code, store_name, store_format, nullif(upper(trim(price_zone)), '') AS price_zone FROM store_snap
  QUALIFY row_number() OVER (PARTITION BY store_key ORDER BY snapshot_date DESC, loaded_at DESC NULLS LAST, retailer_code DESC NULLS LAST, store_code DESC NULLS LAST, store_name DESC NULLS LAST, store_format DESC NULLS LAST, price_zone DESC NULLS LAST) = 1)"""
REVIEW = """queue AS (SELECT store_item_id, name_raw, product_id, method, CAST(confidence AS DOUBLE) AS confidence FROM (SELECT * FROM product_match_snap
  QUALIFY row_number() OVER (PARTITION BY store_item_id ORDER BY snapshot_date DESC, loaded_at DESC NULLS LAST, status DESC NULLS LAST, confidence DESC NULLS LAST, method DESC NULLS LAST, product_id DESC NULLS LAST) = 1) s
  JOIN store_item i ON i.id = s.store_item_id WHERE s.status = 'pending_review')"""
BP = "CAST(sign({n}) AS BIGINT) * ((abs({n}) * 2 + {d}) // ({d} * 2))"
ORACLES = {
    "feed_daily": f"WITH {DAILY} SELECT * FROM daily",
    "feed_current": f"WITH {DAILY}, {DECIDED}, {CURRENT} SELECT * FROM cur",
    "price_history": f"""WITH {DAILY} SELECT observed_date, retailer_code, min(price_qepik) AS lowest, max(price_qepik) AS highest, count(price_qepik) AS n FROM daily
      WHERE observed_date >= DATE '2026-01-01' AND store_item_id IN (SELECT id FROM store_item WHERE category = ANY(['Beverages', 'Frozen'])) GROUP BY 1, 2""",
    "price_rank": f"WITH {DAILY}, {DECIDED}, {CURRENT} SELECT product_id, store_item_id, price_point_key, price_qepik, rank() OVER (PARTITION BY product_id ORDER BY price_qepik) AS rank_in_product FROM cur WHERE price_qepik IS NOT NULL AND available",
    "weighted_prices": f"""WITH {DAILY} SELECT retailer_code, CAST(date_trunc('month', observed_date) AS DATE) AS month_start, round(sum(CAST(price_qepik AS BIGINT) * n_stores) / nullif(sum(n_stores), 0), 4) AS weighted_price, sum(n_stores) AS weight
      FROM daily WHERE price_qepik IS NOT NULL AND n_stores IS NOT NULL GROUP BY 1, 2""",
    "top_movers": f"""WITH {DAILY}, r AS (SELECT store_item_id, price_point_key, CAST(arg_min(price_qepik, observed_date) AS BIGINT) AS price_ago, CAST(arg_max(price_qepik, observed_date) AS BIGINT) AS price_now FROM daily
      WHERE price_qepik > 0 AND observed_date > (SELECT max(observed_date) FROM daily WHERE price_qepik > 0) - 30 GROUP BY 1, 2)
      SELECT *, {BP.format(n='((price_now - price_ago) * 10000)', d='price_ago')} AS change_bp FROM r WHERE price_now <> price_ago AND change_bp <> 0 ORDER BY abs(change_bp) DESC, store_item_id, price_point_key LIMIT 20""",
    "dim_store": f"WITH {STORES} SELECT * FROM stores",
    "dim_retailer": f"WITH {STORES} SELECT code, name, price_model, (SELECT count(*) FROM stores WHERE retailer_code = code) AS stores FROM retailer",
    "zone_choice": f"""WITH {STORES}, z AS (SELECT s.retailer_code, s.price_zone, count(*) AS n FROM stores s JOIN retailer r ON r.code = s.retailer_code AND r.price_model = 'zoned' WHERE s.price_zone IS NOT NULL GROUP BY 1, 2),
      c AS (SELECT retailer_code, price_zone AS zone FROM z QUALIFY row_number() OVER (PARTITION BY retailer_code ORDER BY n DESC, price_zone) = 1)
      SELECT c.retailer_code, c.zone, coalesce(string_agg(z.price_zone, ',' ORDER BY z.price_zone) FILTER (WHERE z.price_zone <> c.zone), '') AS excluded, count(*) > 1 AS requires_zone_choice FROM c JOIN z USING (retailer_code) GROUP BY 1, 2""",
    "review_queue": f"WITH {REVIEW} SELECT * FROM queue",
    "registry_members": f"""WITH {DECIDED} SELECT product_id, count(*) AS listings, string_agg(DISTINCT retailer_code, ',' ORDER BY retailer_code) AS retailers, arg_min(id, (first_seen, id)) AS representative FROM decided JOIN store_item ON id = store_item_id GROUP BY 1""",
    "record_lineage": "SELECT r.batch_id, row_num, record_hash, landing_path, file_sha256, status FROM raw_record r LEFT JOIN ingest_batch b USING (batch_id)",
    "pending_batches": "SELECT batch_id, source, kind, business_date FROM ingest_batch WHERE status = 'ingested'",
    "event_props": "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
    "price_gap": f"""WITH {DAILY}, {DECIDED}, {CURRENT}, o AS (SELECT product_id, retailer_code, CAST(min(price_qepik) AS BIGINT) AS price_qepik FROM cur WHERE price_qepik IS NOT NULL GROUP BY 1, 2),
      s AS (SELECT *, min(price_qepik) OVER (PARTITION BY product_id) AS low, max(price_qepik) OVER (PARTITION BY product_id) AS high, count(*) OVER (PARTITION BY product_id) AS retailers FROM o)
      SELECT product_id, retailer_code, price_qepik, retailers, CAST(round_even((price_qepik - low) * CAST(10000 AS DOUBLE) / nullif(low, 0), 0) AS BIGINT) AS premium_bp, CAST(floor((high - price_qepik) * CAST(10000 AS DOUBLE) / nullif(high, 0)) AS BIGINT) AS gap_bp FROM s WHERE retailers > 1""",
    "gtin_numbers": """SELECT id, concat(b, (10 - list_sum(list_transform(range(1, 13), lambda i: CAST(b[i] AS INTEGER) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10) AS code, true AS is_valid
      FROM (SELECT id, lpad(CAST(200000000000 + id AS VARCHAR), 12, '0') AS b FROM product)""",
    "product_page": "SELECT id, name, count(*) OVER () AS total FROM product WHERE lower(name) LIKE '%yumurta%' ORDER BY name, id LIMIT 20 OFFSET 5",
    "quarantine_reasons": f"""WITH {DAILY}, {DECIDED}, held AS (SELECT * FROM decided JOIN store_item ON id = store_item_id), t AS (SELECT store_item_id, quantile_cont(price_qepik, 0.5) AS p FROM daily
        WHERE observed_date > (SELECT max(observed_date) FROM daily) - 7 AND old_price_qepik IS NULL GROUP BY 1),
      r AS (SELECT product_id, 'size_conflict' AS reason FROM held WHERE coalesce(unit_type, '') <> 'kg_bulk' GROUP BY 1 HAVING count(DISTINCT struct_pack(a := unit_type, b := coalesce(unit_value, 0), c := coalesce(pack, 0))) > 1
        UNION ALL SELECT product_id, 'ean_conflict' FROM held WHERE ean_kind = 'global' GROUP BY 1 HAVING count(DISTINCT ean) > 1
        UNION ALL SELECT product_id, 'price_spread' FROM decided JOIN t USING (store_item_id) GROUP BY 1 HAVING count(*) > 1 AND max(p) * 100 > min(p) * 300)
      SELECT product_id, string_agg(reason, ',' ORDER BY reason) AS reasons FROM r GROUP BY 1""",
    "feed_checks": f"""WITH {DAILY}, {REVIEW} SELECT 'stuck_batches' AS check_name, 'all' AS subject, CAST(count(*) FILTER (WHERE status IN ('ingested', 'failed')) AS DOUBLE) AS value FROM ingest_batch
      UNION ALL SELECT 'rejected_batch_share', source, round(avg(CAST(status = 'rejected' AS DOUBLE)), 6) FROM ingest_batch GROUP BY 2
      UNION ALL SELECT 'median_price', retailer_code, quantile_cont(price_qepik, 0.5) FROM daily WHERE observed_date = (SELECT max(observed_date) FROM daily) GROUP BY 2
      UNION ALL SELECT 'unmapped_categories', 'all', count(*) FILTER (WHERE category = 'Uncategorized') FROM store_item
      UNION ALL SELECT 'unit_coverage', 'all', round(avg(CAST(unit_type IS NOT NULL AS DOUBLE)), 6) FROM store_item
      UNION ALL SELECT 'review_backlog', 'all', count(*) FROM queue
      UNION ALL SELECT 'quarantine_share', 'all', round(avg(CAST(coalesce(quarantined, false) AS DOUBLE)), 6) FROM product""",
    "batch_counts": """SELECT batch_id, n, CASE WHEN n = 0 THEN 'empty_batch' WHEN row_count IS NULL THEN 'no_count' WHEN row_count <> n THEN 'count_differs' END AS gate
      FROM (SELECT b.batch_id, b.row_count, (SELECT count(*) FROM raw_record r WHERE r.batch_id = b.batch_id) AS n FROM ingest_batch b)""",
    "model_tests": """SELECT 'store_item_id_unique' AS test, count(*) AS failures FROM (SELECT 1 FROM store_item GROUP BY id HAVING count(*) > 1)
      UNION ALL SELECT 'store_item_sku_unique', count(*) FROM (SELECT 1 FROM store_item GROUP BY retailer_code, sku HAVING count(*) > 1)
      UNION ALL SELECT 'product_id_unique', count(*) FROM (SELECT 1 FROM product GROUP BY id HAVING count(*) > 1)
      UNION ALL SELECT 'record_unique', count(*) FROM (SELECT 1 FROM raw_record GROUP BY batch_id, row_num HAVING count(*) > 1)
      UNION ALL SELECT 'fact_item_known', count(*) FROM fct_price_daily f WHERE store_item_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM store_item i WHERE i.id = f.store_item_id)
      UNION ALL SELECT 'fact_retailer_known', count(*) FROM fct_price_daily f WHERE retailer_code IS NOT NULL AND NOT EXISTS (SELECT 1 FROM retailer r WHERE r.code = f.retailer_code)
      UNION ALL SELECT 'record_batch_known', count(*) FROM raw_record r WHERE batch_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ingest_batch b WHERE b.batch_id = r.batch_id)
      UNION ALL SELECT 'fact_price_stated', count(*) FROM fct_price_daily WHERE price_qepik IS NULL
      UNION ALL SELECT 'batch_status_known', count(*) FROM ingest_batch WHERE status NOT IN ('ingested', 'silver_done', 'rejected', 'failed')""",
}

_UNITS = "fl\\.?\\s*oz|(?:k|к|m|м|c|s|с|d|д)?(?:g|gr|gram|gramm|q|qr|qram|г|гр|грамм|l|lt|ltr|litr|л|лт|литр)|oz|lb|lbs|funt|фунт|pcs|pc|əd|ədəd|ed|eded|ad|adad|шт|şt|st|pk|lu|lü|lı|li|luq|lıq"
# a Latin letter of a unit may be written as the Cyrillic one that looks like it
_UNITS = _UNITS.translate({ord(a): f"[{a}{b}]" for a, b in zip("aeopcykmtg", "аеорсукмтг")})
_NUM = "[0-9]+(?:[.,][0-9]+)?"
_STOPS = "kq kg qr gr q g ml l lt eded ed adet st caki ceki cheki paket qutuda qutu setka tnk tk bag ile ve v i na dan den uchun ucun super lyuks luks yeni new aksiya endirim mehsul mehsullar no n x sm cm mm de da"
ORACLES["fingerprint_blocks"] = f"""WITH bare AS (SELECT id, name_raw, regexp_replace(regexp_replace(regexp_replace(translate(coalesce(name_raw, ''), concat('İI', chr(160)), 'ii '), '(^|[^\\pL\\pN_.,])[0-9]+\\s*[xх*×]\\s*{_NUM}\\s*(?:{_UNITS})([^\\pL]|$)', '\\1 \\2', 'gi'),
    '(^|[^\\pL\\pN_.,]){_NUM}\\s*-?\\s*(?:{_UNITS})([^\\pL]|$)', '\\1 \\2', 'gi'), '{_NUM}\\s*%', ' ', 'g') AS t FROM store_item),
  found AS (SELECT id, name_raw, regexp_extract_all(lower(translate(t, 'ƏəIıİÖöÜüÇçŞşĞğаеоcсрхукмтвн', 'aaiiioouuccssggaeoccpxykmtvn')), '[a-z0-9]+') AS w FROM bare),
  parts AS (SELECT id, name_raw, list_filter(w, lambda x: length(x) > 1 AND NOT regexp_full_match(x, '[0-9]+') AND NOT list_contains(string_split('{_STOPS}', ' '), x)) AS words, list_sort(list_filter(w, lambda x: regexp_full_match(x, '[0-9]+'))) AS numbers FROM found),
  keys AS (SELECT *, list_sort(list_distinct(words)) AS d FROM parts)
  SELECT id, CASE WHEN len(words) >= 2 THEN array_to_string(d, ' ') END AS fingerprint,
    CASE WHEN len(words) >= 2 THEN concat(array_to_string(list_filter(d, lambda x: len(list_filter(d, lambda o: o <> x AND contains(o, x))) = 0), ''), '|', array_to_string(numbers, ' ')) END AS loose,
    CASE WHEN regexp_matches(name_raw, '[0-9]{{1,2}}(?:[.,][0-9])?\\s*%') THEN format('{{:.1f}}', CAST(replace(regexp_extract(name_raw, '([0-9]{{1,2}}(?:[.,][0-9])?)\\s*%', 1), ',', '.') AS DOUBLE)) END AS fat FROM keys"""
