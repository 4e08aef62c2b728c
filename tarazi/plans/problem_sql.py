"""Oracle SQL of the pN queries that SQL can express."""

_VERSIONS = """
WITH picked AS (
  SELECT 'store' AS entity, store_key AS entity_id, snapshot_date AS day,
         max_by(struct_pack(v := CASE WHEN trim(price_zone) <> '' THEN upper(trim(price_zone)) END), struct_pack(a := loaded_at, b := coalesce(upper(trim(price_zone)), ''))).v AS payload
  FROM store_snap GROUP BY ALL
  UNION ALL
  SELECT 'store_item', store_item_id, snapshot_date,
         max_by(struct_pack(v := CAST(product_id AS VARCHAR)), struct_pack(a := loaded_at, b := coalesce(product_id, -1))).v
  FROM product_match_snap GROUP BY ALL
), stated AS (SELECT entity, entity_id, day, payload, lag(payload) OVER w AS before FROM picked WHERE payload IS NOT NULL WINDOW w AS (PARTITION BY entity, entity_id ORDER BY day)),
numbered AS (SELECT *, sum(CASE WHEN before IS DISTINCT FROM payload THEN 1 ELSE 0 END) OVER (PARTITION BY entity, entity_id ORDER BY day) AS version FROM stated),
runs AS (SELECT entity, entity_id, version, any_value(payload) AS payload, min(day) AS valid_from, max(day) AS last_seen FROM numbered GROUP BY ALL)
SELECT entity, entity_id, payload, valid_from, lead(valid_from) OVER (PARTITION BY entity, entity_id ORDER BY version) AS valid_to, last_seen FROM runs
"""

_ROLLING = """
WITH daily AS (
  SELECT store_item_id, price_point_key, observed_date AS day, (max_by(struct_pack(p := price_qepik, r := regular_price_qepik),
         struct_pack(t := observed_at, p := coalesce(price_qepik, -2147483648), r := coalesce(regular_price_qepik, -2147483648)))) AS v
  FROM fct_price_daily WHERE observed_date IS NOT NULL GROUP BY ALL
), span AS (SELECT store_item_id, price_point_key, min(day) AS lo, max(day) AS hi FROM daily GROUP BY ALL),
calendar AS (SELECT store_item_id, price_point_key, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS obs_day FROM span),
filled AS (SELECT c.*, v.p AS p, v.r AS r FROM calendar c LEFT JOIN daily d ON d.store_item_id = c.store_item_id AND d.price_point_key = c.price_point_key AND d.day = c.obs_day)
SELECT store_item_id, price_point_key, obs_day,
  CAST(sum(p) OVER w7 AS BIGINT) AS price_qepik_total_7, count(p) OVER w7 AS price_qepik_days_7, CAST(sum(p) OVER w7 AS DOUBLE) / nullif(count(p) OVER w7, 0) AS price_qepik_avg_7,
  CAST(sum(p) OVER w30 AS BIGINT) AS price_qepik_total_30, count(p) OVER w30 AS price_qepik_days_30, CAST(sum(p) OVER w30 AS DOUBLE) / nullif(count(p) OVER w30, 0) AS price_qepik_avg_30,
  CAST(sum(r) OVER w7 AS BIGINT) AS regular_price_qepik_total_7, count(r) OVER w7 AS regular_price_qepik_days_7, CAST(sum(r) OVER w7 AS DOUBLE) / nullif(count(r) OVER w7, 0) AS regular_price_qepik_avg_7,
  CAST(sum(r) OVER w30 AS BIGINT) AS regular_price_qepik_total_30, count(r) OVER w30 AS regular_price_qepik_days_30, CAST(sum(r) OVER w30 AS DOUBLE) / nullif(count(r) OVER w30, 0) AS regular_price_qepik_avg_30
FROM filled
WINDOW w7 AS (PARTITION BY store_item_id, price_point_key ORDER BY obs_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY store_item_id, price_point_key ORDER BY obs_day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
"""

ORACLES = {
    "p3_versions": _VERSIONS,
    "p3_found": f"SELECT entity, entity_id, strftime(valid_from, '%Y-%m-%d') AS valid_from FROM ({_VERSIONS})",
    "p4_rolling": _ROLLING,
    "p4_found": f"""SELECT store_item_id, price_point_key, strftime(obs_day, '%Y-%m-%d') AS obs_day FROM ({_ROLLING})
        WHERE price_qepik_days_7 > 0 AND regular_price_qepik_days_30 > 0
          AND price_qepik_total_7::HUGEINT * regular_price_qepik_days_30 * 100 < regular_price_qepik_total_30::HUGEINT * price_qepik_days_7 * 85""",
}
