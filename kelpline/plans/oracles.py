"""The same models in DuckDB SQL, each a common table expression that may use those before it."""

from __future__ import annotations

import re

from kelpline.functions.columns import KEY_NAMESPACE, UNIT, UNKNOWN, UNKNOWN_NAMESPACE
from kelpline.plans.gold import RENAMED, SEMANTIC
from kelpline.sources.commerce import LOADED, RELEASE


def key(kind: str, *parts: str) -> str:
    return " || chr(0) || ".join([f"sha256('{KEY_NAMESPACE}'", f"'{kind}'", *parts]) + ")"


def unknown(kind: str) -> str:
    return f"sha256('{UNKNOWN_NAMESPACE}' || chr(0) || '{kind}')"


def _lineage(body: str, columns: list[str], row: str = "0", day: str = "0") -> str:
    value = lambda c: f"strftime({c[1:]}, '%Y-%m-%d %H:%M:%S')" if c[0] == "@" else f"{c}::VARCHAR"
    text = lambda c: f"coalesce(strlen({value(c)})::VARCHAR || ':' || {value(c)}, '-')"
    return f"SELECT *, sha256({' || '.join(map(text, columns))}) AS record_hash, ({row})::BIGINT AS source_row_number, TIMESTAMP '{LOADED}' + to_days(({day})::INT) AS ingested_at FROM ({body})"


def _latest(src: str, keys: str) -> str:
    return f"SELECT * EXCLUDE rk FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ingested_at DESC, source_row_number DESC, record_hash DESC) AS rk FROM {src}) WHERE rk = 1"


_up = lambda c: f"coalesce(nullif(upper(trim({c})), ''), 'UNKNOWN')"
_zip = lambda c: f"lpad(trim({c}), 5, '0')"
_dk = lambda c: f"strftime({c}, '%Y%m%d')::BIGINT"
_ratio = lambda a, b: f"round(({a})::DOUBLE / nullif({b}, 0), 6)"
_eligible = "(order_status = 'delivered' AND delivery_interval_valid AND delivery_lead_seconds IS NOT NULL AND delivery_delay_seconds IS NOT NULL AND is_on_time_delivery IS NOT NULL)"
_rn = "(SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
_status = "lower(trim(order_status))"
_history = "TIMESTAMP '1900-01-01' AS effective_from, NULL::TIMESTAMP AS effective_to, true AS is_current"
_month = "JOIN fact_order USING (order_key) JOIN (SELECT date_key AS purchase_date_key, month_start_date AS period_month FROM dim_date) USING (purchase_date_key)"


def _reviews(k: str) -> str:
    return f"(SELECT period_month, {k}, sum(weight_units::DECIMAL(28,0)) AS wu, sum(score_units::DECIMAL(28,0)) AS su FROM bridge_review_item {_month} GROUP BY ALL)"


CTES: dict[str, str] = {
    "b_customers": _lineage(f"SELECT c_custkey::VARCHAR AS customer_id, (c_custkey % 1000)::VARCHAR AS customer_unique_id, c_nationkey::VARCHAR AS customer_zip_code_prefix, ' ' || lower(n_name) AS customer_city, r_name AS customer_state FROM customer JOIN {_rn} ON c_nationkey = n_nationkey", ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
    "b_geolocation": f"""SELECT n_nationkey::VARCHAR AS geolocation_zip_code_prefix, (n_nationkey * 4 - 45 + CASE WHEN i = 3 AND n_nationkey % 5 = 0 THEN 1000 ELSE i END)::DECIMAL(18,2) AS geolocation_lat,
  (n_nationkey * 7 - 80 + i * 2 + CASE WHEN n_nationkey = 7 THEN 5000 ELSE 0 END)::DECIMAL(18,2) AS geolocation_lng, CASE WHEN i = 2 AND n_nationkey % 3 = 0 THEN n_name || ' old' ELSE n_name END AS geolocation_city, r_name AS geolocation_state
  FROM {_rn}, range(0, 4) t(i)""",
    "b_orders": _lineage("""SELECT o_orderkey::VARCHAR AS order_id, CASE WHEN o_orderkey % 97 = 0 THEN 'gone-' || o_custkey ELSE o_custkey::VARCHAR END AS customer_id,
  CASE WHEN o_orderkey % 101 = 0 THEN 'lost' WHEN o_orderstatus = 'F' THEN ' Delivered' WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'canceled' END AS order_status, o_orderdate AS order_purchase_timestamp,
  o_orderdate + INTERVAL 1 HOUR AS order_approved_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 2500 DAY END AS order_delivered_carrier_date, CASE WHEN o_orderstatus = 'F' THEN shipped END AS order_delivered_customer_date, o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""", ["order_id", "customer_id", "order_status", "@order_purchase_timestamp", "@order_approved_at", "@order_delivered_carrier_date", "@order_delivered_customer_date", "@order_estimated_delivery_date"]),
    "b_items": _lineage("""SELECT l_orderkey::VARCHAR AS order_id, l_linenumber::BIGINT AS order_item_id, l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id, l_shipdate AS shipping_limit_date,
  CASE WHEN l_partkey % 211 = 0 THEN 0::DECIMAL(18,2) ELSE l_extendedprice::DECIMAL(18,2) END AS price, l_tax::DECIMAL(18,2) AS freight_value FROM lineitem""", ["order_id", "order_item_id", "product_id", "seller_id", "@shipping_limit_date", "price", "freight_value"], "length(product_id)", "length(seller_id)"),
    "b_payments": _lineage("""SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'gone-' || o_orderkey ELSE o_orderkey::VARCHAR END AS order_id, 1::BIGINT AS payment_sequential,
  (['credit_card', ' Boleto', 'VOUCHER ', 'debit_card'])[o_orderkey % 4 + 1] AS payment_type, CASE WHEN o_orderkey % 107 = 0 THEN -1 ELSE o_orderkey % 10 + 1 END AS payment_installments, CASE WHEN o_orderkey % 103 = 0 THEN -o_totalprice::DECIMAL(18,2) ELSE o_totalprice::DECIMAL(18,2) END AS payment_value FROM orders""", ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]),
    "b_reviews": _lineage("""SELECT 'r' || o_orderkey AS review_id, CASE WHEN o_orderkey % 83 = 0 THEN 'gone-' || o_orderkey ELSE o_orderkey::VARCHAR END AS order_id, o_orderkey % 5 + 1 AS review_score,
  CASE WHEN o_orderkey % 7 = 0 THEN ' good ' END AS review_comment_title, text AS review_comment_message, o_orderdate + INTERVAL 61 DAY AS review_creation_date,
  o_orderdate + INTERVAL 60 DAY + to_days((o_orderkey % 9)::INT) AS review_answer_timestamp FROM orders LEFT JOIN documents ON doc_id = o_orderkey""", ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "@review_creation_date", "@review_answer_timestamp"]),
    "b_products": _lineage("SELECT p_partkey::VARCHAR AS product_id, CASE WHEN p_size % 10 = 0 THEN NULL ELSE upper(p_type) END AS product_category_name, length(p_name)::BIGINT AS product_name_lenght, length(p_type)::BIGINT AS product_description_lenght, p_size::BIGINT AS product_photos_qty, p_retailprice::DECIMAL(18,2) AS product_weight_g, (p_size * 2)::DECIMAL(18,2) AS product_length_cm, (p_size * 3)::DECIMAL(18,2) AS product_height_cm, (p_size * 4)::DECIMAL(18,2) AS product_width_cm FROM part", ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]),
    "b_translation": _lineage("SELECT DISTINCT upper(p_type) AS product_category_name, 'en ' || lower(p_type) AS product_category_name_english FROM part WHERE NOT contains(upper(p_type), 'A')", ["product_category_name", "product_category_name_english"]),
    "b_sellers": _lineage(f"SELECT s_suppkey::VARCHAR AS seller_id, (s_nationkey + CASE WHEN s_suppkey % 20 = 0 THEN 90000 ELSE 0 END)::VARCHAR AS seller_zip_code_prefix, ' ' || lower(n_name) AS seller_city, r_name AS seller_state FROM supplier JOIN {_rn} ON s_nationkey = n_nationkey", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    "sil_category_translation": f"SELECT product_category_name, {_up('product_category_name_english')} AS product_category_name_english FROM ({_latest('(SELECT * REPLACE (lower(trim(product_category_name)) AS product_category_name) FROM b_translation)', 'product_category_name')})",
    "sil_customer": f"SELECT customer_id, sha256('{KEY_NAMESPACE}' || chr(0) || 'REPEAT' || chr(0) || trim(customer_unique_id)) AS repeat_customer_key, {_zip('customer_zip_code_prefix')} AS customer_zip_prefix, {_up('customer_city')} AS customer_city, {_up('customer_state')} AS customer_state, record_hash FROM ({_latest('b_customers', 'customer_id')})",
    "sil_geolocation_zip": f"""SELECT *, CASE WHEN valid_coordinate_count = 0 THEN 'NO_VALID_COORDINATE' WHEN distinct_city_count > 1 OR distinct_state_count > 1 THEN 'AMBIGUOUS_LOCATION' WHEN invalid_coordinate_count > 0 THEN 'PARTIAL_COORDINATE' ELSE 'VALID' END AS geolocation_quality_status FROM (
  SELECT {_zip('geolocation_zip_code_prefix')} AS geolocation_zip_prefix, round(sum(geolocation_lat) FILTER (ok)::DOUBLE / nullif(count(*) FILTER (ok), 0), 6) AS centroid_latitude, round(sum(geolocation_lng) FILTER (ok)::DOUBLE / nullif(count(*) FILTER (ok), 0), 6) AS centroid_longitude,
  count(*) AS source_point_count, count(*) FILTER (ok) AS valid_coordinate_count, count(*) FILTER (NOT ok) AS invalid_coordinate_count, min(city) AS representative_city, min(state) AS representative_state, count(DISTINCT city) AS distinct_city_count, count(DISTINCT state) AS distinct_state_count
  FROM (SELECT *, geolocation_lat BETWEEN -90 AND 90 AND geolocation_lng BETWEEN -180 AND 180 AS ok, {_up('geolocation_city')} AS city, {_up('geolocation_state')} AS state FROM b_geolocation) GROUP BY 1)""",
    "sil_order": f"""SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, customer_exists, valid_item_count, delivery_interval_valid,
  CASE WHEN order_status = 'delivered' AND customer_exists AND valid_item_count > 0 THEN 'IN_SCOPE' WHEN order_status = 'delivered' THEN 'QUARANTINED' WHEN order_status IN ('canceled', 'unavailable', 'approved', 'created', 'invoiced', 'processing', 'shipped') THEN 'OUT_OF_SCOPE_DELIVERY' ELSE 'UNKNOWN' END AS analysis_scope_status,
  CASE WHEN order_status = 'delivered' AND NOT customer_exists THEN 'MISSING_CUSTOMER' WHEN order_status = 'delivered' AND valid_item_count = 0 THEN 'MISSING_ORDER_ITEM' WHEN order_status = 'delivered' THEN 'ELIGIBLE_DELIVERED' WHEN order_status IN ('canceled', 'unavailable') THEN 'TERMINAL_NON_DELIVERY'
    WHEN order_status IN ('approved', 'created', 'invoiced', 'processing', 'shipped') THEN 'NOT_DELIVERED' ELSE 'UNRECOGNIZED_STATUS' END AS analysis_scope_reason,
  CASE WHEN delivery_interval_valid THEN datesub('second', order_purchase_timestamp, order_delivered_customer_date) END AS delivery_lead_seconds, CASE WHEN delivery_interval_valid THEN datesub('second', order_estimated_delivery_date, order_delivered_customer_date) END AS delivery_delay_seconds,
  CASE WHEN delivery_interval_valid THEN order_delivered_customer_date <= order_estimated_delivery_date END AS is_on_time_delivery, record_hash
  FROM (SELECT o.* REPLACE ({_status} AS order_status), c.customer_id IS NOT NULL AS customer_exists, coalesce(n, 0) AS valid_item_count, order_delivered_customer_date IS NOT NULL AND order_delivered_customer_date >= order_purchase_timestamp AS delivery_interval_valid
    FROM ({_latest('b_orders', 'order_id')}) o LEFT JOIN (SELECT DISTINCT customer_id FROM b_customers) c ON o.customer_id = c.customer_id LEFT JOIN (SELECT order_id, count(*) AS n FROM b_items GROUP BY 1) i ON o.order_id = i.order_id)""",
    "sil_order_item": f"""SELECT i.order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value, price + freight_value AS item_total_value, p.order_id IS NOT NULL AS order_parent_exists,
  CASE WHEN p.order_id IS NULL THEN 'ORPHAN_ORDER' WHEN price <= 0 THEN 'INVALID_PRICE' WHEN freight_value < 0 THEN 'INVALID_FREIGHT' ELSE 'VALID' END AS amount_quality_status FROM ({_latest('b_items', 'order_id, order_item_id')}) i LEFT JOIN sil_order p ON i.order_id = p.order_id""",
    "sil_order_payment": f"""SELECT i.order_id, payment_sequential, lower(trim(payment_type)) AS payment_type, payment_installments, payment_value, p.order_id IS NOT NULL AS order_parent_exists,
  CASE WHEN p.order_id IS NULL THEN 'ORPHAN_ORDER' WHEN payment_value < 0 THEN 'INVALID_PAYMENT_VALUE' WHEN payment_installments < 0 THEN 'INVALID_INSTALLMENTS' ELSE 'VALID' END AS amount_quality_status FROM ({_latest('b_payments', 'order_id, payment_sequential')}) i LEFT JOIN sil_order p ON i.order_id = p.order_id""",
    "sil_order_review": f"""SELECT review_id, order_id, review_score, review_creation_date, review_answer_timestamp, order_parent_exists, review_text_length > 0 AS review_text_present, review_text_length, response_interval_valid,
  CASE WHEN response_interval_valid THEN datesub('second', review_creation_date, review_answer_timestamp) END AS response_latency_seconds,
  CASE WHEN NOT response_interval_valid THEN 'INVALID_RESPONSE_INTERVAL' WHEN NOT order_parent_exists THEN 'ORPHAN_ORDER' WHEN analysis_scope_status <> 'IN_SCOPE' THEN 'OUT_OF_SCOPE_ORDER' WHEN review_text_length = 0 THEN 'SCORE_ONLY' ELSE 'PENDING_DLP' END AS ai_eligibility_status
  FROM (SELECT r.*, p.order_id IS NOT NULL AS order_parent_exists, analysis_scope_status, length(trim(coalesce(review_comment_title, ''), ' ')) + length(trim(coalesce(review_comment_message, ''), ' ')) AS review_text_length, review_answer_timestamp >= review_creation_date AS response_interval_valid
    FROM ({_latest('b_reviews', 'review_id, order_id')}) r LEFT JOIN sil_order p ON r.order_id = p.order_id)""",
    "sil_product": f"""SELECT product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name, coalesce(product_category_name_english, 'UNKNOWN') AS product_category_name_english, t.product_category_name IS NOT NULL AS category_translation_exists,
  product_name_lenght AS product_name_length, product_description_lenght AS product_description_length, product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm, CASE WHEN p.product_category_name IS NULL THEN 'UNKNOWN_CATEGORY' WHEN t.product_category_name IS NULL THEN 'UNTRANSLATED_CATEGORY' ELSE 'VALID' END AS product_quality_status, record_hash
  FROM ({_latest('(SELECT * REPLACE (lower(trim(product_category_name)) AS product_category_name) FROM b_products)', 'product_id')}) p LEFT JOIN sil_category_translation t ON p.product_category_name = t.product_category_name""",
    "sil_seller": f"""SELECT seller_id, seller_zip_prefix, {_up('seller_city')} AS seller_city, {_up('seller_state')} AS seller_state, g.geolocation_zip_prefix IS NOT NULL AS geolocation_zip_exists, coalesce(geolocation_quality_status, 'ZIP_NOT_FOUND') AS geolocation_quality_status, record_hash
  FROM (SELECT *, {_zip('seller_zip_code_prefix')} AS seller_zip_prefix FROM ({_latest('b_sellers', 'seller_id')})) s LEFT JOIN sil_geolocation_zip g ON seller_zip_prefix = geolocation_zip_prefix""",
    "sil_unknown_member": " UNION ALL ".join(f"SELECT '{k}' AS entity_type, {unknown(k)} AS unknown_member_key" for k in ("CUSTOMER", "PRODUCT", "SELLER", "GEOGRAPHY")),
    "sil_dq_quarantine": "SELECT *, sha256(concat_ws(':', model, grain_hash, code)) AS dq_event_id FROM (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, sha256({grain}) AS grain_hash, {code} AS code, {sev} AS severity FROM sil_{m} WHERE {where}"
        for m, grain, code, sev, where in [
            ("order", "order_id", "analysis_scope_reason", "CASE WHEN analysis_scope_status = 'QUARANTINED' THEN 'CRITICAL' ELSE 'QUARANTINE' END", "analysis_scope_status IN ('QUARANTINED', 'UNKNOWN')"),
            ("geolocation_zip", "geolocation_zip_prefix", "geolocation_quality_status", "'WARN'", "geolocation_quality_status <> 'VALID'"),
            ("order_item", "concat_ws(':', order_id, order_item_id::VARCHAR)", "amount_quality_status", "CASE WHEN amount_quality_status = 'ORPHAN_ORDER' THEN 'CRITICAL' ELSE 'QUARANTINE' END", "amount_quality_status <> 'VALID'"),
            ("order_payment", "concat_ws(':', order_id, payment_sequential::VARCHAR)", "amount_quality_status", "CASE WHEN amount_quality_status = 'ORPHAN_ORDER' THEN 'CRITICAL' ELSE 'QUARANTINE' END", "amount_quality_status <> 'VALID'"),
            ("product", "product_id", "product_quality_status", "'WARN'", "product_quality_status <> 'VALID'"),
            ("seller", "seller_id", "CASE WHEN NOT geolocation_zip_exists THEN 'ZIP_NOT_FOUND' ELSE geolocation_quality_status END", "'WARN'", "NOT geolocation_zip_exists OR geolocation_quality_status <> 'VALID'"),
            ("order_review", "concat_ws(':', review_id, order_id)", "ai_eligibility_status", "CASE WHEN ai_eligibility_status = 'ORPHAN_ORDER' THEN 'CRITICAL' ELSE 'QUARANTINE' END", "ai_eligibility_status IN ('ORPHAN_ORDER', 'INVALID_RESPONSE_INTERVAL')"),
        ]) + ")",
    "dim_date": f"""SELECT {_dk('full_date')} AS date_key, full_date, year(full_date) AS calendar_year, quarter(full_date) AS calendar_quarter, month(full_date) AS calendar_month, strftime(full_date, '%b') AS month_name, week(full_date) AS iso_week, day(full_date) AS day_of_month,
  isodow(full_date) AS iso_day_of_week, strftime(full_date, '%a') AS day_name, date_trunc('week', full_date)::DATE AS week_start_date, date_trunc('month', full_date)::DATE AS month_start_date, date_trunc('quarter', full_date)::DATE AS quarter_start_date FROM (
  SELECT order_purchase_timestamp::DATE AS full_date FROM sil_order UNION SELECT order_approved_at::DATE FROM sil_order UNION SELECT order_delivered_carrier_date::DATE FROM sil_order UNION SELECT order_delivered_customer_date::DATE FROM sil_order UNION SELECT order_estimated_delivery_date::DATE FROM sil_order
  UNION SELECT shipping_limit_date::DATE FROM sil_order_item UNION SELECT review_creation_date::DATE FROM sil_order_review UNION SELECT review_answer_timestamp::DATE FROM sil_order_review UNION SELECT DATE '1900-01-01') WHERE full_date IS NOT NULL""",
    "dim_geography": f"""SELECT *, {_history} FROM (SELECT {key('GEOGRAPHY', 'geolocation_zip_prefix')} AS geography_key, geolocation_zip_prefix, representative_city AS city, representative_state AS state, centroid_latitude, centroid_longitude, geolocation_quality_status FROM sil_geolocation_zip
  UNION ALL SELECT {unknown('GEOGRAPHY')}, '{UNKNOWN}', 'UNKNOWN', 'UNKNOWN', NULL, NULL, 'UNKNOWN')""",
    "dim_customer": f"""SELECT *, {_history} FROM (SELECT {key('CUSTOMER', 'customer_id', 'record_hash')} AS customer_key, customer_id, repeat_customer_key, coalesce(geography_key, {unknown('GEOGRAPHY')}) AS geography_key, customer_zip_prefix, customer_city, customer_state
  FROM sil_customer LEFT JOIN dim_geography ON customer_zip_prefix = geolocation_zip_prefix AND is_current UNION ALL SELECT {unknown('CUSTOMER')}, '{UNKNOWN}', {unknown('CUSTOMER')}, {unknown('GEOGRAPHY')}, '{UNKNOWN}', 'UNKNOWN', 'UNKNOWN')""",
    "dim_product": f"""SELECT *, {_history} FROM (SELECT {key('PRODUCT', 'product_id', 'record_hash')} AS product_key, product_id, product_category_name, product_category_name_english, product_quality_status FROM sil_product
  UNION ALL SELECT {unknown('PRODUCT')}, '{UNKNOWN}', 'unknown', 'UNKNOWN', 'UNKNOWN')""",
    "dim_seller": f"""SELECT *, {_history} FROM (SELECT {key('SELLER', 'seller_id', 'record_hash')} AS seller_key, seller_id, coalesce(geography_key, {unknown('GEOGRAPHY')}) AS geography_key, seller_zip_prefix, seller_city, seller_state
  FROM sil_seller LEFT JOIN dim_geography ON seller_zip_prefix = geolocation_zip_prefix AND is_current UNION ALL SELECT {unknown('SELLER')}, '{UNKNOWN}', {unknown('GEOGRAPHY')}, '{UNKNOWN}', 'UNKNOWN', 'UNKNOWN')""",
    "fact_order": f"""SELECT {key('ORDER', 'order_id')} AS order_key, order_id, coalesce(customer_key, {unknown('CUSTOMER')}) AS customer_key, {_dk('order_purchase_timestamp')} AS purchase_date_key, {_dk('order_delivered_customer_date')} AS delivered_date_key, {_dk('order_estimated_delivery_date')} AS estimated_delivery_date_key,
  order_status, analysis_scope_status, analysis_scope_reason, order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date, delivery_interval_valid, delivery_lead_seconds, delivery_delay_seconds, is_on_time_delivery, 1::BIGINT AS order_count, record_hash
  FROM sil_order o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id AND order_purchase_timestamp >= effective_from AND order_purchase_timestamp < coalesce(effective_to, TIMESTAMP '9999-12-31') WHERE analysis_scope_status <> 'QUARANTINED'""",
    "fact_order_item": f"""SELECT {key('ORDER_ITEM', "concat_ws(':', order_id, order_item_id::VARCHAR)")} AS order_item_key, order_key, order_id, order_item_id, coalesce(product_key, {unknown('PRODUCT')}) AS product_key, coalesce(seller_key, {unknown('SELLER')}) AS seller_key, {_dk('shipping_limit_date')} AS shipping_limit_date_key,
  price, freight_value, item_total_value, 1::BIGINT AS item_count FROM sil_order_item i JOIN (SELECT order_id, order_key, order_purchase_timestamp AS bought FROM fact_order) USING (order_id)
  LEFT JOIN (SELECT product_id, product_key, effective_from AS pf, effective_to AS pt FROM dim_product) p ON i.product_id = p.product_id AND bought >= pf AND bought < coalesce(pt, TIMESTAMP '9999-12-31') LEFT JOIN (SELECT seller_id, seller_key, effective_from AS sf, effective_to AS st FROM dim_seller) s ON i.seller_id = s.seller_id AND bought >= sf AND bought < coalesce(st, TIMESTAMP '9999-12-31') WHERE order_parent_exists AND amount_quality_status = 'VALID'""",
    "fact_payment": f"SELECT {key('PAYMENT', "concat_ws(':', order_id, payment_sequential::VARCHAR)")} AS payment_key, order_key, order_id, payment_sequential, payment_type, payment_installments, payment_value, 1 AS payment_count FROM sil_order_payment JOIN (SELECT order_id, order_key FROM fact_order) USING (order_id) WHERE order_parent_exists AND amount_quality_status = 'VALID'",
    "fact_review_base": f"""SELECT {key('REVIEW', "concat_ws(':', review_id, order_id)")} AS review_key, order_key, review_id, order_id, {_dk('review_creation_date')} AS review_date_key, review_score, o.analysis_scope_status AS order_analysis_scope_status, review_text_present, response_latency_seconds, ai_eligibility_status
  FROM sil_order_review JOIN fact_order o USING (order_id) WHERE order_parent_exists AND response_interval_valid AND review_score BETWEEN 1 AND 5""",
    "bridge_review_item": f"""SELECT {key('REVIEW_ATTRIBUTION', "concat_ws(':', review_key, attribution_ordinal::VARCHAR)")} AS attribution_key, review_key, order_key, review_id, order_id, attribution_ordinal, order_item_key, coalesce(product_key, {unknown('PRODUCT')}) AS product_key, coalesce(seller_key, {unknown('SELLER')}) AS seller_key,
  item_count_for_review, CASE WHEN item_count_for_review = 0 THEN 'UNKNOWN_ITEM_FALLBACK' ELSE 'EQUAL_ITEM_WEIGHT' END AS allocation_method, review_score, weight_units, review_score * weight_units AS score_units FROM (
  SELECT *, CASE WHEN item_count_for_review = 0 THEN {UNIT} WHEN attribution_ordinal = item_count_for_review THEN {UNIT} - ({UNIT} // item_count_for_review) * (item_count_for_review - 1) ELSE {UNIT} // item_count_for_review END AS weight_units FROM (
  SELECT r.*, order_item_key, product_key, seller_key, count(order_item_key) OVER (PARTITION BY review_key) AS item_count_for_review, row_number() OVER (PARTITION BY review_key ORDER BY order_item_id NULLS LAST, order_item_key NULLS LAST) AS attribution_ordinal
  FROM fact_review_base r LEFT JOIN (SELECT order_id, order_item_id, order_item_key, product_key, seller_key FROM fact_order_item) USING (order_id)))""",
    "order_rows": f"""SELECT o.*, period_month, geography_key, state AS geography_state, city AS geography_city, customer_id, repeat_customer_key, gmv, freight, paid, coalesce({_eligible}, false) AS eligible FROM fact_order o JOIN (SELECT date_key, month_start_date AS period_month FROM dim_date) ON purchase_date_key = date_key
  JOIN (SELECT customer_key, customer_id, repeat_customer_key, geography_key FROM dim_customer) USING (customer_key) JOIN (SELECT geography_key, city, state FROM dim_geography) USING (geography_key)
  LEFT JOIN (SELECT order_key, sum(price) AS gmv, sum(freight_value) AS freight FROM fact_order_item GROUP BY 1) USING (order_key) LEFT JOIN (SELECT order_key, sum(payment_value) AS paid FROM fact_payment GROUP BY 1) USING (order_key)""",
}


def _place_mart(kind: str, own: str, metrics: str, after: str) -> str:
    return f"""SELECT {key(kind, "concat_ws(':', strftime(period_month, '%Y-%m-%d'), geography_key)")} AS {own}, *, payment_value - gross_merchandise_value - freight_value AS payment_reconciliation_delta, '{RELEASE}' AS data_release_id, {after} FROM (
  SELECT period_month, geography_key, geography_state, geography_city, count(*) AS order_count, count(*) FILTER (order_status = 'delivered') AS delivered_order_count, count(*) FILTER (order_status = 'canceled') AS cancelled_order_count, {metrics},
  coalesce(sum(gmv), 0) AS gross_merchandise_value, coalesce(sum(freight), 0) AS freight_value, coalesce(sum(paid), 0) AS payment_value FROM order_rows LEFT JOIN lifetime USING (repeat_customer_key) GROUP BY ALL)"""


CTES["lifetime"] = f"SELECT repeat_customer_key, count(DISTINCT order_key) AS lifetime FROM fact_order JOIN (SELECT customer_key, repeat_customer_key FROM dim_customer WHERE customer_id <> '{UNKNOWN}') USING (customer_key) GROUP BY 1"
CTES["mart_order_delivery"] = (
    "SELECT * EXCLUDE (lead, delay) FROM ("
    + _place_mart("MART_ORDER_DELIVERY", "delivery_mart_key", "count(*) FILTER (eligible) AS delivery_eligible_order_count, count(*) FILTER (eligible AND is_on_time_delivery) AS on_time_order_count, sum(delivery_lead_seconds) FILTER (eligible) AS lead, sum(delivery_delay_seconds) FILTER (eligible) AS delay", f"{_ratio('on_time_order_count', 'delivery_eligible_order_count')} AS on_time_delivery_rate, {_ratio('lead', 'delivery_eligible_order_count')} AS average_delivery_lead_seconds, {_ratio('delay', 'delivery_eligible_order_count')} AS average_delivery_delay_seconds")
    + ")"
)
CTES["mart_customer_overview"] = _place_mart("MART_CUSTOMER_OVERVIEW", "customer_overview_mart_key", f"count(*) FILTER (customer_id = '{UNKNOWN}') AS unknown_customer_order_count, count(DISTINCT repeat_customer_key) FILTER (customer_id <> '{UNKNOWN}') AS customer_count, count(DISTINCT repeat_customer_key) FILTER (customer_id <> '{UNKNOWN}' AND lifetime > 1) AS repeat_customer_count", f"{_ratio('repeat_customer_count', 'customer_count')} AS repeat_customer_rate")
_review_columns = f"round(coalesce(wu, 0)::DOUBLE / 1e18, 6) AS allocated_review_count, round(coalesce(su, 0)::DOUBLE / 1e18, 6) AS allocated_review_score, round(su::DOUBLE / nullif(wu, 0)::DOUBLE, 6) AS average_review_score, '{RELEASE}' AS data_release_id"
CTES["mart_product_review"] = f"""SELECT {key('MART_PRODUCT_REVIEW', "concat_ws(':', strftime(period_month, '%Y-%m-%d'), product_key)")} AS product_review_mart_key, period_month, product_key, product_category_name, product_category_name_english, coalesce(order_count, 0) AS order_count, coalesce(item_count, 0) AS item_count,
  coalesce(gmv, 0) AS gross_merchandise_value, coalesce(freight, 0) AS freight_value, {_review_columns} FROM (SELECT period_month, product_key, count(DISTINCT order_key) AS order_count, sum(item_count) AS item_count, sum(price) AS gmv, sum(freight_value) AS freight FROM fact_order_item {_month} GROUP BY 1, 2)
  FULL JOIN {_reviews('product_key')} USING (period_month, product_key) JOIN (SELECT product_key, product_category_name, product_category_name_english FROM dim_product) USING (product_key)"""
CTES["mart_seller_performance"] = f"""SELECT {key('MART_SELLER_PERFORMANCE', "concat_ws(':', strftime(period_month, '%Y-%m-%d'), seller_key)")} AS seller_performance_mart_key, period_month, seller_key, geography_key, seller_state, seller_city, coalesce(order_count, 0) AS order_count, coalesce(item_count, 0) AS item_count,
  coalesce(delivered, 0) AS delivered_order_count, coalesce(eligible_n, 0) AS delivery_eligible_order_count, coalesce(on_time, 0) AS on_time_order_count, coalesce(gmv, 0) AS gross_merchandise_value, coalesce(freight, 0) AS freight_value, {_review_columns},
  {_ratio('coalesce(on_time, 0)', 'coalesce(eligible_n, 0)')} AS on_time_delivery_rate, {_ratio('lead', 'eligible_n')} AS average_delivery_lead_seconds FROM (
  SELECT period_month, seller_key, count(*) AS order_count, sum(item_count) AS item_count, count(*) FILTER (order_status = 'delivered') AS delivered, count(*) FILTER ({_eligible}) AS eligible_n, count(*) FILTER ({_eligible} AND is_on_time_delivery) AS on_time, sum(delivery_lead_seconds) FILTER ({_eligible}) AS lead, sum(gmv) AS gmv, sum(freight) AS freight FROM (
    SELECT period_month, seller_key, order_key, order_status, delivery_interval_valid, delivery_lead_seconds, delivery_delay_seconds, is_on_time_delivery, sum(item_count) AS item_count, sum(price) AS gmv, sum(freight_value) AS freight FROM fact_order_item {_month} GROUP BY ALL) GROUP BY 1, 2)
  FULL JOIN {_reviews('seller_key')} USING (period_month, seller_key) JOIN (SELECT seller_key, geography_key, seller_state, seller_city FROM dim_seller) USING (seller_key)"""
for _name, (_mart, _columns) in SEMANTIC.items():
    CTES[f"sem_{_name}"] = f"SELECT {', '.join(f'{c} AS {RENAMED.get(c, c)}' for c in _columns)} FROM {_mart}"


def sql(select: str) -> str:
    """A statement with the expressions that it needs, in order."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"(?:FROM|JOIN) {name}\b", text):
                add(CTES[name])
                if name not in need:
                    need.append(name)

    add(select)
    return ("WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in need) + "\n" if need else "") + select
