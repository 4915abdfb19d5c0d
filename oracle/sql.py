"""The expected results as plain SQL over the test tables.

Written the long way round on purpose: joins are multiplied out, distinct counts are
distinct counts, lookups are joined. Nothing here shares a shortcut with the plans.
``COMMON`` are the shared relations in dependency order; a query gets those it names.
"""

from __future__ import annotations

import re

from basketry.operators.quality import Check
from basketry.plans.checks import (
    INTERMEDIATE_CHECKS,
    MART_CHECKS,
    RAW_CHECKS,
    STAGING_CHECKS,
)
from basketry.schemas import TABLES


def _key(*columns: str) -> str:
    parts = [
        f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns
    ]
    return "md5(" + " || '-' || ".join(parts) + ")"


_META = """'historic' AS data_source, 'batch-0' AS batch_id,
       TIMESTAMP '2001-08-02 00:00:00' AS loaded_at"""

COMMON: dict[str, str] = {
    "places": """
SELECT c.*, n.n_name, r.r_name
FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "stg_customers": f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       c_name || '@example.com' AS email,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       CAST(18 + c_custkey % 58 AS INTEGER) AS age,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 10 AS DECIMAL(12,2)) AS annual_income,
       CASE c_custkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married'
            WHEN 2 THEN 'Divorced' ELSE 'Widowed' END AS marital_status,
       c_mktsegment AS education,
       CASE c_custkey % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Suburban' ELSE 'Rural' END
           AS location_type,
       'City_' || (c_custkey % 50) AS city, n_name AS state, r_name AS country,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS signup_date,
       CAST(DATE '2001-01-01' + CAST(c_custkey % 200 AS INTEGER) AS TIMESTAMP) AS last_login,
       CASE WHEN c_custkey % 5 = 0 THEN 'Email' WHEN c_custkey % 5 <= 2 THEN 'Web'
            ELSE 'Mobile App' END AS preferred_channel,
       c_custkey % 10 <> 0 AS is_active, {_META}
FROM places""",
    "stg_products": f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category_id,
       p_type || '-' || (p_size % 5) AS subcategory_id,
       p_name AS product_name, p_name || ' by ' || p_brand AS description,
       CAST(p_retailprice AS DECIMAL(12,2)) AS base_price,
       CAST(((CAST(round(p_retailprice * 100) AS BIGINT) * (1 + p_size % 10)) // 10) / 100.0
            AS DECIMAL(12,2)) AS sale_price,
       p_size AS stock_quantity, CAST(p_size / 4.0 AS DECIMAL(8,2)) AS weight_kg,
       p_size % 7 <> 0 AS is_active, TIMESTAMP '1995-01-01 00:00:00' AS created_at,
       p_brand AS brand, 'SKU-' || p_partkey AS sku,
       CAST(1 + p_size % 5 AS DECIMAL(3,1)) AS rating, 0 AS review_count, {_META}
FROM part""",
    "stg_categories": f"""
SELECT DISTINCT p_type AS category_id, p_type AS category_name,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at, {_META}
FROM part""",
    "stg_subcategories": f"""
SELECT DISTINCT p_type || '-' || (p_size % 5) AS subcategory_id, p_type AS category_id,
       p_type || ' group ' || (p_size % 5) AS subcategory_name,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at, {_META}
FROM part""",
    "order_text": """
SELECT *, o_orderkey || ' Main St, City_' || (o_custkey % 50) || ', NATION_' || (o_custkey % 25) || ', '
       || CASE o_custkey % 5 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA'
               WHEN 3 THEN 'EUROPE' ELSE 'MIDDLE EAST' END AS main_street
FROM orders""",
    "stg_orders": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderdate AS order_date, o_orderstatus AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       CAST(5 + o_orderkey % 16 AS DECIMAL(12,2)) AS shipping_cost,
       o_orderpriority AS payment_method, main_street AS shipping_address,
       CASE WHEN o_orderkey % 4 < 2 THEN (o_orderkey // 4) || ' Side St' ELSE main_street END
           AS billing_address,
       o_orderdate AS created_at, o_orderdate AS updated_at, {_META}
FROM order_text""",
    "stg_order_items": f"""
SELECT l_orderkey || '-' || l_linenumber AS order_item_id,
       CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
             // (2 * CAST(l_quantity AS BIGINT))) / 100.0 AS DECIMAL(12,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price,
       l_shipdate AS created_at, {_META}
FROM lineitem""",
    "stg_reviews": """
SELECT l_orderkey || '-' || l_partkey || '-' || l_linenumber AS review_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(1 + (l_orderkey + l_partkey + l_linenumber) % 5 AS INTEGER) AS review_score,
       'Review of part ' || l_partkey AS review_text,
       'historic' AS data_source, 'batch-0' AS batch_id, l_shipdate AS loaded_at
FROM lineitem
LEFT JOIN (SELECT o_orderkey, max(o_custkey) AS o_custkey FROM orders GROUP BY o_orderkey) AS buyers
       ON o_orderkey = l_orderkey
WHERE l_returnflag = 'R'""",
    "stg_interactions": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
       json_extract_string(props, '$.k') AS product_id,
       CASE event_type WHEN 'click' THEN 'cart_add' WHEN 'signup' THEN 'wishlist_add'
            WHEN 'error' THEN 'search' ELSE event_type END AS event_type,
       ts AS event_date,
       CASE CAST(floor(value) AS BIGINT) % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile'
            ELSE 'tablet' END AS device_type,
       user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
       ts AS created_at, {_META}
FROM events""",
    # entities
    "m_education": f"""
SELECT DISTINCT {_key("education")} AS education_id, education AS education_type
FROM stg_customers WHERE education IS NOT NULL""",
    "m_marital": f"""
SELECT DISTINCT {_key("marital_status")} AS marital_status_id, marital_status AS status_type
FROM stg_customers WHERE marital_status IS NOT NULL""",
    "m_status": f"""
SELECT DISTINCT {_key("status")} AS status_id, status AS status_name
FROM stg_orders WHERE status IS NOT NULL""",
    "m_payment": f"""
SELECT DISTINCT {_key("payment_method")} AS payment_method_id, payment_method AS method_name
FROM stg_orders WHERE payment_method IS NOT NULL""",
    "m_brands": f"""
SELECT DISTINCT {_key("trim(brand)")} AS brand_id, trim(brand) AS brand_name
FROM stg_products WHERE brand IS NOT NULL AND trim(brand) <> ''""",
    "address_texts": """
SELECT shipping_address AS address FROM stg_orders
UNION
SELECT billing_address FROM stg_orders""",
    "m_locations": f"""
SELECT DISTINCT {_key("city", "state", "country")} AS location_id, city, state, country
FROM (
    SELECT trim(split_part(address, ',', -3)) AS city, trim(split_part(address, ',', -2)) AS state,
           trim(split_part(address, ',', -1)) AS country
    FROM address_texts WHERE address IS NOT NULL
    UNION
    SELECT trim(city), trim(state), trim(country) FROM stg_customers
) AS every_place
WHERE city <> '' AND state <> '' AND country <> ''""",
    "m_addresses": f"""
SELECT DISTINCT {_key("pa.address", "pa.city", "pa.state", "pa.country")} AS address_id,
       pa.address AS street_address,
       coalesce(l.location_id, {_key("pa.city", "pa.state", "pa.country")}) AS location_id
FROM (
    SELECT o.shipping_address AS address, c.city, c.state, c.country
    FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
    UNION
    SELECT o.billing_address, c.city, c.state, c.country
    FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
) AS pa
LEFT JOIN m_locations l ON l.city = pa.city AND l.state = pa.state AND l.country = pa.country
WHERE pa.address IS NOT NULL""",
    "m_categories": """
SELECT c.category_id, c.category_name, c.created_at,
       (SELECT count(DISTINCT s.subcategory_id) FROM stg_subcategories s
        WHERE s.category_id = c.category_id) AS subcategory_count,
       (SELECT count(DISTINCT p.product_id) FROM stg_products p
        WHERE p.category_id = c.category_id) AS product_count
FROM stg_categories c""",
    "m_subcategories": """
SELECT s.subcategory_id, s.subcategory_name, s.category_id, s.created_at,
       (SELECT count(DISTINCT p.product_id) FROM stg_products p
        WHERE p.subcategory_id = s.subcategory_id) AS product_count
FROM stg_subcategories s""",
    "m_customers": f"""
SELECT c.*, ed.education_id, ms.marital_status_id,
       coalesce(l.location_id, {_key("trim(c.city)", "trim(c.state)", "trim(c.country)")})
           AS location_id,
       coalesce(h.n, 0) AS total_orders, coalesce(h.spent, 0) AS total_spent,
       h.first_order_date, h.last_order_date
FROM stg_customers c
LEFT JOIN m_education ed ON ed.education_type = c.education
LEFT JOIN m_marital ms ON ms.status_type = c.marital_status
LEFT JOIN m_locations l
       ON l.city = trim(c.city) AND l.state = trim(c.state) AND l.country = trim(c.country)
LEFT JOIN (
    SELECT customer_id, count(DISTINCT order_id) AS n, sum(total_amount) AS spent,
           min(order_date) AS first_order_date, max(order_date) AS last_order_date
    FROM stg_orders GROUP BY customer_id
) AS h ON h.customer_id = c.customer_id
WHERE trim(c.city) <> '' AND trim(c.state) <> '' AND trim(c.country) <> ''""",
    "m_products": """
SELECT p.product_id, p.product_name, p.description, p.base_price, p.sale_price, p.stock_quantity,
       p.weight_kg, p.is_active, b.brand_id, p.category_id, p.subcategory_id, p.created_at,
       coalesce(s.n, 0) AS total_orders, coalesce(s.units, 0) AS total_quantity_sold,
       coalesce(s.revenue, 0) AS total_revenue, coalesce(v.n, 0) AS review_count,
       v.mean AS avg_review_score
FROM stg_products p
LEFT JOIN m_brands b ON b.brand_name = trim(p.brand)
LEFT JOIN (
    SELECT product_id, count(DISTINCT order_id) AS n, sum(quantity) AS units,
           sum(total_price) AS revenue
    FROM stg_order_items GROUP BY product_id
) AS s ON s.product_id = p.product_id
LEFT JOIN (
    SELECT product_id, count(*) AS n, avg(review_score) AS mean
    FROM stg_reviews GROUP BY product_id
) AS v ON v.product_id = p.product_id
WHERE p.product_id IS NOT NULL""",
    "m_reviews": """
SELECT v.review_id, v.product_id, v.order_id, v.customer_id, v.review_score, v.review_text,
       p.product_name, c.category_name, s.subcategory_name, b.brand_name,
       v.loaded_at AS created_at
FROM stg_reviews v
LEFT JOIN m_products p ON p.product_id = v.product_id
LEFT JOIN m_categories c ON c.category_id = p.category_id
LEFT JOIN m_subcategories s ON s.subcategory_id = p.subcategory_id
LEFT JOIN m_brands b ON b.brand_id = p.brand_id""",
    "m_interactions": """
SELECT i.event_id, i.customer_id, i.product_id, p.category_id, p.subcategory_id, i.event_type,
       i.event_date, i.device_type, i.session_id, i.created_at
FROM stg_interactions i LEFT JOIN stg_products p ON p.product_id = i.product_id""",
    "newest_scores": """
SELECT order_id, product_id, review_score
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY order_id, product_id
        ORDER BY loaded_at DESC NULLS FIRST, review_id DESC, review_score DESC) AS place
    FROM stg_reviews
) AS ranked
WHERE place = 1""",
    "m_items": """
SELECT DISTINCT i.order_item_id, i.order_id, i.product_id, o.customer_id, i.quantity,
       i.unit_price, i.total_price, p.category_id, p.subcategory_id, p.brand_id,
       n.review_score, i.created_at
FROM stg_order_items i
LEFT JOIN stg_orders o ON o.order_id = i.order_id
LEFT JOIN m_products p ON p.product_id = i.product_id
LEFT JOIN newest_scores n ON n.order_id = i.order_id AND n.product_id = i.product_id
WHERE i.product_id IN (SELECT product_id FROM m_products)""",
    "m_orders": """
SELECT o.order_id, o.customer_id, o.order_date, st.status_id, pm.payment_method_id,
       sh.address_id AS shipping_address_id, bi.address_id AS billing_address_id,
       o.total_amount, o.shipping_cost, o.loaded_at AS created_at,
       count(DISTINCT i.product_id) AS unique_products, sum(i.quantity) AS total_items,
       bool_or(v.review_score IS NOT NULL) AS has_review, avg(v.review_score) AS avg_review_score
FROM stg_orders o
LEFT JOIN m_status st ON st.status_name = o.status
LEFT JOIN m_payment pm ON pm.method_name = o.payment_method
LEFT JOIN m_addresses sh ON sh.street_address = o.shipping_address
LEFT JOIN m_addresses bi ON bi.street_address = o.billing_address
LEFT JOIN stg_order_items i ON i.order_id = o.order_id
LEFT JOIN stg_reviews v ON v.order_id = o.order_id
GROUP BY ALL""",
}

_FINAL: dict[str, str] = {}


def _staged(table: str, ints: str = "", doubles: str = "") -> str:
    """All staged columns, numbers in the common output types."""
    replaced = [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    replaced += [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    return f"SELECT *{' REPLACE (' + ', '.join(replaced) + ')' if replaced else ''} FROM {table}"


_FINAL["stg_categories"] = _staged("stg_categories")
_FINAL["stg_subcategories"] = _staged("stg_subcategories")
_FINAL["stg_customers"] = _staged("stg_customers", "age", "annual_income")
_FINAL["stg_products"] = _staged(
    "stg_products", "stock_quantity review_count", "base_price sale_price weight_kg rating"
)
_FINAL["stg_orders"] = _staged("stg_orders", "", "total_amount shipping_cost")
_FINAL["stg_order_items"] = _staged("stg_order_items", "quantity", "unit_price total_price")
_FINAL["stg_interactions"] = _staged("stg_interactions")
_FINAL["stg_reviews"] = _staged("stg_reviews", "review_score")

_FINAL["lookup_education"] = "SELECT * FROM m_education"
_FINAL["lookup_marital"] = "SELECT * FROM m_marital"
_FINAL["lookup_status"] = "SELECT * FROM m_status"
_FINAL["lookup_payment"] = "SELECT * FROM m_payment"
_FINAL["brands"] = "SELECT * FROM m_brands"
_FINAL["locations"] = "SELECT * FROM m_locations"
_FINAL["addresses"] = "SELECT * FROM m_addresses"
_FINAL["categories_enriched"] = _staged("m_categories", "subcategory_count product_count")
_FINAL["subcategories_enriched"] = _staged("m_subcategories", "product_count")
_FINAL["customers_enriched"] = """
SELECT customer_id, email, first_name, last_name, CAST(age AS BIGINT) AS age, gender,
       CAST(annual_income AS DOUBLE) AS annual_income, education_id, marital_status_id,
       location_id, signup_date, last_login, preferred_channel, is_active,
       CAST(total_orders AS BIGINT) AS total_orders, CAST(total_spent AS DOUBLE) AS total_spent,
       first_order_date, last_order_date, loaded_at AS created_at
FROM m_customers"""
_FINAL["products_enriched"] = _staged(
    "m_products",
    "stock_quantity total_orders total_quantity_sold review_count",
    "base_price sale_price weight_kg total_revenue avg_review_score",
)
_FINAL["reviews_enriched"] = _staged("m_reviews", "review_score")
_FINAL["customer_interactions"] = _staged("m_interactions")
_FINAL["order_items"] = _staged("m_items", "quantity review_score", "unit_price total_price")
_FINAL["orders_enriched"] = _staged(
    "m_orders", "unique_products total_items", "total_amount shipping_cost avg_review_score"
)
_FINAL["orders_corrected"] = f"""
SELECT o.order_id, o.customer_id, o.order_date, {_key("o.status")} AS status_id,
       {_key("o.payment_method")} AS payment_method_id,
       {_key("o.shipping_address", "c.city", "c.state", "c.country")} AS shipping_address_id,
       {_key("o.billing_address", "c.city", "c.state", "c.country")} AS billing_address_id,
       CAST(o.total_amount AS DOUBLE) AS total_amount,
       CAST(o.shipping_cost AS DOUBLE) AS shipping_cost,
       (SELECT count(DISTINCT i.product_id) FROM stg_order_items i
        WHERE i.order_id = o.order_id) AS unique_products,
       (SELECT CAST(sum(i.quantity) AS BIGINT) FROM stg_order_items i
        WHERE i.order_id = o.order_id) AS total_items,
       EXISTS (SELECT 1 FROM stg_reviews v WHERE v.order_id = o.order_id) AS has_review,
       (SELECT avg(v.review_score) FROM stg_reviews v
        WHERE v.order_id = o.order_id) AS avg_review_score,
       o.loaded_at AS created_at
FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id"""

_FINAL["dim_categories"] = """
SELECT c.category_id, c.category_name,
       left(coalesce((SELECT string_agg(n, ', ' ORDER BY n) FROM (
           SELECT DISTINCT subcategory_name AS n FROM m_subcategories s
           WHERE s.category_id = c.category_id) AS x), ''), 1000) AS subcategories,
       left((SELECT string_agg(n, ', ' ORDER BY n) FROM (
           SELECT DISTINCT product_name AS n FROM m_products p
           WHERE p.category_id = c.category_id) AS y), 1000) AS product_names,
       c.created_at
FROM m_categories c"""
_FINAL["dim_customers"] = """
SELECT c.customer_id, c.email, c.first_name, c.last_name, CAST(c.age AS BIGINT) AS age, c.gender,
       CAST(c.annual_income AS DOUBLE) AS annual_income, l.city, l.state, l.country,
       ed.education_type, ms.status_type AS marital_status,
       CASE WHEN h.newest >= DATE '2001-05-01' THEN 'Active'
            WHEN h.newest >= DATE '2001-02-01' THEN 'At Risk' ELSE 'Churned' END AS customer_status,
       CAST(date_diff('day', CAST(coalesce(h.oldest, c.signup_date) AS DATE), DATE '2001-08-01')
            AS BIGINT) AS customer_lifetime_days,
       c.signup_date, c.last_login, c.is_active, c.loaded_at AS created_at
FROM m_customers c
LEFT JOIN m_locations l ON l.location_id = c.location_id
LEFT JOIN m_education ed ON ed.education_id = c.education_id
LEFT JOIN m_marital ms ON ms.marital_status_id = c.marital_status_id
LEFT JOIN (SELECT customer_id, min(order_date) AS oldest, max(order_date) AS newest
           FROM m_orders GROUP BY customer_id) AS h ON h.customer_id = c.customer_id"""
_FINAL["dim_dates"] = """
SELECT d AS date, year(d) AS year, month(d) AS month, day(d) AS day,
       CAST(extract(dow FROM d) AS BIGINT) AS day_of_week,
       CAST(date_trunc('month', d) AS DATE) AS first_day_of_month,
       last_day(d) AS last_day_of_month, CAST(date_trunc('year', d) AS DATE) AS first_day_of_year,
       CASE WHEN d = DATE '2024-01-15' THEN 'Current' WHEN d > DATE '2024-01-15' THEN 'Future'
            ELSE 'Past' END AS date_status
FROM (
    SELECT CAST(order_date AS DATE) AS d FROM m_orders
    UNION SELECT CAST(created_at AS DATE) FROM m_orders
    UNION SELECT CAST(event_date AS DATE) FROM m_interactions
) AS days"""
_FINAL["dim_locations"] = """
SELECT DISTINCT l.location_id, l.city, l.state, l.country
FROM m_locations l
LEFT JOIN m_customers c ON c.location_id = l.location_id
LEFT JOIN m_orders o ON o.customer_id = c.customer_id"""
_FINAL["dim_products"] = """
SELECT p.product_id, p.category_id, p.product_name, p.description,
       CAST(p.base_price AS DOUBLE) AS base_price, CAST(p.sale_price AS DOUBLE) AS sale_price,
       CAST(p.stock_quantity AS BIGINT) AS stock_quantity, c.category_name, s.subcategory_name,
       b.brand_name, CAST(p.review_count AS BIGINT) AS review_count,
       coalesce(p.avg_review_score, 0.0) AS avg_review_score,
       CASE WHEN p.stock_quantity = 0 THEN 'Out of Stock' WHEN p.stock_quantity < 10 THEN 'Low Stock'
            ELSE 'In Stock' END AS inventory_status,
       p.is_active, p.created_at
FROM m_products p
LEFT JOIN m_categories c ON c.category_id = p.category_id
LEFT JOIN m_subcategories s ON s.subcategory_id = p.subcategory_id
LEFT JOIN m_brands b ON b.brand_id = p.brand_id"""

_FINAL["fct_customer_activity"] = """
SELECT c.customer_id, c.email, CAST(i.event_date AS DATE) AS event_date,
       count(*) FILTER (WHERE event_type = 'view') AS total_views,
       count(DISTINCT product_id) FILTER (WHERE event_type = 'view') AS unique_products_viewed,
       count(*) FILTER (WHERE event_type = 'cart_add') AS cart_adds,
       count(DISTINCT product_id) FILTER (WHERE event_type = 'cart_add') AS unique_products_added,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       count(DISTINCT product_id) FILTER (WHERE event_type = 'purchase')
           AS unique_products_purchased,
       count(DISTINCT session_id) AS total_sessions, count(DISTINCT device_type) AS devices_used
FROM m_customers c JOIN m_interactions i ON i.customer_id = c.customer_id
WHERE i.event_date IS NOT NULL
GROUP BY c.customer_id, c.email, CAST(i.event_date AS DATE)"""
_FINAL["fct_customer_orders"] = """
SELECT o.customer_id, o.order_id, CAST(o.order_date AS DATE) AS order_date,
       CAST(o.total_amount AS DOUBLE) AS total_amount,
       count(DISTINCT i.product_id) AS unique_products,
       CAST(sum(i.quantity) AS BIGINT) AS total_items,
       CAST(o.total_amount AS DOUBLE) / nullif(count(DISTINCT i.product_id), 0) AS avg_order_value,
       avg(v.review_score) AS avg_review_score
FROM m_orders o
LEFT JOIN m_items i ON i.order_id = o.order_id
LEFT JOIN m_reviews v ON v.order_id = o.order_id
GROUP BY o.customer_id, o.order_id, o.order_date, o.total_amount"""
_FINAL["fct_customer_reviews"] = """
SELECT v.customer_id, v.product_id, v.order_id, CAST(v.review_score AS BIGINT) AS review_score,
       v.review_text, p.category_id, p.subcategory_id
FROM m_reviews v JOIN m_products p ON p.product_id = v.product_id"""
_FINAL["fct_order_details"] = """
SELECT o.order_id, CAST(o.order_date AS DATE) AS order_date, c.customer_id, c.email,
       lc.city AS customer_city, lc.state AS customer_state, p.product_id, p.product_name,
       ca.category_name, b.brand_name, st.status_name, pm.method_name AS payment_method,
       ad.street_address AS shipping_address, la.city AS shipping_city,
       la.state AS shipping_state, CAST(i.quantity AS BIGINT) AS quantity,
       CAST(i.unit_price AS DOUBLE) AS unit_price, CAST(i.total_price AS DOUBLE) AS item_total,
       CAST(o.shipping_cost AS DOUBLE) AS shipping_cost,
       CAST(o.total_amount AS DOUBLE) AS order_total,
       CAST(v.review_score AS BIGINT) AS review_score, o.created_at
FROM m_items i
JOIN m_orders o ON o.order_id = i.order_id
JOIN m_customers c ON c.customer_id = o.customer_id
JOIN m_locations lc ON lc.location_id = c.location_id
JOIN m_products p ON p.product_id = i.product_id
JOIN m_categories ca ON ca.category_id = p.category_id
JOIN m_brands b ON b.brand_id = p.brand_id
LEFT JOIN m_status st ON st.status_id = o.status_id
LEFT JOIN m_payment pm ON pm.payment_method_id = o.payment_method_id
LEFT JOIN m_addresses ad ON ad.address_id = o.shipping_address_id
LEFT JOIN m_locations la ON la.location_id = ad.location_id
LEFT JOIN m_reviews v ON v.order_id = o.order_id AND v.product_id = i.product_id"""
_FINAL["fct_product_interactions"] = """
SELECT product_id, CAST(event_date AS DATE) AS event_date,
       count(DISTINCT event_id) FILTER (WHERE event_type = 'view') AS views,
       count(DISTINCT event_id) FILTER (WHERE event_type = 'cart_add') AS cart_adds,
       count(DISTINCT event_id) FILTER (WHERE event_type = 'wishlist_add') AS wishlist_adds,
       count(DISTINCT customer_id) AS unique_customers
FROM m_interactions GROUP BY product_id, CAST(event_date AS DATE)"""
_FINAL["fct_product_performance"] = """
SELECT product_id, date, total_orders, CAST(units AS BIGINT) AS units_sold,
       CAST(sales AS DOUBLE) AS revenue,
       CASE WHEN sales > 0 THEN
           sign(margin) * ((abs(margin) * 20000 + cents) // (2 * cents)) / 100.0
       ELSE 0.0 END AS profit_margin,
       CAST(stock AS BIGINT) AS stock_level,
       coalesce(stock <= CASE WHEN velocity IS NULL THEN NULL
                         ELSE greatest(velocity * 7, 10) END, false) AS reorder_flag
FROM (
    SELECT *, CAST(sales * 100 AS HUGEINT) AS cents,
           CAST((sales - units * price) * 100 AS HUGEINT) AS margin,
           avg(units) OVER (PARTITION BY product_id ORDER BY date
                            ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS velocity
    FROM (
        SELECT p.product_id, CAST(o.order_date AS DATE) AS date,
               count(DISTINCT i.quantity) AS total_orders, sum(i.quantity) AS units,
               sum(i.total_price) AS sales, min(p.base_price) AS price,
               min(p.stock_quantity) AS stock
        FROM m_products p
        JOIN m_items i ON i.product_id = p.product_id
        JOIN m_orders o ON o.order_id = i.order_id
        WHERE o.order_date IS NOT NULL
        GROUP BY p.product_id, CAST(o.order_date AS DATE)
    ) AS daily
) AS rated"""
_FINAL["fct_sales_by_date"] = """
SELECT CAST(order_date AS DATE) AS sale_date, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(shipping_cost) AS DOUBLE) AS total_shipping,
       CAST(sum(total_amount - shipping_cost) AS DOUBLE) AS net_revenue,
       CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
       CAST(sum(total_amount) AS DOUBLE) / nullif(count(DISTINCT customer_id), 0)
           AS revenue_per_customer
FROM m_orders GROUP BY CAST(order_date AS DATE)"""
_FINAL["fct_sales_by_product"] = """
SELECT p.product_id, p.category_id, CAST(o.order_date AS DATE) AS order_date,
       count(DISTINCT o.order_id) AS total_orders, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
       CAST(sum(i.total_price) AS DOUBLE) AS revenue,
       CAST(sum(i.unit_price) AS DOUBLE) / count(i.unit_price) AS avg_selling_price
FROM m_items i
JOIN m_products p ON p.product_id = i.product_id
JOIN m_orders o ON o.order_id = i.order_id
GROUP BY p.product_id, p.category_id, CAST(o.order_date AS DATE)"""
_FINAL["fct_sales_by_region"] = """
SELECT c.location_id, CAST(o.order_date AS DATE) AS date,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(sum(o.total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(o.total_amount) AS DOUBLE) / nullif(count(DISTINCT o.order_id), 0)
           AS avg_order_value,
       count(DISTINCT o.customer_id) AS customer_count
FROM m_orders o JOIN m_customers c ON c.customer_id = o.customer_id
GROUP BY c.location_id, CAST(o.order_date AS DATE)"""
_FINAL["customer_journey"] = """
SELECT a.category_name AS source_category, b.category_name AS target_category,
       count(DISTINCT customer_id) AS flow_value
FROM (
    SELECT i.customer_id, i.category_id AS source,
           lead(i.category_id) OVER (
               PARTITION BY i.customer_id
               ORDER BY o.order_date NULLS FIRST, i.order_id, i.order_item_id, i.product_id) AS target
    FROM m_items i
    JOIN (SELECT DISTINCT order_id, order_date FROM m_orders) AS o ON o.order_id = i.order_id
) AS moves
JOIN m_categories a ON a.category_id = source
JOIN m_categories b ON b.category_id = target
GROUP BY a.category_name, b.category_name"""


# ingest

COMMON["order_rows"] = """
SELECT order_id, customer_id, order_date, status, total_amount, data_source, batch_id, loaded_at
FROM stg_orders"""
COMMON["latest_orders"] = """
SELECT order_id, customer_id, order_date, CASE WHEN status = 'P' THEN 'O' ELSE status END AS status,
       total_amount, 'latest' AS data_source, 'batch-1' AS batch_id,
       TIMESTAMP '2001-08-03 00:00:00' AS loaded_at
FROM order_rows WHERE order_date >= TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT 'N' || order_id, customer_id, order_date, status, total_amount, 'latest', 'batch-1',
       TIMESTAMP '2001-08-03 00:00:00'
FROM order_rows WHERE order_date >= TIMESTAMP '2001-07-01 00:00:00'"""
COMMON["combined_orders"] = """
SELECT * FROM order_rows WHERE order_date < (SELECT min(order_date) FROM latest_orders)
UNION ALL
SELECT * FROM latest_orders"""

_FINAL["ingest_cutover"] = _staged("combined_orders", "", "total_amount")
_FINAL["ingest_dedup"] = """
SELECT * EXCLUDE (place) REPLACE (CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price)
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY order_item_id
        ORDER BY loaded_at DESC, created_at DESC, order_id, product_id, quantity, unit_price,
                 total_price) AS place
    FROM stg_order_items
) AS ranked WHERE place = 1"""
_FINAL["ingest_upsert"] = """
SELECT o.order_id, o.customer_id, o.order_date, coalesce(l.status, o.status) AS status,
       CAST(o.total_amount AS DOUBLE) AS total_amount,
       CASE WHEN l.status <> o.status THEN l.data_source ELSE o.data_source END AS data_source,
       CASE WHEN l.status <> o.status THEN l.batch_id ELSE o.batch_id END AS batch_id,
       CASE WHEN l.status <> o.status THEN l.loaded_at ELSE o.loaded_at END AS loaded_at
FROM order_rows o LEFT JOIN latest_orders l ON l.order_id = o.order_id
UNION ALL
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount)
FROM latest_orders WHERE order_id NOT IN (SELECT order_id FROM order_rows)"""
_FINAL["ingest_merge_files"] = _FINAL["ingest_upsert"]
_FINAL["ingest_merge_counts"] = """
SELECT * FROM (WITH sizes AS (
    SELECT 1 AS version, count(*) AS n_rows FROM order_rows
    UNION ALL
    SELECT 2, (SELECT count(*) FROM order_rows)
        + (SELECT count(*) FROM latest_orders WHERE order_id NOT IN (SELECT order_id FROM order_rows))
), steps AS (
    SELECT 'merge' AS step,
        (SELECT count(*) FROM order_rows o JOIN latest_orders l USING (order_id) WHERE l.status <> o.status)
            AS updated,
        (SELECT count(*) FROM latest_orders WHERE order_id NOT IN (SELECT order_id FROM order_rows)) AS inserted
    UNION ALL SELECT 'replay', 0, 0
)
SELECT version, n_rows, step, updated, inserted FROM sizes LEFT JOIN steps ON version = 2) AS counted"""
_FINAL["ingest_audit"] = """
SELECT 'orders' AS table_name, 'batch-1' AS batch_id,
       TIMESTAMP '2001-08-03 00:00:00' AS loaded_at,
       count(*) FILTER (WHERE data_source = 'historic') AS historic_records,
       count(*) FILTER (WHERE data_source = 'latest') AS latest_records,
       count(DISTINCT order_id) AS total_records,
       count(*) - count(DISTINCT order_id) AS duplicates_removed,
       'order_date' AS date_column_used,
       (SELECT CAST(min(order_date) AS VARCHAR) FROM latest_orders) AS min_latest_date,
       'order_id' AS primary_keys_used
FROM combined_orders
UNION ALL
SELECT 'order_items', 'batch-1', TIMESTAMP '2001-08-03 00:00:00', count(*), 0,
       count(DISTINCT order_item_id), count(*) - count(DISTINCT order_item_id), 'created_at',
       CAST(min(created_at) AS VARCHAR), 'order_item_id'
FROM stg_order_items"""
_FINAL["incremental_orders"] = """
SELECT order_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount FROM order_rows"""
COMMON["loaded_days"] = """
SELECT CAST(order_date AS DATE) AS day FROM m_orders WHERE order_date < TIMESTAMP '2000-01-01 00:00:00'"""
_FINAL["incremental_customer_orders"] = f"""
SELECT * FROM ({_FINAL["fct_customer_orders"]}) AS whole
WHERE order_date > (SELECT max(day) FROM loaded_days)"""
_FINAL["incremental_sales_by_date"] = _FINAL["fct_sales_by_date"]
_FINAL["incremental_customer_activity"] = _FINAL["fct_customer_activity"]
_FINAL["pk_gaps"] = """
SELECT id + 1 AS gap_start, following - 1 AS gap_end, following - id - 1 AS missing_ids
FROM (
    SELECT id, lead(id) OVER (ORDER BY id) AS following
    FROM (SELECT DISTINCT CAST(order_id AS BIGINT) AS id FROM stg_order_items) AS ids
) AS neighbours WHERE following - id > 1"""
COMMON["missing_order_ids"] = """
SELECT r.id
FROM (SELECT unnest(generate_series(
          (SELECT min(CAST(order_id AS BIGINT)) FROM stg_order_items),
          (SELECT max(CAST(order_id AS BIGINT)) FROM stg_order_items))) AS id) AS r
WHERE r.id NOT IN (SELECT CAST(order_id AS BIGINT) FROM stg_order_items)"""
_FINAL["pk_gap_summary"] = """
SELECT min(CAST(order_id AS BIGINT)) AS min_id, max(CAST(order_id AS BIGINT)) AS max_id,
       count(DISTINCT order_id) AS distinct_ids,
       (SELECT count(*) FROM missing_order_ids) AS missing_ids
FROM stg_order_items"""
_FINAL["first_gaps"] = """
SELECT id AS missing_id FROM missing_order_ids ORDER BY id LIMIT 5"""
_FINAL["pk_ranges"] = """
SELECT 'historic' AS side, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders
UNION ALL
SELECT 'latest', min(o_orderkey), max(o_orderkey) FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'"""
_FINAL["lost_order_ids"] = """
SELECT DISTINCT order_id FROM stg_orders
WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)"""
_FINAL["json_flatten"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k,
       event_type AS what_event_type, user_id AS what_by_user_id,
       '[' || event_id || ',' || user_id || ']' AS ids
FROM events"""
_FINAL["date_normalise"] = """
SELECT event_id, CASE event_id % 4
           WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           WHEN 2 THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS event_date
FROM events"""
_FINAL["key_fill"] = """
SELECT count(*) AS records, count(*) AS distinct_ids, 1 AS min_id, count(*) AS max_id FROM lineitem"""
_FINAL["extract_summary"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, count(*) AS records, "
    f"min({day}) AS first_date, max({day}) AS last_date FROM stg_{table}"
    for table, day in {
        "categories": "created_at",
        "subcategories": "created_at",
        "customers": "signup_date",
        "products": "created_at",
        "orders": "order_date",
        "order_items": "created_at",
        "interactions": "event_date",
        "reviews": "CAST(NULL AS TIMESTAMP)",
    }.items()
)

# measures

_FINAL["order_status_recency"] = """
SELECT order_id, order_date,
       CASE WHEN date_diff('day', order_date, TIMESTAMP '2001-08-01') < 2 THEN 'Pending'
            WHEN date_diff('day', order_date, TIMESTAMP '2001-08-01') < 4 THEN 'Processing'
            WHEN date_diff('day', order_date, TIMESTAMP '2001-08-01') < 7 THEN 'Shipped'
            ELSE 'Delivered' END AS status
FROM stg_orders"""
_FINAL["income_tier"] = """
SELECT CASE WHEN annual_income > 80000 THEN 'High Value' WHEN annual_income > 50000 THEN 'Mid Value'
            ELSE 'Low Value' END AS tier,
       count(*) AS customers, CAST(sum(annual_income) AS DOUBLE) AS total_income
FROM stg_customers GROUP BY 1"""
_FINAL["price_band_scores"] = """
SELECT band, CAST(review_score AS BIGINT) AS review_score, count(*) AS reviews,
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY band) AS DOUBLE) AS share
FROM (
    SELECT v.review_score, CASE WHEN p.sale_price > 500 THEN 'Premium'
               WHEN p.sale_price > 100 THEN 'Mid-range' ELSE 'Budget' END AS band
    FROM stg_reviews v JOIN stg_products p ON p.product_id = v.product_id
) AS banded GROUP BY band, review_score"""
COMMON["segments"] = """
SELECT *, CASE WHEN age BETWEEN 18 AND 25 THEN 'Gen Z' WHEN age BETWEEN 26 AND 32 THEN 'Young Millennials'
              WHEN age BETWEEN 33 AND 40 THEN 'Older Millennials' WHEN age BETWEEN 41 AND 56 THEN 'Gen X'
              WHEN age BETWEEN 57 AND 75 THEN 'Boomers' ELSE 'Other' END AS segment
FROM stg_customers"""
_FINAL["segment_share"] = """
SELECT segment, 'education' AS attribute, education AS value, count(*) AS customers,
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY segment) AS DOUBLE) AS share
FROM segments GROUP BY segment, education
UNION ALL
SELECT segment, 'channel', preferred_channel, count(*),
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY segment) AS DOUBLE)
FROM segments GROUP BY segment, preferred_channel"""
_FINAL["new_vs_returning"] = """
SELECT CASE WHEN CAST(customer_id AS BIGINT) >= 100 THEN 'new' ELSE 'returning' END AS customer_kind,
       count(DISTINCT customer_id) AS customers, count(*) AS orders,
       CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM stg_orders GROUP BY 1"""
_FINAL["event_transitions"] = """
SELECT from_event, to_event, count(*) AS transitions,
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY from_event) AS DOUBLE) AS probability
FROM (
    SELECT event_type AS from_event, lead(event_type) OVER (
               PARTITION BY session_id ORDER BY event_date, event_id) AS to_event
    FROM stg_interactions WHERE session_id IS NOT NULL
) AS moves WHERE to_event IS NOT NULL GROUP BY from_event, to_event"""
_FINAL["seasonality"] = """
SELECT 'month' AS dimension, month(order_date) AS bucket, 'all' AS device_type, count(*) AS n,
       (CAST(sum(total_amount) AS DOUBLE) / count(*))
       / (SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) FROM stg_orders) AS factor
FROM stg_orders GROUP BY month(order_date)
UNION ALL
SELECT 'weekday', isodow(order_date) - 1, 'all', count(*),
       (CAST(sum(total_amount) AS DOUBLE) / count(*))
       / (SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) FROM stg_orders)
FROM stg_orders GROUP BY isodow(order_date) - 1
UNION ALL
SELECT 'hour', hour(event_date), device_type, count(*),
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY device_type) AS DOUBLE)
FROM stg_interactions GROUP BY hour(event_date), device_type"""
_FINAL["review_delay"] = """
SELECT date_diff('day', o.order_date, v.loaded_at) AS delay_days, count(*) AS reviews
FROM stg_reviews v JOIN stg_orders o ON o.order_id = v.order_id
WHERE o.status = 'F' GROUP BY 1"""
_FINAL["review_sentiment"] = """
SELECT CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score >= 3 THEN 'neutral'
            ELSE 'negative' END AS sentiment,
       count(*) AS reviews, CAST(sum(review_score) AS BIGINT) AS score_sum
FROM stg_reviews GROUP BY 1"""
_FINAL["rating_refresh"] = """
SELECT p.product_id,
       coalesce(((20 * sum(v.review_score) + count(v.review_score)) // nullif(2 * count(v.review_score), 0))
                / 10.0, CAST(any_value(p.rating) AS DOUBLE)) AS rating,
       CASE WHEN count(v.review_id) > 0 THEN count(v.review_id) ELSE any_value(p.review_count) END
           AS review_count
FROM stg_products p LEFT JOIN stg_reviews v ON v.product_id = p.product_id
GROUP BY p.product_id"""

_LOAD = "'latest' AS DATA_SOURCE, 'batch-1' AS BATCH_ID, '2001-08-03 00:00:00' AS LOADED_AT"
_FINAL["ingest_transform"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS TOTAL_AMOUNT,
       CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS ORDER_DATE,
       o_orderstatus AS STATE_CODE, o_custkey AS STATE_BY_O_CUSTKEY,
       o_orderpriority AS NOTE_1, o_orderkey AS NOTE_2, {_LOAD}
FROM orders"""
_FINAL["ingest_reference"] = f"""
SELECT DISTINCT p_type AS CATEGORY_ID, upper(p_type) AS CATEGORY_NAME, {_LOAD}
FROM part WHERE p_type NOT LIKE 'A%'"""
_KEY_HASH = "CAST('0x' || substr(md5('42:' || customer_id), 1, 15) AS BIGINT)"
_FINAL["customer_sample"] = f"""
SELECT * EXCLUDE (place) REPLACE (CAST(annual_income AS DOUBLE) AS annual_income, CAST(age AS BIGINT) AS age)
FROM (SELECT *, row_number() OVER (ORDER BY {_KEY_HASH}, customer_id) AS place FROM stg_customers)
WHERE place <= (SELECT floor(count(*) * 0.3) FROM stg_customers)"""
_FINAL["returning_customers"] = f"""
SELECT * REPLACE (CAST(annual_income AS DOUBLE) AS annual_income, CAST(age AS BIGINT) AS age,
    TIMESTAMP '2001-08-03' AS last_login, TRUE AS is_active)
FROM stg_customers WHERE {_KEY_HASH} < {int(0.2 * (1 << 60))}
UNION ALL
SELECT * REPLACE (CAST(annual_income AS DOUBLE) AS annual_income, CAST(age AS BIGINT) AS age,
    'N' || customer_id AS customer_id)
FROM stg_customers WHERE signup_date >= TIMESTAMP '1995-12-01'"""

# quality

_RELATIONS = {
    "education_types": "m_education",
    "marital_statuses": "m_marital",
    "order_statuses": "m_status",
    "payment_methods": "m_payment",
    "brands": "m_brands",
    "locations": "m_locations",
    "addresses": "m_addresses",
    "categories_enriched": "m_categories",
    "subcategories_enriched": "m_subcategories",
    "customers_enriched": "m_customers",
    "products_enriched": "m_products",
    "reviews_enriched": "m_reviews",
    "customer_interactions": "m_interactions",
    "order_items": "m_items",
    "orders": "m_orders",
}
_SERVED = [name for name in _FINAL if name.startswith(("dim_", "fct_"))]
for _name in _SERVED:
    COMMON[f"served_{_name}"] = "\n" + _FINAL[_name].strip()
    _RELATIONS[_name] = f"served_{_name}"


def _check_sql(check: Check, relations: dict[str, str]) -> str:
    table = relations[check.table]
    if check.kind == "not_null":
        count = f"SELECT count(*) FROM {table} WHERE {check.column} IS NULL"
    elif check.kind == "relationships":
        parent, column = check.parent.split(".")
        count = (
            f"SELECT count(*) FROM {table} c WHERE c.{check.column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {relations[parent]} p WHERE p.{column} = c.{check.column})"
        )
    else:
        key = check.column
        count = (
            f"SELECT count(*) FROM (SELECT {key} FROM {table} "
            f"WHERE {' AND '.join(k + ' IS NOT NULL' for k in key.split(', '))} "
            f"GROUP BY {key} HAVING count(*) > 1) AS repeated"
        )
    bad = "warn" if check.severity == "warn" else "fail"
    return (
        f"SELECT '{check.table}' AS table_name, '{check.column}' AS column_name, "
        f"'{check.kind}' AS check_name, '{check.severity}' AS severity, n AS failing_rows, "
        f"CASE WHEN n = 0 THEN 'pass' ELSE '{bad}' END AS status FROM ({count}) AS found(n)"
    )


def _checks_sql(checks: list[Check], relations: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(_check_sql(check, relations) for check in checks)


_STAGED = {name: f"stg_{name}" for name in TABLES}
_FINAL["dq_report"] = _checks_sql(RAW_CHECKS, _STAGED)
_FINAL["dq_staging"] = _checks_sql(STAGING_CHECKS, {f"stg_{n}": f"stg_{n}" for n in TABLES})
_FINAL["dq_intermediate"] = _checks_sql(INTERMEDIATE_CHECKS, _RELATIONS)
_FINAL["dq_marts"] = _checks_sql(MART_CHECKS, _RELATIONS)


def _with(sql: str) -> str:
    """Prefix the shared relations a query names, directly or through one another."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in COMMON:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(COMMON[name])

    visit(sql)
    relations = [f"{name} AS ({body}\n)" for name, body in COMMON.items() if name in needed]
    return ("WITH " + ",\n".join(relations) + "\n" if relations else "") + sql.strip()


def oracle_queries() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _FINAL.items()}
