"""ANSI SQL (DuckDB dialect) with the expected result of each registered query.

Written from the definitions, not generated from the Spark plans; only the
adapter SELECTs that shape the raw test tables are shared by both sides.
"""

from __future__ import annotations

import re

from tallymart.plans.silver import KEYS, ORDER_STATUSES, PAYMENT_TYPES
from tallymart.plans.sql_reports import REPORTS
from tallymart.sources.adapters import ADAPTERS, adapter_sql

STATES = (
    "'AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA',"
    "'PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO'"
)
HEX = "'^[0-9a-f]{32}$'"


def money(*columns: str) -> str:
    """Exact sum of two-decimal amounts."""
    return "CAST(" + " + ".join(f"SUM(CAST({c} AS DECIMAL(18,2)))" for c in columns) + " AS DOUBLE)"


def half_up(cents: str, n: str) -> str:
    """cents / n rounded half away from zero to whole cents, in integer arithmetic, as an amount."""
    return (
        f"sign({cents}) * CAST((2 * abs({cents}) + {n}) // (2 * NULLIF({n}, 0)) AS DOUBLE) / 100"
    )


def ones(condition: str) -> str:
    """Rows that meet a condition; NULL over no rows."""
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def hits(condition: str) -> str:
    """Rows that meet a condition; 0 over no rows."""
    return f"COUNT(*) FILTER (WHERE {condition})"


SILVER = {
    "s_orders": """
        SELECT *, approval_before_purchase OR carrier_before_approval OR customer_before_carrier
                AS has_timestamp_anomaly,
            date_sub('day', order_purchase_timestamp, order_delivered_customer_date)
                AS delivery_days,
            date_sub('day', order_estimated_delivery_date, order_delivered_customer_date)
                AS days_late
        FROM (SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
                trim(order_status) AS order_status, order_purchase_timestamp, order_approved_at,
                order_delivered_carrier_date, order_delivered_customer_date,
                order_estimated_delivery_date,
                COALESCE(trim(order_status) IN (@statuses@), FALSE) AS is_valid_status,
                COALESCE(order_purchase_timestamp > order_approved_at, FALSE)
                    AS approval_before_purchase,
                COALESCE(order_approved_at > order_delivered_carrier_date, FALSE)
                    AS carrier_before_approval,
                COALESCE(order_delivered_carrier_date > order_delivered_customer_date, FALSE)
                    AS customer_before_carrier,
                trim(order_status) = 'delivered' AND order_delivered_customer_date IS NULL
                    AS missing_delivery_timestamp,
                trim(order_status) = 'delivered' AND order_delivered_carrier_date IS NULL
                    AS missing_carrier_timestamp,
                order_estimated_delivery_date IS NULL AS missing_estimated_delivery_date,
                order_id IS NULL AS missing_order_id, customer_id IS NULL AS missing_customer_id
            FROM b_orders)""",
    "s_order_items": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
            i.price, i.freight_value, i.order_id IS NULL AS missing_order_id,
            i.order_item_id IS NULL AS missing_order_item_id,
            i.product_id IS NULL AS missing_product_id, i.seller_id IS NULL AS missing_seller_id,
            COALESCE(i.price < 0, FALSE) AS negative_price,
            COALESCE(i.freight_value < 0, FALSE) AS negative_freight_value,
            i.order_id IS NOT NULL AND i.order_id NOT IN
                (SELECT order_id FROM s_orders WHERE order_id IS NOT NULL)
                AS invalid_order_reference,
            i.product_id IS NOT NULL AND i.product_id NOT IN
                (SELECT product_id FROM b_products WHERE product_id IS NOT NULL)
                AS invalid_product_reference,
            i.seller_id IS NOT NULL AND i.seller_id NOT IN
                (SELECT seller_id FROM b_sellers WHERE seller_id IS NOT NULL)
                AS invalid_seller_reference,
            i.shipping_limit_date IS NULL AS missing_shipping_limit_date,
            COALESCE(i.shipping_limit_date < o.order_purchase_timestamp, FALSE)
                AS shipping_limit_before_purchase
        FROM b_order_items i LEFT JOIN s_orders o USING (order_id)""",
    "s_customers": f"""
        SELECT *, COALESCE(customer_id, '') = '' AS missing_customer_id,
            COALESCE(customer_unique_id, '') = '' AS missing_customer_unique_id,
            customer_zip_code_prefix IS NULL AS missing_customer_zip_code,
            COALESCE(customer_city, '') = '' AS missing_customer_city,
            COALESCE(customer_state, '') = '' AS missing_customer_state,
            COALESCE(customer_state NOT IN ({STATES}), FALSE) AS invalid_customer_state,
            COALESCE(customer_zip_code_prefix NOT BETWEEN 1000 AND 99999, FALSE)
                AS invalid_customer_zip_code
        FROM (SELECT trim(customer_id) AS customer_id,
                trim(customer_unique_id) AS customer_unique_id, customer_zip_code_prefix,
                trim(customer_city) AS customer_city, trim(customer_state) AS customer_state
            FROM b_customers)""",
    "s_products": """
        SELECT product_id, trim(product_category_name) AS product_category_name,
            product_name_lenght AS product_name_length,
            product_description_lenght AS product_description_length, product_photos_qty,
            product_weight_g, product_length_cm, product_height_cm, product_width_cm,
            COALESCE(trim(product_category_name), '') = '' AS missing_product_category,
            product_name_lenght IS NULL AS missing_product_name_length,
            product_description_lenght IS NULL AS missing_product_description_length,
            product_photos_qty IS NULL AS missing_product_photos_qty,
            product_weight_g IS NULL AS missing_product_weight,
            product_length_cm IS NULL AS missing_product_length,
            product_height_cm IS NULL AS missing_product_height,
            product_width_cm IS NULL AS missing_product_width,
            COALESCE(product_weight_g <= 0, FALSE) AS non_positive_weight
        FROM b_products""",
    "s_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, trim(seller_city) AS seller_city,
            trim(seller_state) AS seller_state, COALESCE(seller_id, '') = '' AS missing_seller_id,
            seller_zip_code_prefix IS NULL AS missing_seller_zip_code,
            COALESCE(trim(seller_city), '') = '' AS missing_seller_city,
            COALESCE(trim(seller_state), '') = '' AS missing_seller_state,
            COALESCE(trim(seller_state) NOT IN ({STATES}), FALSE) AS invalid_seller_state,
            COALESCE(seller_zip_code_prefix NOT BETWEEN 1000 AND 99999, FALSE)
                AS invalid_seller_zip_code
        FROM b_sellers""",
    "s_order_payments": """
        SELECT p.*, COALESCE(order_id, '') = '' AS missing_order_id,
            payment_sequential IS NULL AS missing_payment_sequential,
            COALESCE(payment_type, '') = '' AS missing_payment_type,
            payment_installments IS NULL AS missing_payment_installments,
            payment_value IS NULL AS missing_payment_value,
            COALESCE(payment_type NOT IN (@payment_types@), FALSE) AS invalid_payment_type,
            COALESCE(payment_installments <= 0, FALSE) AS invalid_payment_installments,
            COALESCE(payment_value < 0, FALSE) AS negative_payment_value,
            order_id NOT IN (SELECT order_id FROM s_orders WHERE order_id IS NOT NULL)
                AS invalid_order_reference
        FROM b_order_payments p""",
    "s_order_reviews": f"""
        SELECT review_id, order_id, review_score, review_score_int, review_comment_title,
            review_comment_message, review_creation_date, review_answer_timestamp,
            review_creation_ts, review_answer_ts, review_id IS NULL AS missing_review_id,
            COALESCE(NOT regexp_full_match(review_id, {HEX}), FALSE) AS malformed_review_id,
            order_id IS NULL AS missing_order_id,
            COALESCE(NOT regexp_full_match(order_id, {HEX}), FALSE) AS malformed_order_id,
            COALESCE(regexp_full_match(order_id, {HEX}) AND order_id NOT IN
                (SELECT order_id FROM s_orders WHERE order_id IS NOT NULL), FALSE)
                AS invalid_order_reference,
            review_score IS NULL AS missing_review_score,
            review_score IS NOT NULL AND review_score_int IS NULL AS invalid_review_score,
            review_creation_date IS NULL AS missing_review_creation_timestamp,
            review_creation_date IS NOT NULL AND review_creation_ts IS NULL
                AS invalid_review_creation_timestamp,
            review_answer_timestamp IS NULL AS missing_review_answer_timestamp,
            review_answer_timestamp IS NOT NULL AND review_answer_ts IS NULL
                AS invalid_review_answer_timestamp,
            COALESCE(review_creation_ts > review_answer_ts, FALSE) AS answer_before_creation
        FROM (SELECT *,
                CASE WHEN regexp_full_match(review_score, '[1-5]')
                    THEN CAST(review_score AS INTEGER) END AS review_score_int,
                try_strptime(review_creation_date, '%Y-%m-%d %H:%M:%S') AS review_creation_ts,
                try_strptime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S') AS review_answer_ts
            FROM b_order_reviews)""",
}

GOLD = {
    "g_sales": """
        SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id,
            o.order_purchase_timestamp, o.order_status, p.product_category_name, s.seller_state,
            i.price, i.freight_value, i.price + i.freight_value AS item_total_value
        FROM s_order_items i LEFT JOIN s_orders o USING (order_id)
        LEFT JOIN s_products p USING (product_id) LEFT JOIN s_sellers s USING (seller_id)""",
    "placed": """
        SELECT customer_unique_id, customer_city, customer_state, order_id,
            order_purchase_timestamp
        FROM s_customers LEFT JOIN s_orders USING (customer_id)""",
    "engaged": f"""
        SELECT customer_unique_id, CAST(SUM(payments) AS BIGINT) AS total_payments,
            CAST(SUM(reviews) AS BIGINT) AS total_reviews,
            {half_up("SUM(score_cents)", "COUNT(score_cents)")} AS average_review_score
        FROM placed
        LEFT JOIN (SELECT order_id, COUNT(*) AS payments FROM s_order_payments GROUP BY 1)
            USING (order_id)
        LEFT JOIN (SELECT order_id, COUNT(*) AS reviews,
                (200 * SUM(review_score_int) + COUNT(*)) // (2 * COUNT(*)) AS score_cents
            FROM s_order_reviews WHERE review_score_int IS NOT NULL GROUP BY 1) USING (order_id)
        GROUP BY 1""",
    "bought": """
        SELECT p.*, i.order_item_id, CAST(i.price AS DECIMAL(18,2)) AS price,
            CAST(i.freight_value AS DECIMAL(18,2)) AS freight
        FROM placed p LEFT JOIN s_order_items i USING (order_id)""",
}


def _customer_mart(columns: str, place: str) -> str:
    return f"""
        SELECT customer_unique_id, customer_city, customer_state, first_order_date,
            last_order_date, total_orders, total_items,
            CAST(products AS DOUBLE) AS total_product_value,
            CAST(freights AS DOUBLE) AS total_freight_value,
            CAST(products + freights AS DOUBLE) AS total_spend,
            {half_up("CAST((products + freights) * 100 AS BIGINT)", "total_orders")}
                AS average_order_value,
            total_payments, total_reviews, average_review_score
        FROM (SELECT {place}, MIN(order_purchase_timestamp) AS first_order_date,
                MAX(order_purchase_timestamp) AS last_order_date,
                COUNT(DISTINCT order_id) AS total_orders, COUNT(order_item_id) AS total_items,
                SUM(price) AS products, SUM(freight) AS freights
            FROM bought GROUP BY {columns})
        LEFT JOIN engaged USING (customer_unique_id)"""


ADDRESS = "customer_unique_id, customer_city, customer_state"
GOLD["g_customers"] = _customer_mart(ADDRESS, ADDRESS)
GOLD["g_persons"] = _customer_mart(
    "customer_unique_id",
    "customer_unique_id, first(customer_city ORDER BY customer_city, customer_state NULLS FIRST)"
    " AS customer_city,"
    " first(customer_state ORDER BY customer_city, customer_state NULLS FIRST) AS customer_state",
)
GOLD["g_deliveries"] = """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
            order_delivered_carrier_date, order_delivered_customer_date,
            order_estimated_delivery_date, delivery_days, days_late, has_timestamp_anomaly,
            missing_delivery_timestamp, missing_carrier_timestamp, missing_estimated_delivery_date
        FROM s_orders"""

# The allowed values come from the one list of each domain.
DOMAINS = {"@statuses@": ORDER_STATUSES, "@payment_types@": PAYMENT_TYPES}


def _with_domains(text: str) -> str:
    for mark, values in DOMAINS.items():
        text = text.replace(mark, ", ".join(f"'{value}'" for value in values))
    return text


CTES = {
    **{f"b_{entity}": adapter_sql(entity) for entity in ADAPTERS},
    **{name: _with_domains(text) for name, text in {**SILVER, **GOLD}.items()},
}


def with_ctes(body: str) -> str:
    """Put the definitions a query needs, directly or through others, in front of it."""

    def used(text: str) -> set[str]:
        return {name for name in CTES if re.search(rf"\b{name}\b", text)}

    needed: set[str] = set()
    todo = used(body)
    while todo:
        needed |= todo
        todo = set().union(*(used(CTES[name]) for name in todo)) - needed
    definitions = ", ".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {definitions} {body}" if definitions else body


def _flag_counts(entity: str) -> str:
    from tallymart.plans.silver import FLAGS

    return ", ".join(f"{hits(flag)} AS {flag}" for flag in FLAGS[entity])


def _null_counts(table: str, columns: list[str]) -> str:
    nulls = ", ".join(f"COUNT(*) - COUNT({c}) AS {c}_nulls" for c in columns)
    return f"SELECT COUNT(*) AS total_rows, {nulls} FROM {table}"


def _quartiles(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS value_count,
            CAST(MIN({c}) AS DOUBLE) AS min_value,
            CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25,
            CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50,
            CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75,
            CAST(MAX({c}) AS DOUBLE) AS max_value FROM {table}"""
        for c in columns
    )


def _missing_by_status(column: str, name: str) -> str:
    return f"""SELECT order_status, COUNT(*) AS order_count, {hits(f"{column} IS NULL")} AS {name}
        FROM b_orders GROUP BY ALL"""


def _share(base: str, part: str) -> str:
    return f"""SELECT base_rows, part_rows,
            part_rows * 100.0::DOUBLE / NULLIF(base_rows, 0) AS percentage
        FROM (SELECT {hits(base)} AS base_rows, {hits(f"{base} AND {part}")} AS part_rows
            FROM b_orders)"""


def profile_sql() -> dict[str, str]:
    sizes = ["product_length_cm", "product_height_cm", "product_width_cm"]
    lengths = ["product_name_length", "product_description_length", "product_photos_qty"]
    product_columns = [c for c in ADAPTERS["products"][1] if c != "product_id"]
    delivered, arrived = "order_status = 'delivered'", "order_delivered_customer_date"
    return {
        "profile_orders_row_count": "SELECT COUNT(*) AS total_rows FROM b_orders",
        "profile_orders_completeness": """SELECT COUNT(*) AS total_orders,
            COUNT(order_approved_at) AS approved_timestamp,
            COUNT(order_delivered_carrier_date) AS carrier_timestamp,
            COUNT(order_delivered_customer_date) AS customer_delivery_timestamp FROM b_orders""",
        "profile_orders_null_counts": _null_counts("b_orders", list(ADAPTERS["orders"][1])),
        "profile_orders_status_distribution": """SELECT order_status, COUNT(*) AS "count"
            FROM b_orders GROUP BY ALL""",
        "profile_orders_date_range": """SELECT MIN(order_purchase_timestamp) AS earliest_order,
            MAX(order_purchase_timestamp) AS latest_order FROM b_orders""",
        "profile_orders_timestamp_disorder": """SELECT * FROM b_orders
            WHERE order_purchase_timestamp > order_approved_at
            OR order_approved_at > order_delivered_carrier_date
            OR order_delivered_carrier_date > order_delivered_customer_date""",
        "profile_orders_delivered_without_date": _share(delivered, f"{arrived} IS NULL"),
        "profile_orders_undelivered_with_date": _share(
            "order_status <> 'delivered'", f"{arrived} IS NOT NULL"
        ),
        "profile_orders_missing_delivery_by_status": _missing_by_status(
            arrived, "missing_delivery_date"
        ),
        "profile_orders_missing_approval_by_status": _missing_by_status(
            "order_approved_at", "missing_approved_at"
        ),
        "profile_orders_missing_carrier_by_status": _missing_by_status(
            "order_delivered_carrier_date", "missing_carrier_date"
        ),
        "profile_items_row_count": "SELECT COUNT(*) AS total_rows FROM b_order_items",
        "profile_items_null_counts": _null_counts(
            "b_order_items", list(ADAPTERS["order_items"][1])
        ),
        "profile_items_sign_combinations": """SELECT price < 0 AS negative_price,
            price = 0 AS zero_price, freight_value < 0 AS negative_freight,
            freight_value = 0 AS zero_freight, COUNT(*) AS "count"
            FROM b_order_items GROUP BY ALL""",
        "profile_products_null_counts": _null_counts("b_products", product_columns),
        "profile_products_numeric_validity": f"""SELECT COUNT(*) AS total_rows,
            {hits("product_name_length < 0")} AS negative_name_length,
            {hits("product_description_length < 0")} AS negative_description_length,
            {hits("product_photos_qty < 0")} AS negative_photos_qty,
            {hits("product_weight_g <= 0")} AS non_positive_weight,
            {hits("product_length_cm <= 0")} AS non_positive_length,
            {hits("product_height_cm <= 0")} AS non_positive_height,
            {hits("product_width_cm <= 0")} AS non_positive_width FROM s_products""",
        "profile_items_distribution": _quartiles("b_order_items", ["price", "freight_value"]),
        "profile_products_distribution": _quartiles(
            "s_products", [*lengths, "product_weight_g", *sizes]
        ),
        "profile_products_weight_flag": """SELECT non_positive_weight, COUNT(*) AS "count"
            FROM s_products GROUP BY ALL""",
        "profile_products_without_category": """SELECT * FROM b_products
            WHERE product_category_name IS NULL""",
        "profile_products_without_weight_value": f"""SELECT product_id, product_category_name,
            product_weight_g, {", ".join(sizes)}, product_photos_qty
            FROM b_products WHERE product_weight_g <= 0""",
        "profile_sellers_null_counts": _null_counts("b_sellers", list(ADAPTERS["sellers"][1])),
        "profile_sellers_blank_counts": f"""SELECT COUNT(*) AS total_rows,
            {hits("COALESCE(seller_id, '') = ''")} AS missing_seller_id,
            {hits("COALESCE(seller_city, '') = ''")} AS missing_seller_city,
            {hits("COALESCE(seller_state, '') = ''")} AS missing_seller_state FROM s_sellers""",
        "profile_sellers_zip_range": f"""SELECT COUNT(*) AS total_rows,
            {hits("seller_zip_code_prefix < 1000")} AS zip_below_1000,
            {hits("seller_zip_code_prefix > 99999")} AS zip_above_99999 FROM b_sellers""",
        "profile_sellers_states": "SELECT DISTINCT seller_state FROM b_sellers",
        "profile_sellers_state_flag": """SELECT invalid_seller_state, COUNT(*) AS "count"
            FROM s_sellers GROUP BY ALL""",
        "profile_sellers_invalid_state_rows": f"""SELECT seller_id, seller_state FROM s_sellers
            WHERE seller_state NOT IN ({STATES})""",
        "profile_payments_invalid_installments": """SELECT order_id, payment_sequential,
            payment_type, payment_installments, payment_value
            FROM b_order_payments WHERE payment_installments <= 0""",
        "profile_reviews_typed_scores": f"""SELECT COUNT(*) AS total_rows,
            COUNT(review_score_int) AS valid_typed_scores,
            {hits("review_score IS NULL")} AS missing_scores,
            {hits("review_score NOT IN ('1','2','3','4','5')")} AS invalid_scores
            FROM s_order_reviews""",
        "profile_reviews_parsed_timestamps": f"""SELECT COUNT(*) AS total_rows,
            COUNT(review_creation_ts) AS valid_creation_timestamps,
            COUNT(review_answer_ts) AS valid_answer_timestamps,
            {hits("review_answer_ts < review_creation_ts")} AS answer_before_creation
            FROM s_order_reviews""",
        "profile_reviews_malformed_rows": """SELECT * EXCLUDE (review_score_int,
            review_creation_ts, review_answer_ts, answer_before_creation) FROM s_order_reviews
            WHERE malformed_order_id OR malformed_review_id OR invalid_review_score
            OR invalid_review_creation_timestamp OR invalid_review_answer_timestamp""",
    }


def integrity_sql() -> dict[str, str]:
    def orphans(child: str, parent: str, key: str) -> str:
        # a NULL key matches no parent
        return f"""SELECT DISTINCT {key} FROM b_{child} c
            WHERE NOT EXISTS (SELECT 1 FROM b_{parent} p WHERE p.{key} = c.{key})"""

    def duplicates(table: str, *keys: str) -> str:
        listed = ", ".join(keys)
        return f'SELECT {listed}, COUNT(*) AS "count" FROM {table} GROUP BY ALL HAVING COUNT(*) > 1'

    def parity(entity: str) -> str:
        return f"""SELECT source_rows, target_rows, source_rows = target_rows AS rows_match
            FROM (SELECT (SELECT COUNT(*) FROM b_{entity}) AS source_rows,
                (SELECT COUNT(*) FROM s_{entity}) AS target_rows)"""

    numbered = """SELECT order_id, COUNT(*) AS item_rows,
        MAX(order_item_id) AS max_order_item_id FROM b_order_items GROUP BY order_id"""
    return {
        "integrity_orphan_customer_ids": orphans("orders", "customers", "customer_id"),
        "integrity_orphan_order_ids": orphans("order_items", "orders", "order_id"),
        "integrity_orphan_product_ids": orphans("order_items", "products", "product_id"),
        "integrity_orphan_seller_ids": orphans("order_items", "sellers", "seller_id"),
        "integrity_orphan_payments": """SELECT order_id, payment_sequential, payment_type,
            payment_installments, payment_value FROM b_order_payments p
            WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = p.order_id)""",
        "integrity_orders_duplicates": duplicates("s_orders", "order_id"),
        "integrity_items_duplicates": duplicates("s_order_items", "order_id", "order_item_id"),
        "integrity_customers_duplicates": duplicates("s_customers", "customer_id"),
        "integrity_products_duplicates": duplicates("s_products", "product_id"),
        "integrity_sellers_duplicates": duplicates("s_sellers", "seller_id"),
        "integrity_payments_duplicates": duplicates(
            "s_order_payments", "order_id", "payment_sequential"
        ),
        "integrity_products_key": """SELECT COUNT(*) AS total_rows,
            COUNT(DISTINCT product_id) AS distinct_product_id FROM s_products""",
        "integrity_sellers_key": """SELECT COUNT(*) AS total_rows,
            COUNT(DISTINCT seller_id) AS distinct_seller_id FROM s_sellers""",
        "integrity_payments_key": """SELECT COUNT(*) AS total_rows,
            COUNT(DISTINCT (order_id, payment_sequential)) FILTER
                (WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL)
                AS distinct_payment_keys FROM s_order_payments""",
        "integrity_customers_distinct": """SELECT COUNT(*) AS distinct_customer_id
            FROM (SELECT DISTINCT customer_id FROM s_customers)""",
        "integrity_items_longest_orders": f"{numbered} ORDER BY item_rows DESC, order_id LIMIT 10",
        "integrity_items_sequence_violations": f"{numbered} HAVING item_rows <> max_order_item_id",
        "integrity_parity_items": parity("order_items"),
        "integrity_parity_customers": parity("customers"),
        "integrity_parity_payments": parity("order_payments"),
        "integrity_parity_reviews": parity("order_reviews"),
        "integrity_repeated_persons": """SELECT customer_unique_id, COUNT(*) AS address_rows
            FROM g_customers GROUP BY 1 HAVING COUNT(*) > 1""",
    }


def entity_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for entity in ADAPTERS:
        found[f"silver_{entity}"] = f"SELECT * FROM s_{entity}"
        found[f"dq_{entity}"] = f"SELECT {_flag_counts(entity)} FROM s_{entity}"
    found["dq_order_reviews"] = f"""SELECT COUNT(*) AS total_rows,
        {_flag_counts("order_reviews")} FROM s_order_reviews"""
    found["dq_orders"] = f"""SELECT MIN(delivery_days) AS min_delivery_days,
        MAX(delivery_days) AS max_delivery_days,
        COUNT(*) - COUNT(delivery_days) AS delivery_days_nulls, MIN(days_late) AS min_days_late,
        MAX(days_late) AS max_days_late, COUNT(*) - COUNT(days_late) AS days_late_nulls,
        {_flag_counts("orders")} FROM s_orders"""
    found["dq_order_payments_final"] = f"""SELECT COUNT(*) AS total_rows,
        COUNT(DISTINCT order_id) AS distinct_orders,
        COUNT(DISTINCT (order_id, payment_sequential)) FILTER
            (WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL)
            AS distinct_payment_keys, {_flag_counts("order_payments")} FROM s_order_payments"""
    for entity, key in KEYS.items():
        whole = " AND ".join(f"{c} IS NOT NULL" for c in key)
        distinct = f"COUNT(DISTINCT ({', '.join(key)})) FILTER (WHERE {whole}) AS distinct_keys," if key else ""
        found[f"layers_verify_{entity}"] = f"""SELECT COUNT(*) AS total_rows, {distinct}
            {_flag_counts(entity)} FROM s_{entity}"""
    found["layers_grain_customers"] = """SELECT COUNT(*) AS total_rows,
        COUNT(DISTINCT (customer_unique_id, customer_city, customer_state)) FILTER
            (WHERE customer_unique_id IS NOT NULL AND customer_city IS NOT NULL
                AND customer_state IS NOT NULL) AS addresses,
        COUNT(DISTINCT customer_unique_id) AS persons FROM g_customers"""
    found["layers_grain_sales"] = """SELECT COUNT(*) AS total_rows,
        COUNT(DISTINCT (order_id, order_item_id)) FILTER
            (WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL) AS items,
        COUNT(DISTINCT order_id) AS orders FROM g_sales"""
    found["gold_sales"] = "SELECT * FROM g_sales"
    found["gold_customers"] = "SELECT * FROM g_customers"
    found["gold_customers_by_person"] = "SELECT * FROM g_persons"
    found["gold_deliveries"] = "SELECT * FROM g_deliveries"
    # CSV does not tell an empty text from none
    found["source_csv_scan"] = """SELECT order_id, payment_sequential,
        NULLIF(payment_type, '') AS payment_type, payment_installments, payment_value
        FROM b_order_payments"""
    found["source_ingest_audit"] = " UNION ALL ".join(
        f"""SELECT 'olist_{entity}_dataset.csv' AS source_file, '{entity}' AS target_table,
            COUNT(*) AS rows_read, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message,
            TRUE AS stamped FROM b_{entity}"""
        for entity in ("sellers", "products", "customers")
    )
    damaged = "(s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 OR s_suppkey % 13 = 0)"
    found["source_quarantine"] = f"""SELECT COUNT(*) AS rows_read,
        COUNT(*) FILTER (WHERE NOT {damaged}) AS rows_loaded,
        CAST(SUM(s_suppkey * 2) FILTER (WHERE NOT {damaged}) AS BIGINT) AS amount_loaded,
        COUNT(*) FILTER (WHERE {damaged}) AS rows_quarantined,
        MAX(CASE WHEN s_suppkey % 7 = 0 THEN concat('lost', s_suppkey)
            WHEN s_suppkey % 11 = 0 THEN concat_ws(',', s_suppkey, 'name', s_suppkey, 'more')
            WHEN s_suppkey % 13 = 0 THEN concat_ws(',', s_suppkey, 'name', 'many') END) AS last_record
        FROM supplier"""
    found["source_table_catalog"] = """
        SELECT 'list' AS operator, 'nations plain' AS value
        UNION ALL SELECT 'describe', 'n_name n_nationkey n_regionkey'
        UNION ALL SELECT 'rows', CAST(COUNT(*) AS VARCHAR) FROM nation
        UNION ALL SELECT 'preview', CAST(LEAST(COUNT(*), 10) AS VARCHAR) FROM nation
        UNION ALL SELECT 'plain', CAST(COUNT(*) AS VARCHAR) FROM nation WHERE n_regionkey = 1
        UNION ALL SELECT 'bound query', CAST(COUNT(*) AS VARCHAR) FROM nation WHERE n_nationkey >= 20
        UNION ALL SELECT 'statistics', CAST(COUNT(*) AS VARCHAR) FROM nation"""
    return found


SALES_WHERE = """order_purchase_timestamp >= TIMESTAMP '1996-01-01'
    AND order_purchase_timestamp < TIMESTAMP '1999-07-01'
    AND order_status IN ('delivered', 'shipped') AND seller_state IN ('SP', 'PR')"""
SALES_WHERE_CATEGORY = f"{SALES_WHERE} AND product_category_name IN ('promo','economy','standard')"
CUSTOMER_WHERE = "customer_state IN ('SP', 'RJ') AND total_spend >= 100000 AND total_orders >= 3"
DELIVERY_WHERE = """order_purchase_timestamp >= TIMESTAMP '1996-03-01'
    AND order_purchase_timestamp < TIMESTAMP '1998-09-16' AND order_status = 'delivered'"""

DETAIL_ORDER = """order_purchase_timestamp DESC NULLS LAST, order_id NULLS FIRST,
    order_item_id NULLS FIRST, product_id, seller_id, price, freight_value"""
CUSTOMER_ORDER = """total_spend DESC NULLS LAST, total_orders DESC NULLS LAST,
    customer_unique_id NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST"""


def _bounds(mart: str) -> str:
    return f"""SELECT CAST(MIN(order_purchase_timestamp) AS DATE) AS min_date,
        CAST(MAX(order_purchase_timestamp) AS DATE) AS max_date FROM {mart}"""


def _options(mart: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS filter_name, {column} AS "value" FROM {mart}
            WHERE {column} IS NOT NULL GROUP BY {column}"""
        for column, name in columns.items()
    )


def _sales_reports(where: str, limits: tuple[int, int] = (15, 10)) -> dict[str, str]:
    categories, sellers = limits
    revenue = f"{money('item_total_value')} AS revenue"
    per_order = f"""SELECT order_id, {money("item_total_value")} AS total
        FROM g_sales WHERE {where} GROUP BY order_id"""
    return {
        "kpis": f"""SELECT COALESCE({money("item_total_value")}, 0) AS revenue,
            COUNT(DISTINCT order_id) AS orders, COUNT(*) AS items,
            COALESCE((SELECT {money("total")} / COUNT(total) FROM ({per_order})), 0)
                AS average_order_value,
            COALESCE({money("item_total_value")} / COUNT(item_total_value), 0)
                AS average_item_value,
            COALESCE({money("freight_value")}, 0) AS freight_revenue
            FROM g_sales WHERE {where}""",
        "revenue_over_time": f"""SELECT
            CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
            {revenue} FROM g_sales WHERE {where} GROUP BY 1""",
        "revenue_by_category": f"""SELECT product_category_name, {revenue} FROM g_sales
            WHERE {where} AND product_category_name IS NOT NULL GROUP BY 1
            ORDER BY revenue DESC NULLS LAST, 1 LIMIT {categories}""",
        "uncategorized": f"""SELECT COUNT(*) AS uncategorized_items,
            COUNT(DISTINCT order_id) AS affected_orders,
            COALESCE({money("item_total_value")}, 0) AS uncategorized_revenue
            FROM g_sales WHERE {where} AND product_category_name IS NULL""",
        "revenue_by_seller_state": f"""SELECT seller_state, {revenue} FROM g_sales
            WHERE {where} AND seller_state IS NOT NULL GROUP BY 1""",
        "top_sellers": f"""SELECT seller_id, {revenue}, COUNT(DISTINCT order_id) AS orders
            FROM g_sales WHERE {where} GROUP BY 1
            ORDER BY revenue DESC NULLS LAST, 1 LIMIT {sellers}""",
        "orders_by_status": f"""SELECT order_status, COUNT(DISTINCT order_id) AS order_count
            FROM g_sales WHERE {where} GROUP BY 1""",
        "detail": f"""SELECT * EXCLUDE (customer_id) FROM g_sales WHERE {where}
            ORDER BY {DETAIL_ORDER}""",
    }


def _customer_reports(where: str) -> dict[str, str]:
    def mean(column: str) -> str:
        return f"COALESCE({money(column)} / NULLIF(COUNT({column}), 0), 0)"

    edges = [(100, "0-99"), (250, "100-249"), (500, "250-499"), (1000, "500-999")]
    edges.append((2000, "1,000-1,999"))
    label = "CASE " + " ".join(f"WHEN total_spend < {e} THEN '{t}'" for e, t in edges)
    place = "CASE " + " ".join(f"WHEN total_spend < {e} THEN {i}" for i, (e, _) in enumerate(edges, 1))
    return {
        "customer_kpis": f"""SELECT COUNT(*) AS total_customers,
            COALESCE({money("total_spend")}, 0) AS total_customer_spend,
            {mean("total_spend")} AS average_customer_spend,
            COALESCE(AVG(total_orders), 0) AS average_orders_per_customer,
            {mean("average_order_value")} AS average_customer_order_value,
            {mean("average_review_score")} AS average_review_score
            FROM g_customers WHERE {where}""",
        "customer_count_by_state": f"""SELECT customer_state, COUNT(*) AS customer_count
            FROM g_customers WHERE {where} GROUP BY 1""",
        "customer_spend_by_state": f"""SELECT customer_state, {money("total_spend")} AS total_spend
            FROM g_customers WHERE {where} GROUP BY 1""",
        "customer_order_frequency_distribution": f"""SELECT total_orders,
            COUNT(*) AS customer_count FROM g_customers WHERE {where} GROUP BY 1""",
        "customer_spending_distribution": f"""SELECT {label} ELSE '2,000+' END AS spend_bucket,
            COUNT(*) AS customer_count, {place} ELSE 6 END AS bucket_order
            FROM g_customers WHERE {where} GROUP BY ALL""",
        "new_customers_over_time": f"""SELECT
            CAST(date_trunc('month', first_order_date) AS TIMESTAMP) AS first_order_month,
            COUNT(*) AS new_customers FROM g_customers
            WHERE {where} AND first_order_date IS NOT NULL GROUP BY 1""",
        "customer_detail": f"""SELECT * EXCLUDE (total_product_value, total_freight_value,
            total_payments) FROM g_customers WHERE {where} ORDER BY {CUSTOMER_ORDER}""",
    }


def _delivery_reports(where: str) -> dict[str, str]:
    flags = ", ".join(
        f"{ones(flag)} AS {name}"
        for flag, name in {
            "has_timestamp_anomaly": "timestamp_anomalies",
            "missing_delivery_timestamp": "missing_delivery_timestamp",
            "missing_carrier_timestamp": "missing_carrier_timestamp",
            "missing_estimated_delivery_date": "missing_estimated_delivery_date",
        }.items()
    )
    start = "CAST(FLOOR(delivery_days / 2.0) * 2 AS INTEGER)"
    return {
        "delivery_kpis": f"""SELECT COUNT(*) AS total_orders,
            COALESCE(AVG(delivery_days), 0) AS average_delivery_days,
            quantile_disc(delivery_days, 0.5) AS median_delivery_days,
            COALESCE(AVG(days_late), 0) AS average_days_late,
            {ones("days_late > 0")} AS late_orders, {ones("days_late = 0")} AS on_time_orders,
            {ones("days_late < 0")} AS early_orders FROM g_deliveries WHERE {where}""",
        "delivery_time_distribution": f"""SELECT {start} AS bucket_start,
            {start} + 1 AS bucket_end, COUNT(*) AS order_count FROM g_deliveries
            WHERE {where} AND delivery_days IS NOT NULL GROUP BY ALL""",
        "delivery_status_distribution": f"""SELECT ['Early', 'On time', 'Late'][timing_order]
                AS delivery_timing, COUNT(*) AS order_count, timing_order
            FROM (SELECT CAST(sign(days_late) + 2 AS INTEGER) AS timing_order
                FROM g_deliveries WHERE {where} AND days_late IS NOT NULL) GROUP BY ALL""",
        "average_delivery_days_over_time": f"""SELECT
            CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
            AVG(delivery_days) AS average_delivery_days FROM g_deliveries
            WHERE {where} AND delivery_days IS NOT NULL GROUP BY 1""",
        "average_days_late_by_seller_state": f"""SELECT seller_state,
            AVG(days_late) AS average_days_late, COUNT(*) AS order_seller_pairs
            FROM (SELECT DISTINCT order_id, seller_state FROM g_sales
                WHERE seller_state IS NOT NULL)
            JOIN (SELECT order_id, days_late FROM g_deliveries
                WHERE {where} AND days_late IS NOT NULL) USING (order_id) GROUP BY 1""",
        "late_orders_by_month": f"""SELECT
            CAST(date_trunc('month', order_delivered_customer_date) AS TIMESTAMP)
                AS delivered_month, COUNT(*) AS late_orders FROM g_deliveries
            WHERE {where} AND days_late > 0 AND order_delivered_customer_date IS NOT NULL
            GROUP BY 1""",
        "delivery_quality_flags": f"SELECT {flags} FROM g_deliveries WHERE {where}",
    }


def report_sql() -> dict[str, str]:
    found: dict[str, str] = {}

    def sales(prefix: str, suffix: str, parts: dict[str, str]) -> None:
        names = {
            "kpis": "sales_kpis",
            "revenue_over_time": "sales_revenue_over_time",
            "revenue_by_category": "sales_revenue_by_category",
            "uncategorized": "sales_uncategorized_summary",
            "revenue_by_seller_state": "sales_revenue_by_seller_state",
            "top_sellers": "sales_top_sellers",
            "orders_by_status": "sales_order_status_distribution",
            "detail": "sales_detail",
        }
        for part, name in names.items():
            found[f"{prefix}{name}{suffix}"] = parts[part]

    everything = _sales_reports("TRUE")
    sales("report_", "", everything)
    chosen = _sales_reports(SALES_WHERE_CATEGORY)
    sales("report_", "_filtered", chosen)
    found["report_sales_uncategorized_summary_filtered"] = _sales_reports(SALES_WHERE)[
        "uncategorized"
    ]
    found["report_sales_uncategorized_contradiction"] = chosen["uncategorized"]
    found["report_sales_detail_page_3"] = f"{everything['detail']} LIMIT 50 OFFSET 100"
    found["distinct_orders"] = "SELECT COUNT(DISTINCT order_id) AS orders FROM g_sales"
    found["distinct_orders_by_status"] = """SELECT order_status, COUNT(DISTINCT order_id) AS orders
        FROM g_sales GROUP BY order_status"""
    found["distinct_orders_by_state_filtered"] = """SELECT seller_state, COUNT(DISTINCT order_id) AS orders
        FROM g_sales WHERE order_purchase_timestamp >= TIMESTAMP '1996-01-01'
            AND order_purchase_timestamp < TIMESTAMP '1999-07-01' AND order_status IN ('delivered', 'shipped')
        GROUP BY seller_state"""
    found["report_sales_detail_far_page"] = f"{everything['detail']} LIMIT 100 OFFSET 5000"
    for name in ("report_sales_detail", "report_sales_detail_filtered"):
        found[name] += " LIMIT 25"
    overview = _sales_reports("TRUE", (10, 10))
    found["report_overview_revenue_over_time"] = overview["revenue_over_time"]
    found["report_overview_revenue_by_category"] = overview["revenue_by_category"]
    found["report_overview_uncategorized_sales"] = overview["uncategorized"]
    found["report_overview_orders_by_status"] = overview["orders_by_status"]
    found["report_overview_revenue_by_seller_state"] = overview["revenue_by_seller_state"]
    found["report_overview_kpis"] = f"""SELECT revenue AS total_revenue, orders AS total_orders,
        items AS total_items, (SELECT COUNT(*) FROM g_customers) AS total_customers,
        average_order_value, (SELECT COALESCE(AVG(delivery_days), 0) FROM g_deliveries)
            AS average_delivery_days FROM ({overview["kpis"]})"""
    found["report_sales_date_bounds"] = _bounds("g_sales")
    found["report_delivery_date_bounds"] = _bounds("g_deliveries")
    found["report_sales_filter_options"] = _options(
        "g_sales",
        {
            "order_status": "order_statuses",
            "seller_state": "seller_states",
            "product_category_name": "product_categories",
        },
    )
    found["report_customer_filter_options"] = _options(
        "g_customers", {"customer_state": "customer_states"}
    )
    found["report_delivery_filter_options"] = _options(
        "g_deliveries", {"order_status": "order_statuses"}
    )
    for suffix, where in {"": "TRUE", "_filtered": CUSTOMER_WHERE}.items():
        for name, text in _customer_reports(where).items():
            found[f"report_{name}{suffix}"] = text
    ordered = found["report_customer_detail"]
    found["report_customer_detail_page_2"] = f"{ordered} LIMIT 100 OFFSET 100"
    for name in ("report_customer_detail", "report_customer_detail_filtered"):
        found[name] += " LIMIT 25"
    found["report_customer_kpis_zero_minimum"] = _customer_reports(
        "total_spend >= 0 AND total_orders >= 0"
    )["customer_kpis"]
    for suffix, where in {"": "TRUE", "_filtered": DELIVERY_WHERE}.items():
        for name, text in _delivery_reports(where).items():
            found[f"report_{name}{suffix}"] = text
    found["report_delivery_band_labels"] = f"""SELECT *,
        concat(bucket_start, '-', bucket_end, ' days') AS delivery_band
        FROM ({found["report_delivery_time_distribution"]})"""
    found["report_gold_table_counts"] = """
        SELECT 'sales' AS table_name, COUNT(*) AS row_count FROM g_sales
        UNION ALL SELECT 'customers', COUNT(*) FROM g_customers
        UNION ALL SELECT 'deliveries', COUNT(*) FROM g_deliveries"""
    found["report_gold_freshness"] = """
        SELECT 'sales' AS table_name, MAX(order_purchase_timestamp) AS latest_business_timestamp
        FROM g_sales UNION ALL SELECT 'customers', MAX(last_order_date) FROM g_customers
        UNION ALL SELECT 'deliveries', MAX(order_purchase_timestamp) FROM g_deliveries"""
    found["report_gold_null_counts"] = " UNION ALL ".join(
        f"""SELECT '{mart}' AS table_name, '{field}' AS field_name,
            {ones(f"{field} IS NULL")} AS null_count FROM g_{mart}"""
        for mart, field in [
            ("sales", "product_category_name"),
            ("sales", "seller_state"),
            ("customers", "customer_state"),
            ("customers", "first_order_date"),
            ("customers", "average_review_score"),
            ("deliveries", "order_delivered_customer_date"),
            ("deliveries", "order_estimated_delivery_date"),
            ("deliveries", "days_late"),
        ]
    )
    found["report_quality_indicators"] = f"""SELECT *,
        (SELECT {ones("product_category_name IS NULL")} FROM g_sales) AS uncategorized_items,
        (SELECT COUNT(DISTINCT order_id) FROM g_sales WHERE product_category_name IS NULL)
            AS uncategorized_orders
        FROM ({found["report_delivery_quality_flags"]})"""
    return found


def all_sql() -> dict[str, str]:
    parts = {**profile_sql(), **integrity_sql(), **entity_sql(), **report_sql()}
    # the reports that are table functions too; all sellers instead of the first ten
    for name in REPORTS:
        for suffix in ("", "_filtered"):
            of = "sales_top_sellers" if name == "sales_by_seller" else name
            text = parts[f"report_{of}{suffix}"]
            parts[f"sql_{name}{suffix}"] = re.sub(r"\s+LIMIT \d+\s*$", "", text)
    for name in ("table_counts", "freshness", "null_counts"):
        parts[f"layers_state_{name}"] = parts[f"report_gold_{name}"]
    return {name: with_ctes(body) for name, body in parts.items()}
