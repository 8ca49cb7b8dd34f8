"""Bronze entities derived from a TPC-H-like star schema.

The source tables hold no NULLs and no orphans, so the expressions plant
defects by key.  They are valid in Spark SQL and in DuckDB, which lets a check
start both engines from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Entity -> (source table, output column -> expression).
ADAPTERS: dict[str, tuple[str, dict[str, str]]] = {
    "orders": (
        "orders",
        {
            "order_id": """CASE WHEN o_orderkey % 887 = 0 THEN NULL WHEN o_orderkey % 881 = 0 THEN ''
                ELSE md5(CAST(o_orderkey AS STRING)) END""",
            "customer_id": """CASE WHEN o_orderkey % 877 = 0 THEN NULL WHEN o_orderkey % 863 = 0 THEN ' '
                ELSE md5(concat('c', CAST(o_custkey AS STRING))) END""",
            "order_status": """CASE WHEN o_orderkey % 20 < 14 THEN 'delivered'
                WHEN o_orderkey % 20 = 14 THEN 'shipped'
                WHEN o_orderkey % 20 = 15 THEN 'canceled'
                WHEN o_orderkey % 20 = 16 THEN 'unavailable'
                WHEN o_orderkey % 20 = 17 THEN 'invoiced'
                WHEN o_orderkey % 20 = 18 THEN 'processing'
                WHEN o_orderkey % 3 = 0 THEN 'created'
                WHEN o_orderkey % 3 = 1 THEN 'approved' ELSE 'lost' END""",
            "order_purchase_timestamp": "o_orderdate",
            "order_approved_at": """CASE WHEN o_orderkey % 61 = 0 THEN NULL
                WHEN o_orderkey % 101 = 0 THEN o_orderdate - INTERVAL '1' HOUR
                ELSE o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 48) END""",
            "order_delivered_carrier_date": """CASE
                WHEN o_orderkey % 20 > 16 OR o_orderkey % 67 = 0 THEN NULL
                WHEN o_orderkey % 89 = 0 THEN o_orderdate - INTERVAL '1' DAY
                ELSE o_orderdate + INTERVAL '1' DAY * (3 + o_orderkey % 7) END""",
            "order_delivered_customer_date": """CASE
                WHEN o_orderkey % 20 > 14 OR o_orderkey % 71 = 0 THEN NULL
                WHEN o_orderkey % 83 = 0 THEN o_orderdate + INTERVAL '1' DAY
                ELSE o_orderdate + INTERVAL '1' HOUR * (120 + (o_orderkey * 37) % 700) END""",
            "order_estimated_delivery_date": """CASE WHEN o_orderkey % 113 = 0 THEN NULL
                ELSE o_orderdate + INTERVAL '20' DAY END""",
        },
    ),
    "order_items": (
        "lineitem",
        {
            "order_id": """CASE WHEN l_orderkey % 991 = 0 THEN NULL
                ELSE md5(CAST(CASE WHEN l_orderkey % 997 = 0 THEN -l_orderkey - 1
                ELSE l_orderkey END AS STRING)) END""",
            "order_item_id": "CASE WHEN l_orderkey % 983 = 0 THEN NULL ELSE l_linenumber END",
            "product_id": """CASE WHEN l_partkey % 193 = 0 THEN NULL
                ELSE md5(concat('p', CAST(CASE WHEN l_partkey % 197 = 0
                THEN -l_partkey - 1 ELSE l_partkey END AS STRING))) END""",
            "seller_id": """CASE WHEN l_orderkey % 977 = 0 THEN NULL
                WHEN l_orderkey % 971 = 0 THEN md5('no seller')
                ELSE md5(concat('s', CAST(l_suppkey AS STRING))) END""",
            "shipping_limit_date": "CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE l_shipdate END",
            "price": """CASE WHEN l_orderkey % 307 = 0 THEN -l_extendedprice
                ELSE l_extendedprice END""",
            "freight_value": """CASE WHEN l_orderkey % 311 = 0 THEN -ROUND(l_quantity * l_tax, 2)
                ELSE ROUND(l_quantity * l_tax, 2) END""",
        },
    ),
    "customers": (
        "customer",
        {
            "customer_id": """CASE WHEN c_custkey % 101 = 0 THEN NULL
                ELSE md5(concat('c', CAST(CASE WHEN c_custkey % 97 = 0
                THEN -c_custkey - 1 ELSE c_custkey END AS STRING))) END""",
            "customer_unique_id": """CASE WHEN c_custkey % 89 = 0 THEN NULL
                WHEN c_custkey % 79 = 0 THEN ''
                ELSE md5(concat('u', CAST(c_custkey - c_custkey % 3 AS STRING))) END""",
            "customer_zip_code_prefix": """CASE WHEN c_custkey % 53 = 0 THEN NULL
                WHEN c_custkey % 59 = 0 THEN 500
                ELSE CAST(1000 + (c_custkey * 7919) % 99000 AS INT) END""",
            "customer_city": "CASE WHEN c_custkey % 47 = 0 THEN '  ' ELSE lower(c_mktsegment) END",
            "customer_state": """CASE WHEN c_custkey % 43 = 0 THEN NULL
                WHEN c_custkey % 41 = 0 THEN '' WHEN c_nationkey = 0 THEN 'XX'
                WHEN c_nationkey < 9 THEN 'SP' WHEN c_nationkey < 16 THEN ' RJ '
                ELSE 'MG' END""",
        },
    ),
    "products": (
        "part",
        {
            "product_id": "md5(concat('p', CAST(p_partkey AS STRING)))",
            "product_category_name": "CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE lower(p_type) END",
            "product_name_lenght": """CAST(CASE WHEN p_partkey % 37 = 0 THEN NULL
                ELSE length(p_name) END AS INT)""",
            "product_description_lenght": """CAST(CASE WHEN p_partkey % 37 = 0 THEN NULL
                ELSE length(p_name) * 9 END AS INT)""",
            "product_photos_qty": """CASE WHEN p_partkey % 37 = 0 THEN NULL
                ELSE CAST(p_partkey % 8 AS INT) END""",
            "product_weight_g": """CASE WHEN p_partkey % 401 = 0 THEN NULL
                WHEN p_partkey % 151 = 0 THEN 0 ELSE p_size * 100 END""",
            "product_length_cm": "CASE WHEN p_partkey % 401 = 0 THEN NULL ELSE p_size END",
            "product_height_cm": "CASE WHEN p_partkey % 401 = 0 THEN NULL ELSE p_size + 1 END",
            "product_width_cm": "CASE WHEN p_partkey % 401 = 0 THEN NULL ELSE p_size + 2 END",
        },
    ),
    "sellers": (
        "supplier",
        {
            "seller_id": """CASE WHEN s_suppkey % 89 = 9 THEN NULL
                ELSE md5(concat('s', CAST(s_suppkey AS STRING))) END""",
            "seller_zip_code_prefix": """CASE WHEN s_suppkey % 31 = 3 THEN NULL
                WHEN s_suppkey % 31 = 7 THEN 123456
                ELSE CAST(1000 + s_suppkey * 31 AS INT) END""",
            "seller_city": "CASE WHEN s_suppkey % 83 = 4 THEN ' ' ELSE lower(s_name) END",
            "seller_state": """CASE WHEN s_suppkey % 29 = 5 THEN NULL
                WHEN s_nationkey = 1 OR s_suppkey % 79 = 6 THEN 'ZZ' WHEN s_nationkey < 10 THEN 'SP'
                WHEN s_nationkey < 18 THEN 'PR' ELSE 'SC' END""",
        },
    ),
    "order_payments": (
        "events",
        {
            "order_id": """CASE WHEN event_id % 229 = 0 THEN NULL
                ELSE md5(CAST(event_id * 2 AS STRING)) END""",
            "payment_sequential": """CASE WHEN event_id % 233 = 0 THEN NULL
                ELSE CAST(1 + event_id % 2 AS INT) END""",
            "payment_type": """CASE WHEN event_id % 239 = 0 THEN NULL
                WHEN event_id % 241 = 0 THEN '' WHEN event_type = 'click' THEN 'credit_card'
                WHEN event_type = 'view' THEN 'boleto' WHEN event_type = 'purchase' THEN 'voucher'
                WHEN event_type = 'signup' THEN 'debit_card'
                WHEN event_id % 5 = 0 THEN 'pix' ELSE 'not_defined' END""",
            "payment_installments": """CASE WHEN event_id % 223 = 0 THEN NULL
                ELSE CAST(event_id % 13 AS INT) END""",
            "payment_value": """CASE WHEN event_id % 227 = 0 THEN -value
                WHEN event_id % 251 = 0 THEN NULL ELSE value END""",
        },
    ),
    "order_reviews": (
        "events",
        {
            "review_id": """CASE WHEN event_id % 113 = 0 THEN NULL
                WHEN event_id % 101 = 0 THEN 'great product'
                ELSE md5(concat('r', CAST(event_id AS STRING))) END""",
            "order_id": """CASE WHEN event_id % 103 = 0 THEN NULL
                WHEN event_id % 107 = 0 THEN 'chegou bem'
                ELSE md5(CAST(event_id * 2 AS STRING)) END""",
            "review_score": """CASE WHEN event_id % 23 = 0 THEN NULL
                WHEN event_id % 23 = 1 THEN '2018-01-18 00:00:00'
                ELSE CAST(1 + event_id % 5 AS STRING) END""",
            "review_comment_title": "CASE WHEN event_id % 9 = 0 THEN event_type ELSE NULL END",
            "review_comment_message": "CASE WHEN event_id % 5 = 0 THEN props ELSE NULL END",
            "review_creation_date": """CASE WHEN event_id % 109 = 0 THEN NULL
                WHEN event_id % 109 = 1 THEN 'abc'
                ELSE CAST(date_trunc('day', ts) AS STRING) END""",
            "review_answer_timestamp": """CASE WHEN event_id % 137 = 0 THEN NULL
                WHEN event_id % 127 = 0 THEN '2018-02-30 00:00:00'
                WHEN event_id % 131 = 0
                THEN CAST(date_trunc('second', ts) - INTERVAL '3' DAY AS STRING)
                ELSE CAST(date_trunc('second', ts) AS STRING) END""",
        },
    ),
}


@dataclass(frozen=True)
class Bronze:
    """The seven raw entities."""

    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame


def adapt(source: DataFrame, entity: str) -> DataFrame:
    _, columns = ADAPTERS[entity]
    return source.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


class BronzePlan:
    """Bronze entities over ``<folder>/<table>.parquet``; a file is opened when it is first needed."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder

    def __getattr__(self, entity: str) -> DataFrame:
        if entity not in ADAPTERS:
            raise AttributeError(entity)
        table, _ = ADAPTERS[entity]
        source = self._spark.read.parquet(f"{self._folder}/{table}.parquet")
        frame = adapt(source, entity)
        setattr(self, entity, frame)
        return frame


def bronze_from_layer(spark: SparkSession, layer: str) -> Bronze:
    """Bronze entities from the tables that an ingest wrote."""
    return Bronze(**{entity: spark.table(f"{layer}.{entity}") for entity in ADAPTERS})


def adapter_sql(entity: str) -> str:
    """The same adapter as a SELECT statement."""
    table, columns = ADAPTERS[entity]
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {table}"
