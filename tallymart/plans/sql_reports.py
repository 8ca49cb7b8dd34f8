"""Reports as SQL table functions, so that a SQL client filters them without Python.

``register`` defines them over the marts of a layer::

    SELECT * FROM sales_revenue_over_time(start_date => DATE'2018-01-01', seller_states => array('SP'))

Parameters are typed and have defaults that filter nothing, as those of the Python reports do.
The body of a function is inlined where it is called, so the optimizer sees plain predicates: a test
of a parameter against NULL is folded away, and days become a range of timestamps at the scan.
Rows come in no particular order, as from any table; add ORDER BY.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallymart.functions.bands import EARLY, LATE, ON_TIME
from tallymart.functions.money import sum_text
from tallymart.operators.rules import literal

DAYS = {"start_date": "DATE", "end_date": "DATE"}
STATUSES = {"order_statuses": "ARRAY<STRING>"}
SALES = {**DAYS, **STATUSES, "seller_states": "ARRAY<STRING>", "product_categories": "ARRAY<STRING>"}
CUSTOMERS = {"customer_states": "ARRAY<STRING>", "minimum_total_spend": "DOUBLE", "minimum_total_orders": "BIGINT"}
DELIVERIES = {**DAYS, **STATUSES}

# The predicate of each parameter; @ stands for the parameter.
PREDICATES = {
    "start_date": "to_date(order_purchase_timestamp) >= @",
    "end_date": "to_date(order_purchase_timestamp) <= @",
    "minimum_total_spend": "total_spend >= @",
    "minimum_total_orders": "total_orders >= @",
}
# The column that each list of values is looked for in.
LISTED = {
    "order_statuses": "order_status",
    "seller_states": "seller_state",
    "product_categories": "product_category_name",
    "customer_states": "customer_state",
}


@dataclass(frozen=True)
class Report:
    """``body`` reads from ``@rows``, the filtered mart; ``columns`` are those it returns."""

    mart: str
    parameters: dict[str, str]
    columns: str
    body: str


REVENUE = sum_text("item_total_value")
REPORTS = {
    "sales_revenue_over_time": Report(
        "sales",
        SALES,
        "purchase_month TIMESTAMP, revenue DOUBLE",
        f"SELECT date_trunc('month', order_purchase_timestamp), {REVENUE} FROM @rows GROUP BY 1",
    ),
    "sales_revenue_by_category": Report(
        "sales",
        SALES,
        "product_category_name STRING, revenue DOUBLE",
        f"""SELECT product_category_name, {REVENUE} FROM @rows
            WHERE product_category_name IS NOT NULL GROUP BY product_category_name""",
    ),
    "sales_revenue_by_seller_state": Report(
        "sales",
        SALES,
        "seller_state STRING, revenue DOUBLE",
        f"SELECT seller_state, {REVENUE} FROM @rows WHERE seller_state IS NOT NULL GROUP BY seller_state",
    ),
    "sales_by_seller": Report(
        "sales",
        SALES,
        "seller_id STRING, revenue DOUBLE, orders BIGINT",
        f"SELECT seller_id, {REVENUE}, count(DISTINCT order_id) FROM @rows GROUP BY seller_id",
    ),
    "sales_order_status_distribution": Report(
        "sales",
        SALES,
        "order_status STRING, order_count BIGINT",
        "SELECT order_status, count(DISTINCT order_id) FROM @rows GROUP BY order_status",
    ),
    "customer_count_by_state": Report(
        "customers",
        CUSTOMERS,
        "customer_state STRING, customer_count BIGINT",
        "SELECT customer_state, count(*) FROM @rows GROUP BY customer_state",
    ),
    "customer_spend_by_state": Report(
        "customers",
        CUSTOMERS,
        "customer_state STRING, total_spend DOUBLE",
        f"SELECT customer_state, {sum_text('total_spend')} FROM @rows GROUP BY customer_state",
    ),
    "delivery_status_distribution": Report(
        "deliveries",
        DELIVERIES,
        "delivery_timing STRING, order_count BIGINT, timing_order INT",
        f"""SELECT CASE signum(days_late) WHEN -1 THEN {literal(EARLY)} WHEN 0 THEN {literal(ON_TIME)}
                ELSE {literal(LATE)} END, count(*), CAST(signum(days_late) + 2 AS INT)
            FROM @rows WHERE days_late IS NOT NULL GROUP BY signum(days_late)""",
    ),
    "average_delivery_days_over_time": Report(
        "deliveries",
        DELIVERIES,
        "purchase_month TIMESTAMP, average_delivery_days DOUBLE",
        """SELECT date_trunc('month', order_purchase_timestamp), avg(delivery_days) FROM @rows
            WHERE delivery_days IS NOT NULL GROUP BY 1""",
    ),
}


def predicate(name: str, parameter: str) -> str:
    """Rows that a parameter lets through: all, where it is NULL or a list without a value."""
    given = f"{name}.{parameter}"
    if parameter in LISTED:
        # a list is searched as one text, which folds to a constant where no list is given
        kept = f"array_remove(split(concat_ws('\\u0001', {given}), ' *\\u0001 *| *$|^ *'), '')"
        return f"({given} IS NULL OR size({kept}) = 0 OR array_contains({kept}, {LISTED[parameter]}))"
    return f"({given} IS NULL OR {PREDICATES[parameter].replace('@', given)})"


def definition(name: str, report: Report, layer: str, stored: str, temporary: bool) -> str:
    where = " AND ".join(predicate(stored, p) for p in report.parameters)
    rows = f"(SELECT * FROM {layer}.{report.mart} WHERE {where})"
    listed = ", ".join(f"{p} {kind} DEFAULT NULL" for p, kind in report.parameters.items())
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    body = report.body.replace("@rows", rows)
    return f"CREATE OR REPLACE {kind} {stored}({listed}) RETURNS TABLE ({report.columns}) RETURN {body}"


def register(spark: SparkSession, layer: str = "gold", prefix: str = "", temporary: bool = True) -> list[str]:
    """Define all reports over a layer's marts, under their names with ``prefix`` before them.

    Temporary functions are the session's.  Others are kept in the current database: Spark looks
    for table functions there only, so a client says ``USE`` first.
    """
    for name, report in REPORTS.items():
        spark.sql(definition(name, report, layer, prefix + name, temporary))
    return [prefix + name for name in REPORTS]
