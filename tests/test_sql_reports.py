"""Table functions against the Python reports; what their filters become in the plan."""

from __future__ import annotations

import pytest
from conftest import DATA, rows
from pyspark.errors import AnalysisException

from tallymart.checks import registry
from tallymart.operators.filters import CustomerFilter, DeliveryFilter, SalesFilter
from tallymart.plans import layers, reports, sql_reports


@pytest.fixture(scope="module")
def marts(spark):
    layer = registry.written(spark, DATA).gold
    return layer, layers.gold_tables(spark, layer)


@pytest.fixture()
def call(spark, marts):
    sql_reports.register(spark, marts[0], prefix="t_")
    return lambda text: spark.sql(f"SELECT * FROM t_{text}")


CASES = [
    ("sales_revenue_over_time(seller_states => array('SP', ' '))", reports.sales_revenue_over_time, SalesFilter(seller_states=["SP", " "])),
    ("sales_revenue_over_time(order_statuses => array(' ', NULL))", reports.sales_revenue_over_time, SalesFilter(order_statuses=[" ", None])),
    ("sales_revenue_by_seller_state(DATE'1995-05-05', DATE'1995-05-25')", reports.sales_revenue_by_seller_state, SalesFilter("1995-05-05", "1995-05-25")),
    ("sales_order_status_distribution(end_date => DATE'1992-01-01')", reports.sales_order_status_distribution, SalesFilter(end_date="1992-01-01")),
    ("customer_count_by_state(minimum_total_orders => 0)", reports.customer_count_by_state, CustomerFilter(minimum_total_orders=0)),
    ("customer_spend_by_state(array('RJ'))", reports.customer_spend_by_state, CustomerFilter(["RJ"])),
    ("delivery_status_distribution(start_date => DATE'1997-01-01')", reports.delivery_status_distribution, DeliveryFilter("1997-01-01")),
    ("average_delivery_days_over_time(order_statuses => array('delivered'))", reports.average_delivery_days_over_time, DeliveryFilter(order_statuses=["delivered"])),
]


@pytest.mark.parametrize("text, report, chosen", CASES)
def test_same_rows_as_the_report(marts, call, text, report, chosen):
    found, want = call(text), report(marts[1], chosen)
    assert found.columns == want.columns and rows(found) == rows(want)


def test_unset_parameters_leave_no_trace(call):
    plan = call("customer_count_by_state()")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan


def test_days_reach_the_scan_as_a_range(spark, call):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    found = call("delivery_status_distribution(DATE'1996-03-01', DATE'1996-03-31')")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp,1996-03-01" in plan
    assert "LessThan(order_purchase_timestamp,1996-04-01" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_parameters_are_typed(call):
    for wrong in ("sales_by_seller(start_date => 'no day')", "sales_by_seller(nothing => 1)", "customer_count_by_state('SP', 1, 2, 3)"):
        with pytest.raises(Exception) as found:
            call(wrong).collect()
        assert isinstance(found.value, AnalysisException) or "no day" in str(found.value)


def test_kept_functions(spark, marts):
    now = spark.catalog.currentDatabase()
    spark.sql(f"USE {marts[0]}")
    try:
        names = sql_reports.register(spark, marts[0], temporary=False)
        assert spark.sql(f"SELECT * FROM {names[0]}()").count() > 0
        assert spark.sql(f"SHOW USER FUNCTIONS IN {marts[0]}").count() >= len(names)
    finally:
        spark.sql(f"USE {now}")
