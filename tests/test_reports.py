from __future__ import annotations

import pytest
from conftest import rows, ts

from tallymart.operators.filters import CustomerFilter, DeliveryFilter, SalesFilter
from tallymart.plans import reports as r
from tallymart.plans.gold import Gold


@pytest.fixture(scope="module")
def empty(tiny_gold):
    return Gold(
        *[df.filter("false") for df in (tiny_gold.sales, tiny_gold.customers, tiny_gold.deliveries)]
    )


def test_no_rows_counts_are_zero_and_flag_sums_null(empty):
    assert tuple(r.sales_kpis(empty).first()) == (0.0, 0, 0, 0.0, 0.0, 0.0)
    assert tuple(r.overview_kpis(empty).first()) == (0.0, 0, 0, 0, 0.0, 0.0)
    assert tuple(r.customer_kpis(empty).first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert tuple(r.delivery_kpis(empty).first()) == (0, 0.0, None, 0.0, None, None, None)
    assert set(r.delivery_quality_flags(empty).first()) == {None}
    assert tuple(r.overview_uncategorized_sales(empty).first()) == (0, 0, 0.0)
    assert tuple(r.quality_indicators(empty).first()) == (None, None, None, None, None, 0)
    assert rows(r.gold_table_counts(empty)) == [("customers", 0), ("deliveries", 0), ("sales", 0)]
    assert {row["null_count"] for row in r.gold_null_counts(empty).collect()} == {None}
    assert r.sales_detail(empty).count() == 0


def test_kpis_agree_with_the_grouped_reports(tiny_gold):
    kpis = r.sales_kpis(tiny_gold).first()
    months = r.sales_revenue_over_time(tiny_gold).collect()
    assert sum(m["revenue"] or 0 for m in months) == pytest.approx(kpis["revenue"])
    assert kpis["items"] == tiny_gold.sales.count()
    assert months[0]["purchase_month"] is None  # items of unknown orders keep a month of their own
    customers = r.customer_kpis(tiny_gold).first()
    states = r.customer_count_by_state(tiny_gold).collect()
    assert sum(s["customer_count"] for s in states) == customers["total_customers"] == 7
    assert r.new_customers_over_time(tiny_gold).count() == 4
    delivery = r.delivery_kpis(tiny_gold).first()
    timing = {row["delivery_timing"]: row["order_count"] for row in r.delivery_status_distribution(tiny_gold).collect()}
    assert timing == {"On time": delivery["on_time_orders"], "Early": delivery["early_orders"]}
    assert delivery["late_orders"] == 0


def test_order_value_is_averaged_over_orders(tiny_gold):
    kpis = r.sales_kpis(tiny_gold, SalesFilter(order_statuses=["delivered"])).first()
    # o1: 10 + 21.75, o2: 1, the hex order: 110.
    assert kpis["revenue"] == 142.75 and kpis["orders"] == 3 and kpis["items"] == 4
    assert kpis["average_order_value"] == pytest.approx(142.75 / 3)
    assert kpis["average_item_value"] == pytest.approx(142.75 / 4)


def test_category_filter_contradicts_uncategorized(tiny_gold):
    assert r.sales_uncategorized_summary(tiny_gold).first()["uncategorized_items"] == 2
    chosen = SalesFilter(product_categories=["toys"])
    assert tuple(r.sales_uncategorized_summary(tiny_gold, chosen).first()) == (0, 0, 0.0)


def test_unknown_spend_lands_in_the_open_band(tiny_gold):
    bands = {b["spend_bucket"]: b["customer_count"] for b in r.customer_spending_distribution(tiny_gold).collect()}
    assert bands["2,000+"] == 5
    zero = CustomerFilter(minimum_total_spend=0)
    assert "2,000+" not in {b["spend_bucket"] for b in r.customer_spending_distribution(tiny_gold, zero).collect()}


def test_an_order_of_several_seller_states_counts_in_each(spark, tiny_gold):
    found = {row["seller_state"]: row for row in r.average_days_late_by_seller_state(tiny_gold).collect()}
    assert found["RJ"]["order_seller_pairs"] == 2 and found["RJ"]["average_days_late"] == -0.5
    assert found["xx"]["order_seller_pairs"] == 1
    only = r.average_days_late_by_seller_state(tiny_gold, DeliveryFilter("2018-04-01", "2018-04-01"))
    assert [tuple(row) for row in only.collect()] == [("RJ", -1.0, 1)]


def test_late_orders_are_counted_in_the_month_of_delivery(spark, tiny_gold):
    late = spark.createDataFrame(
        [("x", ts("2018-01-30"), ts("2018-02-02"), 3), ("y", ts("2018-01-01"), None, 3), ("z", ts("2018-01-01"), ts("2018-02-01"), 0)],
        "order_id string, order_purchase_timestamp timestamp, order_delivered_customer_date timestamp, days_late bigint",
    )
    gold = Gold(tiny_gold.sales, tiny_gold.customers, late)
    assert rows(r.late_orders_by_month(gold)) == [(ts("2018-02-01"), 1)]


def test_pages_of_the_detail_reports_add_up(tiny_gold):
    whole = r.sales_detail(tiny_gold, limit=100).collect()
    parts = [row for o in range(0, 9, 3) for row in r.sales_detail(tiny_gold, limit=3, offset=o).collect()]
    assert parts == whole and len(whole) == 7 and len(whole[0]) == 11
    whole = r.customer_detail(tiny_gold, limit=100).collect()
    parts = [row for o in range(0, 9, 2) for row in r.customer_detail(tiny_gold, limit=2, offset=o).collect()]
    assert parts == whole and len(whole) == 7 and len(whole[0]) == 11


def test_filter_options(tiny_gold):
    lists = r.option_lists(r.sales_filter_options(tiny_gold))
    assert lists == {
        "order_statuses": ["delivered"],
        "product_categories": ["", "toys"],
        "seller_states": ["RJ", "xx"],
    }
    assert r.option_lists(r.customer_filter_options(tiny_gold)) == {"customer_states": ["", "RJ", "SP", "sp"]}


def test_band_labels(tiny_gold):
    labelled = r.delivery_band_labels(r.delivery_time_distribution(tiny_gold)).collect()
    assert [row["delivery_band"] for row in labelled] == ["2-3 days", "8-9 days"]
