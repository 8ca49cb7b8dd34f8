from __future__ import annotations

from conftest import rows, ts

from tallymart.operators.integrity import repeated_persons
from tallymart.plans import gold as marts
from tallymart.plans import reports
from tallymart.plans.gold import GoldPlan
from tallymart.plans.silver import SilverPlan

HEX = "a" * 32


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_sales_keeps_every_item(tiny, tiny_gold):
    found = by(tiny_gold.sales, "order_id", "order_item_id")
    assert len(found) == tiny.order_items.count()
    assert found["o1", 2]["item_total_value"] == 21.75
    assert found["o1", 2]["product_category_name"] == ""
    assert found["o3", 1]["item_total_value"] is None
    orphan = found["o9", 1]
    assert orphan["customer_id"] is None and orphan["order_purchase_timestamp"] is None
    assert orphan["product_category_name"] == "toys" and orphan["seller_state"] is None


def test_customer_mart_is_per_person_and_address(tiny_gold):
    found = by(tiny_gold.customers, "customer_unique_id", "customer_state")
    first, second = found["u1", "SP"], found["u1", "RJ"]
    assert first["total_orders"] == 2 and first["total_items"] == 3
    assert first["total_product_value"] == 29.5 and first["total_freight_value"] == 3.25
    assert first["total_spend"] == 32.75
    assert first["average_order_value"] == 16.38  # 16.375, half up
    assert first["first_order_date"] == ts("2018-01-01")
    assert second["total_orders"] == 2 and second["total_spend"] == 113.0
    # Person figures repeat on each address: payments of o1, reviews of the hex order.
    assert first["total_payments"] == second["total_payments"] == 3
    assert first["total_reviews"] == second["total_reviews"] == 3
    # Mean of the order means: o1 has 3.0 and the hex order 4.5.
    assert first["average_review_score"] == 3.75


def test_customers_without_orders_or_items(tiny_gold):
    found = by(tiny_gold.customers, "customer_unique_id", "customer_state")
    idle = found["u3", "sp"]
    assert idle["total_orders"] == 0 and idle["total_items"] == 0
    assert idle["total_spend"] is None and idle["average_order_value"] is None
    assert idle["first_order_date"] is None and idle["total_payments"] is None
    without_items = found["u2", ""]
    assert without_items["total_orders"] == 1 and without_items["total_spend"] is None


def test_unknown_person_gets_no_engagement_figures(tiny_gold):
    unknown = by(tiny_gold.customers, "customer_unique_id", "customer_state")[None, None]
    assert unknown["total_orders"] == 1 and unknown["total_payments"] is None


def test_grain_checks(tiny_gold, tiny_silver):
    assert [tuple(r) for r in repeated_persons(tiny_gold.customers).collect()] == [("u1", 2)]
    persons = by(marts.customers(tiny_silver, grain="person"), "customer_unique_id")
    assert persons["u1",]["total_orders"] == 4
    assert persons["u1",]["customer_city"] == "rio"
    assert persons["u1",]["total_payments"] == 3


def test_repeated_customer_rows_follow_the_join(spark, tiny):
    """A customer row that occurs twice counts its items twice and its orders once."""
    from dataclasses import replace

    from tallymart.plans.silver import SilverPlan

    twice = SilverPlan(replace(tiny, customers=tiny.customers.unionAll(tiny.customers)))
    row = by(marts.customers(twice), "customer_unique_id", "customer_state")["u1", "SP"]
    assert row["total_orders"] == 2 and row["total_items"] == 6 and row["total_spend"] == 65.5


def test_deliveries_is_a_projection_of_orders(tiny, tiny_gold):
    assert tiny_gold.deliveries.count() == tiny.orders.count()
    assert len(tiny_gold.deliveries.columns) == 14


def test_unused_branches_leave_the_plan(tiny_gold):
    """Without payment and review columns the customer mart reads neither table."""
    plan = tiny_gold.customers.select("customer_state", "total_spend")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "payment" not in text and "review" not in text


class Parts:
    """Silver entities of which some are replaced."""

    def __init__(self, silver, **others):
        for entity in ("orders", "products", "sellers", "item_facts"):
            setattr(self, entity, others.get(entity, getattr(silver, entity)))


class SalesOnly:
    """The sales mart in the place of all three."""

    def __init__(self, gold):
        self.sales = self.customers = self.deliveries = gold.sales


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_parents_that_nothing_is_asked_from_are_not_joined(spark, tiny):
    silver = SilverPlan(tiny)
    keys = {"orders": "order_id", "products": "product_id", "sellers": "seller_id"}
    parts = Parts(silver, **{e: getattr(silver, e).dropDuplicates([k]) for e, k in keys.items()})
    twice = GoldPlan(Parts(parts, products=parts.products.unionAll(parts.products)))
    unasked = spark.createDataFrame([("", None), ("", "x")], "product_id string, product_category_name string")
    more = parts.products.unionByName(unasked, allowMissingColumns=True)  # no item has that key
    once = GoldPlan(Parts(parts, products=more))
    assert once.unique == {"order_id", "product_id", "seller_id"}
    assert twice.unique == {"order_id", "seller_id"}
    assert joins(reports.gold_table_counts(SalesOnly(once))) == 0
    assert joins(reports.overview_revenue_by_category(once)) == 1
    for gold in (once, twice):
        assert rows(gold.sales) == rows(marts.sales(gold._silver))
        assert rows(reports.sales_detail(gold, limit=50)) == rows(gold.sales.drop("customer_id"))
