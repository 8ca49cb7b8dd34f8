"""Every flag on hand-made rows: set, not set, NULL and blank input."""

from __future__ import annotations

import pytest
from conftest import rows

from tallymart.operators.rules import flagged_rows, summarise
from tallymart.plans.silver import FLAGS

HEX = "a" * 32


def flag_by(df, key, flag):
    return {r[0]: r[1] for r in df.select(key, flag).collect()}


@pytest.mark.parametrize(
    "flag, expected",
    [
        ("is_valid_status", {"o1": True, "o2": True, "o3": False, "o4": False, None: True}),
        ("approval_before_purchase", {"o1": False, "o2": True, "o3": False, None: False}),
        ("carrier_before_approval", {"o1": False, "o3": False, "o4": True}),
        ("customer_before_carrier", {"o1": False, "o2": False, "o4": True}),
        ("has_timestamp_anomaly", {"o1": False, "o2": True, "o3": False, "o4": True}),
        ("missing_delivery_timestamp", {"o1": False, "o2": True, "o3": None, "o4": False, "o5": False}),
        ("missing_carrier_timestamp", {"o1": False, "o2": True, "o3": None, "o4": False}),
        ("missing_estimated_delivery_date", {"o1": False, "o3": True, None: True}),
        ("missing_order_id", {"o1": False, "": False, None: True}),
        ("missing_customer_id", {"o1": False, None: True}),
        ("delivery_days", {"o1": 9, "o2": None, "o4": 2, HEX: 8}),
        # 23 hours late is day 0; 22 hours late likewise; 25 hours early is -1.
        ("days_late", {"o1": 0, "o2": None, "o4": 0, HEX: -1}),
    ],
)
def test_orders(tiny_silver, flag, expected):
    found = flag_by(tiny_silver.orders, "order_id", flag)
    assert {k: found[k] for k in expected} == expected


@pytest.mark.parametrize(
    "flag, expected",
    [
        ("missing_order_id", {("o1", 1): False, (None, None): True}),
        ("missing_order_item_id", {("o1", 1): False, (None, None): True}),
        ("missing_product_id", {("o1", 1): False, ("o3", 1): True}),
        ("missing_seller_id", {("o1", 1): False, ("o9", 1): True}),
        ("negative_price", {("o1", 1): False, ("o2", 1): True, ("o3", 1): False}),
        ("negative_freight_value", {("o1", 1): False, ("o9", 1): True}),
        ("invalid_order_reference", {("o1", 1): False, ("o9", 1): True, (None, None): False}),
        ("invalid_product_reference", {("o1", 1): False, ("o1", 2): False, ("o2", 1): True, ("o3", 1): False}),
        ("invalid_seller_reference", {("o1", 2): False, ("o3", 1): True, ("o9", 1): False}),
        ("missing_shipping_limit_date", {("o1", 1): False, ("o2", 1): True}),
        ("shipping_limit_before_purchase", {("o1", 1): False, ("o1", 2): True, ("o2", 1): False, ("o9", 1): False}),
    ],
)
def test_order_items(tiny_silver, flag, expected):
    df = tiny_silver.order_items.select("order_id", "order_item_id", flag)
    found = {(r[0], r[1]): r[2] for r in df.collect()}
    assert {k: found[k] for k in expected} == expected


@pytest.mark.parametrize(
    "flag, expected",
    [
        ("missing_customer_id", {"c1": False, "": True, None: True}),
        ("missing_customer_unique_id", {"c1": False, "c4": True, "": True}),
        ("missing_customer_zip_code", {"c1": False, "c5": True}),
        ("missing_customer_city", {"c1": False, "c3": True, "c4": True}),
        ("missing_customer_state", {"c1": False, "c3": True, "c4": True}),
        # A blank state is both missing and invalid; a NULL one only missing.
        ("invalid_customer_state", {"c1": False, "c3": True, "c4": False, "c5": True, "": False}),
        ("invalid_customer_zip_code", {"c1": True, "c2": False, "c3": False, "c4": True, "c5": False}),
    ],
)
def test_customers(tiny_silver, flag, expected):
    found = flag_by(tiny_silver.customers, "customer_id", flag)
    assert {k: found[k] for k in expected} == expected


@pytest.mark.parametrize(
    "flag, expected",
    [
        ("missing_product_category", {"p1": False, "p2": True, "p3": True}),
        *[
            (f"missing_product_{name}", {"p1": False, "p2": False, "p3": True})
            for name in ("name_length", "description_length", "photos_qty", "weight", "length", "height", "width")
        ],
        ("non_positive_weight", {"p1": True, "p2": True, "p3": False}),
    ],
)
def test_products(tiny_silver, flag, expected):
    assert flag_by(tiny_silver.products, "product_id", flag) == expected


@pytest.mark.parametrize(
    "flag, expected",
    [
        ("missing_seller_id", {"s1": False, "": True, None: True}),
        ("missing_seller_zip_code", {"s1": False, "": True}),
        ("missing_seller_city", {"s1": False, "s2": True, "": True}),
        ("missing_seller_state", {"s1": False, "": True, None: True}),
        ("invalid_seller_state", {"s1": False, "s2": True, "": True, None: False}),
        ("invalid_seller_zip_code", {"s1": False, "s2": True, "": False, None: True}),
    ],
)
def test_sellers(tiny_silver, flag, expected):
    found = flag_by(tiny_silver.sellers, "seller_id", flag)
    assert {k: found[k] for k in expected} == expected


def test_payments(tiny_silver):
    df = tiny_silver.order_payments
    assert summarise(df, FLAGS["order_payments"]).first().asDict() == {
        "missing_order_id": 2,
        "missing_payment_sequential": 1,
        "missing_payment_type": 2,
        "missing_payment_installments": 1,
        "missing_payment_value": 1,
        "invalid_payment_type": 2,
        "invalid_payment_installments": 1,
        "negative_payment_value": 1,
        "invalid_order_reference": 1,
    }
    # Unknown order id: the reference flag is NULL.  A blank id has a blank parent here.
    found = flag_by(df, "order_id", "invalid_order_reference")
    assert found == {"o1": False, "o9": True, None: None, "": False}


def test_reviews(tiny_silver):
    df = tiny_silver.order_reviews
    assert summarise(df, FLAGS["order_reviews"]).first().asDict() == {
        "missing_review_id": 1,
        "malformed_review_id": 2,
        "missing_order_id": 1,
        "malformed_order_id": 2,
        "invalid_order_reference": 1,
        "missing_review_score": 1,
        "invalid_review_score": 2,
        "missing_review_creation_timestamp": 1,
        "invalid_review_creation_timestamp": 3,
        "missing_review_answer_timestamp": 1,
        "invalid_review_answer_timestamp": 1,
        "answer_before_creation": 1,
    }
    assert sorted(r[0] for r in df.select("review_score_int").dropna().collect()) == [3, 4, 5]
    assert len(df.columns) == 22
    # The malformed order id "o1" exists as an order and still is no reference violation.
    assert flag_by(df, "order_id", "invalid_order_reference")["o1"] is False


def test_no_entity_loses_or_adds_rows(tiny, tiny_silver):
    for entity in FLAGS:
        assert getattr(tiny_silver, entity).count() == getattr(tiny, entity).count(), entity


def test_trim_takes_spaces_only(spark):
    from tallymart.plans.silver import trimmed

    df = spark.createDataFrame([("  x ",), ("\ty",)], "v string").select(*trimmed("v"))
    assert rows(df) == [("\ty",), ("x",)]


def test_duplicate_parent_does_not_multiply_items(tiny):
    from tallymart.plans import silver

    twice = silver.orders(tiny.orders.unionAll(tiny.orders))
    items = silver.order_items(
        tiny.order_items, twice, tiny.products.unionAll(tiny.products), tiny.sellers
    )
    assert items.count() == tiny.order_items.count()


def test_summary_of_no_rows_is_zero(tiny_silver):
    empty = tiny_silver.customers.filter("false")
    assert set(summarise(empty, FLAGS["customers"]).first()) == {0}


def test_flagged_rows_treats_null_as_not_flagged(tiny_silver):
    found = flagged_rows(
        tiny_silver.orders, ["missing_delivery_timestamp", "missing_carrier_timestamp"]
    )
    assert [r["order_id"] for r in found.collect()] == ["o2"]
