"""Gold marts: sales (order item), customers (person and address) and deliveries (order)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import exact_sum, rounded_ratio
from tallymart.operators.lookups import one_per_key, split_join, unique_parents
from tallymart.plans.silver import Silver, SilverPlan

PERSON = "customer_unique_id"
PERSON_ADDRESS = [PERSON, "customer_city", "customer_state"]


def sales_parents(silver: Silver | SilverPlan) -> dict[str, DataFrame]:
    """What the sales mart adds to an item, by the key that it is found with."""
    return {
        "order_id": silver.orders.select(
            "order_id", "customer_id", "order_purchase_timestamp", "order_status"
        ),
        "product_id": silver.products.select("product_id", "product_category_name"),
        "seller_id": silver.sellers.select("seller_id", "seller_state"),
    }


def sales(
    silver: Silver | SilverPlan,
    unique: Iterable[str] = (),
    lookups: Iterable[str] = ("order_id", "product_id", "seller_id"),
) -> DataFrame:
    """Items drive; orders, products and sellers only add attributes (NULL where unknown).

    A parent whose key is known to be ``unique`` is looked up so that the join, and the shuffle of
    all items for it, goes where none of its attributes is asked for.  ``lookups`` is the order of the joins: a
    filter on orders spares the later ones rows if orders come first; what orders add is shuffled
    least if they come last.  The rows are the same.
    """
    wide = silver.item_facts.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )
    parents = sales_parents(silver)
    for key in lookups:
        parent = parents[key]
        if key in unique:
            wide = split_join(wide, one_per_key(parent, key), key)
        else:
            wide = wide.join(parent, key, "left")
    return wide.select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_purchase_timestamp",
        "order_status",
        "product_category_name",
        "seller_state",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total_value"),
    )


def _item_totals(silver: Silver | SilverPlan) -> DataFrame:
    return silver.item_facts.groupBy("order_id").agg(
        F.count("order_item_id").alias("items"),
        exact_sum("price").alias("product_value"),
        exact_sum("freight_value").alias("freight"),
    )


def _payment_counts(silver: Silver | SilverPlan) -> DataFrame:
    return silver.order_payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("payments"))


def _review_scores(silver: Silver | SilverPlan) -> DataFrame:
    """Valid scores only; the mean of an order is rounded before it enters the person's mean."""
    return (
        silver.order_reviews.filter(F.col("review_score_int").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.round(F.avg("review_score_int"), 2).alias("score"),
        )
    )


def _per_customer_order(silver: Silver | SilverPlan) -> DataFrame:
    """One row per (customer, order) plus one order-less row per customer.

    The order-less rows keep customers without orders and have no effect on the
    aggregates of the others, so the join itself can be an inner one: that lets
    the order side, where one customer may hold most rows, be split.  Order
    facts are aggregated to one row per order, whose partitioning the joins use
    again; facts of which no column is asked for are dropped with their scans.
    """
    base = ["order_id", "customer_id", "order_purchase_timestamp"]
    orders = reduce(
        lambda left, facts: left.join(facts, "order_id", "left"),
        [_item_totals(silver), _payment_counts(silver), _review_scores(silver)],
        silver.orders.select(*base),
    )
    customers = silver.customers.select("customer_id", *PERSON_ADDRESS)
    return orders.join(customers, "customer_id").unionByName(customers, allowMissingColumns=True)


def _customer_metrics(orders: DataFrame, group: list[str], *extra: Column) -> DataFrame:
    totals = orders.groupBy(*group).agg(
        *extra,
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"),
        exact_sum("product_value").alias("total_product_value"),
        exact_sum("freight").alias("total_freight_value"),
        exact_sum("product_value", "freight").alias("total_spend"),
        F.sum("payments").alias("payments"),
        F.sum("reviews").alias("reviews"),
        F.sum(F.rint(F.col("score") * 100).cast("bigint")).alias("score_cents"),
        F.count("score").alias("scores"),
    )
    # A group without orders has no spend: NULL instead of a division by zero.
    average = rounded_ratio(F.col("total_spend"), F.col("total_orders"))
    return totals.withColumn("average_order_value", average)


def customers(silver: Silver | SilverPlan, grain: str = "address") -> DataFrame:
    """Customer mart.

    ``grain="address"`` (default): one row per person, city and state; payment and
    review figures are those of the person and repeat on each address row.
    ``grain="person"``: one row per person, with the first city and state in
    alphabetical order.  A row without person has no payment and review figures.

    Orders are read once.  The person's figures are sums over the few address rows
    of a person; rows without person, which may be many, do not meet in one task.
    """
    bought = _per_customer_order(silver)
    if grain == "address":
        metrics = _customer_metrics(bought, PERSON_ADDRESS)
    elif grain == "person":
        home = F.min(F.struct("customer_city", "customer_state")).alias("home")
        metrics = _customer_metrics(bought, [PERSON], home).select("*", "home.*").drop("home")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    apart = F.when(F.col(PERSON).isNull(), F.struct("customer_city", "customer_state"))
    person = Window.partitionBy(PERSON, apart)

    def of_person(name: str) -> Column:
        return F.when(F.col(PERSON).isNotNull(), F.sum(name).over(person))

    combined = metrics.withColumns(
        {
            "total_payments": of_person("payments"),
            "total_reviews": of_person("reviews"),
            "average_review_score": rounded_ratio(of_person("score_cents") / 100, of_person("scores")),
        }
    )
    return combined.select(
        *PERSON_ADDRESS,
        "first_order_date",
        "last_order_date",
        "total_orders",
        "total_items",
        "total_product_value",
        "total_freight_value",
        "total_spend",
        "average_order_value",
        "total_payments",
        "total_reviews",
        "average_review_score",
    )


def deliveries(silver: Silver | SilverPlan) -> DataFrame:
    """Delivery columns of the orders; no join, no aggregation."""
    return silver.orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "delivery_days",
        "days_late",
        "has_timestamp_anomaly",
        "missing_delivery_timestamp",
        "missing_carrier_timestamp",
        "missing_estimated_delivery_date",
    )


@dataclass(frozen=True)
class Gold:
    """The three marts as tables."""

    sales: DataFrame
    customers: DataFrame
    deliveries: DataFrame

    @property
    def late(self) -> dict[str, DataFrame]:
        """Parents of the sales mart whose attributes are better looked up for chosen rows: none, they are stored."""
        return {}


class GoldPlan:
    """The marts as lazy plans over the silver entities, each built when it is first asked for."""

    def __init__(self, silver: Silver | SilverPlan) -> None:
        self._silver = silver

    @cached_property
    def sales(self) -> DataFrame:
        return sales(self._silver, self.unique)

    @cached_property
    def unique(self) -> set[str]:
        """Keys with which no item finds two parents; the keys are read for it."""
        return unique_parents(self._silver.item_facts, sales_parents(self._silver))

    @cached_property
    def late(self) -> dict[str, DataFrame]:
        """Products and sellers, one row per key, by their key, where no item finds two."""
        keys = ("product_id", "seller_id")
        if not self.unique.issuperset(keys):
            return {}
        parents = sales_parents(self._silver)
        return {key: one_per_key(parents[key], key) for key in keys}

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self._silver)

    @cached_property
    def deliveries(self) -> DataFrame:
        return deliveries(self._silver)
