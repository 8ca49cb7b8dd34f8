"""Silver entities: trimmed, typed and flagged.  Every builder keeps all of its input rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import whole_days
from tallymart.operators import rules as r
from tallymart.operators.lookups import orphan, orphan_or_unknown, with_orphans, with_parent
from tallymart.operators.rules import Rule, apply_rules
from tallymart.sources.adapters import Bronze, BronzePlan

# Allowed domains.
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
REVIEW_SCORES = ["1", "2", "3", "4", "5"]
STATE_CODES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
ZIP_RANGE = (1000, 99999)
ID_PATTERN = "^[0-9a-f]{32}$"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Flag columns of each entity, in table order.
FLAGS: dict[str, tuple[str, ...]] = {
    "orders": (
        "is_valid_status",
        "approval_before_purchase",
        "carrier_before_approval",
        "customer_before_carrier",
        "has_timestamp_anomaly",
        "missing_delivery_timestamp",
        "missing_carrier_timestamp",
        "missing_estimated_delivery_date",
        "missing_order_id",
        "missing_customer_id",
    ),
    "order_items": (
        "missing_order_id",
        "missing_order_item_id",
        "missing_product_id",
        "missing_seller_id",
        "negative_price",
        "negative_freight_value",
        "invalid_order_reference",
        "invalid_product_reference",
        "invalid_seller_reference",
        "missing_shipping_limit_date",
        "shipping_limit_before_purchase",
    ),
    "customers": (
        "missing_customer_id",
        "missing_customer_unique_id",
        "missing_customer_zip_code",
        "missing_customer_city",
        "missing_customer_state",
        "invalid_customer_state",
        "invalid_customer_zip_code",
    ),
    "products": (
        "missing_product_category",
        "missing_product_name_length",
        "missing_product_description_length",
        "missing_product_photos_qty",
        "missing_product_weight",
        "missing_product_length",
        "missing_product_height",
        "missing_product_width",
        "non_positive_weight",
    ),
    "sellers": (
        "missing_seller_id",
        "missing_seller_zip_code",
        "missing_seller_city",
        "missing_seller_state",
        "invalid_seller_state",
        "invalid_seller_zip_code",
    ),
    "order_payments": (
        "missing_order_id",
        "missing_payment_sequential",
        "missing_payment_type",
        "missing_payment_installments",
        "missing_payment_value",
        "invalid_payment_type",
        "invalid_payment_installments",
        "negative_payment_value",
        "invalid_order_reference",
    ),
    "order_reviews": (
        "missing_review_id",
        "malformed_review_id",
        "missing_order_id",
        "malformed_order_id",
        "invalid_order_reference",
        "missing_review_score",
        "invalid_review_score",
        "missing_review_creation_timestamp",
        "invalid_review_creation_timestamp",
        "missing_review_answer_timestamp",
        "invalid_review_answer_timestamp",
        "answer_before_creation",
    ),
}

# Business key of each entity; reviews have none (one silver row per bronze row).
KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "customers": ("customer_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": (),
}

# Columns that hold ids, whatever the entity.
IDS = ("order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "review_id")


def trimmed(*names: str) -> list[Column]:
    return [F.expr(f"trim({name}) AS {name}") for name in names]


def order_rules() -> list[Rule]:
    purchase, approved = "order_purchase_timestamp", "order_approved_at"
    carrier, delivered = "order_delivered_carrier_date", "order_delivered_customer_date"
    disorder = [
        Rule("approval_before_purchase", r.before(approved, purchase)),
        Rule("carrier_before_approval", r.before(carrier, approved)),
        Rule("customer_before_carrier", r.before(delivered, carrier)),
    ]
    return [
        Rule("is_valid_status", r.in_domain("order_status", ORDER_STATUSES)),
        *disorder,
        Rule("has_timestamp_anomaly", r.any_of(rule.predicate for rule in disorder)),
        Rule("missing_delivery_timestamp", r.missing_when(delivered, "order_status", "delivered")),
        Rule("missing_carrier_timestamp", r.missing_when(carrier, "order_status", "delivered")),
        Rule("missing_estimated_delivery_date", r.missing("order_estimated_delivery_date")),
        Rule("missing_order_id", r.missing("order_id")),
        Rule("missing_customer_id", r.missing("customer_id")),
    ]


def orders(bronze_orders: DataFrame) -> DataFrame:
    standard = bronze_orders.select(
        *trimmed("order_id", "customer_id", "order_status"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return apply_rules(standard, order_rules()).withColumns(
        {
            "delivery_days": whole_days("order_purchase_timestamp", "order_delivered_customer_date"),
            "days_late": whole_days(
                "order_estimated_delivery_date", "order_delivered_customer_date"
            ),
        }
    )


def order_item_rules() -> list[Rule]:
    return [
        Rule("missing_order_id", r.missing("order_id")),
        Rule("missing_order_item_id", r.missing("order_item_id")),
        Rule("missing_product_id", r.missing("product_id")),
        Rule("missing_seller_id", r.missing("seller_id")),
        Rule("negative_price", r.negative("price")),
        Rule("negative_freight_value", r.negative("freight_value")),
        Rule("missing_shipping_limit_date", r.missing("shipping_limit_date")),
    ]


# Flags of an item that need the id of its product or seller.
ITEM_PARENT_FLAGS = ("missing_product_id", "missing_seller_id")


def item_facts(bronze_items: DataFrame) -> DataFrame:
    """The items without their flags."""
    return bronze_items.select(
        *trimmed("order_id"),
        "order_item_id",
        *trimmed("product_id", "seller_id"),
        "shipping_limit_date",
        "price",
        "freight_value",
    )


def order_items(
    bronze_items: DataFrame,
    silver_orders: DataFrame,
    bronze_products: DataFrame,
    bronze_sellers: DataFrame,
) -> DataFrame:
    """Parents are looked up by distinct key, so a duplicate parent cannot multiply items.

    The orders lookup brings the marker and the purchase time at once; where an
    order id occurs twice, the latest purchase time is the one compared.  It is the only one
    that shuffles the items: products and sellers are looked up by their orphans, before it, so
    that what is only asked whether a product or seller is known need not carry their ids.
    """
    standard = item_facts(bronze_items)
    with_product = with_orphans(standard, bronze_products, "product_id", "product_lost")
    with_seller = with_orphans(with_product, bronze_sellers, "seller_id", "seller_lost")
    named = apply_rules(
        with_seller,
        [
            *[rule for rule in order_item_rules() if rule.name in ITEM_PARENT_FLAGS],
            Rule("invalid_product_reference", "product_lost IS NOT NULL"),
            Rule("invalid_seller_reference", "seller_lost IS NOT NULL"),
        ],
    ).drop("product_lost", "seller_lost")
    with_order = with_parent(
        named,
        silver_orders,
        "order_id",
        marker="order_found",
        carry={"purchased_at": F.max("order_purchase_timestamp")},
        ids=IDS,
    )
    checked = apply_rules(
        with_order,
        [
            *[rule for rule in order_item_rules() if rule.name not in ITEM_PARENT_FLAGS],
            Rule("invalid_order_reference", orphan("order_id", "order_found")),
            Rule("shipping_limit_before_purchase", r.before("shipping_limit_date", "purchased_at")),
        ],
    )
    return checked.select(*standard.columns, *FLAGS["order_items"])


def customer_rules() -> list[Rule]:
    return [
        Rule("missing_customer_id", r.missing_or_blank("customer_id")),
        Rule("missing_customer_unique_id", r.missing_or_blank("customer_unique_id")),
        Rule("missing_customer_zip_code", r.missing("customer_zip_code_prefix")),
        Rule("missing_customer_city", r.missing_or_blank("customer_city")),
        Rule("missing_customer_state", r.missing_or_blank("customer_state")),
        Rule("invalid_customer_state", r.not_in_domain("customer_state", STATE_CODES)),
        Rule("invalid_customer_zip_code", r.out_of_range("customer_zip_code_prefix", *ZIP_RANGE)),
    ]


def customers(bronze_customers: DataFrame) -> DataFrame:
    standard = bronze_customers.select(
        *trimmed("customer_id", "customer_unique_id"),
        "customer_zip_code_prefix",
        *trimmed("customer_city", "customer_state"),
    )
    return apply_rules(standard, customer_rules())


def product_rules() -> list[Rule]:
    return [
        Rule("missing_product_category", r.missing_or_blank("product_category_name")),
        Rule("missing_product_name_length", r.missing("product_name_length")),
        Rule("missing_product_description_length", r.missing("product_description_length")),
        Rule("missing_product_photos_qty", r.missing("product_photos_qty")),
        Rule("missing_product_weight", r.missing("product_weight_g")),
        Rule("missing_product_length", r.missing("product_length_cm")),
        Rule("missing_product_height", r.missing("product_height_cm")),
        Rule("missing_product_width", r.missing("product_width_cm")),
        Rule("non_positive_weight", r.non_positive("product_weight_g")),
    ]


def products(bronze_products: DataFrame) -> DataFrame:
    standard = bronze_products.select(
        *trimmed("product_id", "product_category_name"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    return apply_rules(standard, product_rules())


def seller_rules() -> list[Rule]:
    return [
        Rule("missing_seller_id", r.missing_or_blank("seller_id")),
        Rule("missing_seller_zip_code", r.missing("seller_zip_code_prefix")),
        Rule("missing_seller_city", r.missing_or_blank("seller_city")),
        Rule("missing_seller_state", r.missing_or_blank("seller_state")),
        Rule("invalid_seller_state", r.not_in_domain("seller_state", STATE_CODES)),
        Rule("invalid_seller_zip_code", r.out_of_range("seller_zip_code_prefix", *ZIP_RANGE)),
    ]


def sellers(bronze_sellers: DataFrame) -> DataFrame:
    standard = bronze_sellers.select(
        *trimmed("seller_id"), "seller_zip_code_prefix", *trimmed("seller_city", "seller_state")
    )
    return apply_rules(standard, seller_rules())


def payment_rules() -> list[Rule]:
    return [
        Rule("missing_order_id", r.missing_or_blank("order_id")),
        Rule("missing_payment_sequential", r.missing("payment_sequential")),
        Rule("missing_payment_type", r.missing_or_blank("payment_type")),
        Rule("missing_payment_installments", r.missing("payment_installments")),
        Rule("missing_payment_value", r.missing("payment_value")),
        Rule("invalid_payment_type", r.not_in_domain("payment_type", PAYMENT_TYPES)),
        Rule("invalid_payment_installments", r.non_positive("payment_installments")),
        Rule("negative_payment_value", r.negative("payment_value")),
    ]


def order_payments(bronze_payments: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """The reference flag is NULL, not TRUE, for a payment without an order id."""
    standard = bronze_payments.select(
        *trimmed("order_id"),
        "payment_sequential",
        *trimmed("payment_type"),
        "payment_installments",
        "payment_value",
    )
    joined = with_parent(
        standard,
        silver_orders,
        "order_id",
        marker="order_found",
        ids=IDS,
    )
    reference = Rule("invalid_order_reference", orphan_or_unknown("order_id", "order_found"))
    checked = apply_rules(joined, [*payment_rules(), reference])
    return checked.select(*standard.columns, *FLAGS["order_payments"])


def review_rules() -> list[Rule]:
    return [
        Rule("missing_review_id", r.missing("review_id")),
        Rule("malformed_review_id", r.malformed("review_id", ID_PATTERN)),
        Rule("missing_order_id", r.missing("order_id")),
        Rule("malformed_order_id", r.malformed("order_id", ID_PATTERN)),
        Rule("missing_review_score", r.missing("review_score")),
        Rule("invalid_review_score", r.not_in_domain("review_score", REVIEW_SCORES)),
        Rule("missing_review_creation_timestamp", r.missing("review_creation_date")),
        Rule(
            "invalid_review_creation_timestamp",
            r.unparsable("review_creation_date", "review_creation_ts"),
        ),
        Rule("missing_review_answer_timestamp", r.missing("review_answer_timestamp")),
        Rule(
            "invalid_review_answer_timestamp",
            r.unparsable("review_answer_timestamp", "review_answer_ts"),
        ),
        Rule("answer_before_creation", r.before("review_answer_ts", "review_creation_ts")),
    ]


def typed_score(raw: str) -> Column:
    """1..5 as INT, NULL for any other text."""
    return F.when(F.col(raw).isin(REVIEW_SCORES), F.col(raw).cast("int"))


def parsed_timestamp(raw: str) -> Column:
    """NULL, not an error, for text in any other form."""
    return F.try_to_timestamp(F.col(raw), F.lit(TIMESTAMP_FORMAT))


def order_reviews(bronze_reviews: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """Raw text stays beside the typed columns; a malformed order id is no reference violation."""
    standard = bronze_reviews.select(
        *trimmed(
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        )
    )
    joined = with_parent(
        standard,
        silver_orders,
        "order_id",
        marker="order_found",
        ids=IDS,
    )
    known_form = f"order_id RLIKE {r.literal(ID_PATTERN)}"
    reference = Rule(
        "invalid_order_reference", f"{orphan('order_id', 'order_found')} AND {known_form}"
    )
    typed = joined.withColumns(
        {
            "review_score_int": typed_score("review_score"),
            "review_creation_ts": parsed_timestamp("review_creation_date"),
            "review_answer_ts": parsed_timestamp("review_answer_timestamp"),
        }
    )
    return apply_rules(typed, [*review_rules(), reference]).select(
        "review_id",
        "order_id",
        "review_score",
        "review_score_int",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
        "review_creation_ts",
        "review_answer_ts",
        *FLAGS["order_reviews"],
    )


@dataclass(frozen=True)
class Silver:
    """The seven entities as tables."""

    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame

    @property
    def item_facts(self) -> DataFrame:
        return self.order_items


class SilverPlan:
    """The seven entities as lazy plans over bronze, each built when it is first asked for."""

    def __init__(self, bronze: Bronze | BronzePlan) -> None:
        self._bronze = bronze

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self._bronze.orders)

    @cached_property
    def order_items(self) -> DataFrame:
        bronze = self._bronze
        return order_items(bronze.order_items, self.orders, bronze.products, bronze.sellers)

    @cached_property
    def item_facts(self) -> DataFrame:
        return item_facts(self._bronze.order_items)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self._bronze.customers)

    @cached_property
    def products(self) -> DataFrame:
        return products(self._bronze.products)

    @cached_property
    def sellers(self) -> DataFrame:
        return sellers(self._bronze.sellers)

    @cached_property
    def order_payments(self) -> DataFrame:
        return order_payments(self._bronze.order_payments, self.orders)

    @cached_property
    def order_reviews(self) -> DataFrame:
        return order_reviews(self._bronze.order_reviews, self.orders)
