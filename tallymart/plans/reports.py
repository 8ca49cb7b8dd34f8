"""The fixed set of reports over the gold marts.

Each function takes the marts and a filter and returns a DataFrame; the caller
decides when to run it.  Rankings carry the group key as a tie-breaker, so that
a limit always cuts at the same place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import (
    delivery_timing,
    exact_avg,
    exact_sum,
    spend_band,
    two_day_bucket,
)
from tallymart.operators.filters import CustomerFilter, DeliveryFilter, SalesFilter
from tallymart.operators.lookups import split_join
from tallymart.operators.paging import asc, desc, page, top
from tallymart.plans.gold import Gold, GoldPlan

Marts = Gold | GoldPlan

ALL_SALES, ALL_CUSTOMERS, ALL_DELIVERIES = SalesFilter(), CustomerFilter(), DeliveryFilter()


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _month(column: str) -> Column:
    return F.date_trunc("month", F.col(column))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _ones(test: Column) -> Column:
    """Rows that meet the test; NULL, not 0, when there are no rows at all."""
    return F.sum(F.when(test, 1).otherwise(0))


def _day_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.to_date(F.min("order_purchase_timestamp")).alias("min_date"),
        F.to_date(F.max("order_purchase_timestamp")).alias("max_date"),
    )


def _options(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct non-NULL values of several columns in long form (filter_name, value).

    One scan: rows are first reduced to the distinct combinations of the columns.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("filter_name"), F.col(column).alias("value"))
            for column, name in columns.items()
        ]
    )
    return (
        df.select(*columns)
        .distinct()
        .select(F.explode(pairs).alias("option"))
        .select("option.*")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter_name", "value")
    )


def option_lists(options: DataFrame) -> dict[str, list[str]]:
    """The options as one sorted list per filter, for a client; the long form is the scalable one."""
    lists: dict[str, list[str]] = {}
    for row in options.toLocalIterator():
        lists.setdefault(row["filter_name"], []).append(row["value"])
    return lists


# --- sales -----------------------------------------------------------------


def _sales(gold: Marts, chosen: SalesFilter) -> DataFrame:
    return gold.sales.filter(chosen.predicate())


def _revenue() -> Column:
    return exact_sum("item_total_value").alias("revenue")


def _per_order(sales: DataFrame) -> DataFrame:
    """Order totals with the item figures carried along, so one pass serves both grains."""
    return sales.groupBy("order_id").agg(
        exact_sum("item_total_value").alias("order_total"),
        exact_sum("freight_value").alias("order_freight"),
        _rows("order_items"),
        F.count("item_total_value").alias("valued_items"),
    )


def _revenue_by_month(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(_month("order_purchase_timestamp").alias("purchase_month"))
        .agg(_revenue())
        .orderBy("purchase_month")
    )


def _revenue_by_category(sales: DataFrame, limit: int) -> DataFrame:
    known = sales.filter(F.col("product_category_name").isNotNull())
    ranked = known.groupBy("product_category_name").agg(_revenue())
    return top(ranked, limit, F.desc_nulls_last("revenue"), F.asc("product_category_name"))


def _uncategorized(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("product_category_name").isNull()).agg(
        _rows("uncategorized_items"),
        F.count_distinct("order_id").alias("affected_orders"),
        _or_zero(exact_sum("item_total_value")).alias("uncategorized_revenue"),
    )


def _orders_by_status(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("order_status")
        .agg(F.count_distinct("order_id").alias("order_count"))
        .orderBy(F.desc("order_count"), F.asc("order_status"))
    )


def _revenue_by_seller_state(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(F.col("seller_state").isNotNull())
        .groupBy("seller_state")
        .agg(_revenue())
        .orderBy(F.desc_nulls_last("revenue"), F.asc("seller_state"))
    )


def sales_date_bounds(gold: Marts) -> DataFrame:
    return _day_bounds(gold.sales)


def sales_filter_options(gold: Marts) -> DataFrame:
    return _options(
        gold.sales,
        {
            "order_status": "order_statuses",
            "seller_state": "seller_states",
            "product_category_name": "product_categories",
        },
    )


def overview_kpis(gold: Marts) -> DataFrame:
    customers = gold.customers.agg(_rows("n"))
    delivery = gold.deliveries.agg(_or_zero(F.avg("delivery_days")).alias("days"))
    return (
        _per_order(gold.sales)
        .agg(
            _or_zero(exact_sum("order_total")).alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
            F.coalesce(F.sum("order_items"), F.lit(0)).alias("total_items"),
            _or_zero(exact_avg("order_total")).alias("average_order_value"),
        )
        .select(
            "total_revenue",
            "total_orders",
            "total_items",
            customers.scalar().alias("total_customers"),
            "average_order_value",
            delivery.scalar().alias("average_delivery_days"),
        )
    )


def overview_revenue_over_time(gold: Marts) -> DataFrame:
    return _revenue_by_month(gold.sales)


def overview_revenue_by_category(gold: Marts, limit: int = 10) -> DataFrame:
    return _revenue_by_category(gold.sales, limit)


def overview_uncategorized_sales(gold: Marts) -> DataFrame:
    return _uncategorized(gold.sales)


def overview_orders_by_status(gold: Marts) -> DataFrame:
    return _orders_by_status(gold.sales)


def overview_revenue_by_seller_state(gold: Marts) -> DataFrame:
    return _revenue_by_seller_state(gold.sales)


def sales_kpis(gold: Marts, chosen: SalesFilter = ALL_SALES) -> DataFrame:
    return (
        _per_order(_sales(gold, chosen))
        .agg(
            _or_zero(exact_sum("order_total")).alias("revenue"),
            F.count("order_id").alias("orders"),
            F.coalesce(F.sum("order_items"), F.lit(0)).alias("items"),
            _or_zero(exact_avg("order_total")).alias("average_order_value"),
            F.sum("valued_items").alias("valued_items"),
            _or_zero(exact_sum("order_freight")).alias("freight_revenue"),
        )
        .select(
            "revenue",
            "orders",
            "items",
            "average_order_value",
            _or_zero(F.try_divide("revenue", "valued_items")).alias("average_item_value"),
            "freight_revenue",
        )
    )


def sales_revenue_over_time(gold: Marts, chosen: SalesFilter = ALL_SALES) -> DataFrame:
    return _revenue_by_month(_sales(gold, chosen))


def sales_revenue_by_category(
    gold: Marts, chosen: SalesFilter = ALL_SALES, limit: int = 15
) -> DataFrame:
    return _revenue_by_category(_sales(gold, chosen), limit)


def sales_uncategorized_summary(gold: Marts, chosen: SalesFilter = ALL_SALES) -> DataFrame:
    """A category filter contradicts "no category": the counts are then 0."""
    return _uncategorized(_sales(gold, chosen))


def sales_revenue_by_seller_state(gold: Marts, chosen: SalesFilter = ALL_SALES) -> DataFrame:
    return _revenue_by_seller_state(_sales(gold, chosen))


def sales_top_sellers(gold: Marts, chosen: SalesFilter = ALL_SALES, limit: int = 10) -> DataFrame:
    ranked = (
        _sales(gold, chosen)
        .groupBy("seller_id")
        .agg(_revenue(), F.count_distinct("order_id").alias("orders"))
    )
    return top(ranked, limit, F.desc_nulls_last("revenue"), F.asc("seller_id"))


def sales_order_status_distribution(gold: Marts, chosen: SalesFilter = ALL_SALES) -> DataFrame:
    return _orders_by_status(_sales(gold, chosen))


def sales_detail(
    gold: Marts, chosen: SalesFilter = ALL_SALES, limit: int = 25, offset: int = 0
) -> DataFrame:
    """Attributes of products and sellers, which the order does not ask for, are looked up for
    the page's rows only, where that cannot change their number."""
    rows = _sales(gold, chosen).drop("customer_id")
    order = [
        desc("order_purchase_timestamp"),
        *[
            asc(name)
            for name in (
                "order_id",
                "order_item_id",
                "product_id",
                "seller_id",
                "price",
                "freight_value",
            )
        ],
    ]
    late = gold.late
    attributes = [c for key, parent in late.items() for c in parent.columns if c != key]
    found = page(rows.drop(*attributes), limit, offset, *order)
    if not late:
        return found
    for key, parent in late.items():
        found = split_join(found, parent, key)
    return found.select(*rows.columns).orderBy(*[key.column() for key in order])


# --- customers -------------------------------------------------------------


def _customers(gold: Marts, chosen: CustomerFilter) -> DataFrame:
    return gold.customers.filter(chosen.predicate())


def customer_filter_options(gold: Marts) -> DataFrame:
    return _options(gold.customers, {"customer_state": "customer_states"})


def customer_kpis(gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS) -> DataFrame:
    return _customers(gold, chosen).agg(
        _rows("total_customers"),
        _or_zero(exact_sum("total_spend")).alias("total_customer_spend"),
        _or_zero(exact_avg("total_spend")).alias("average_customer_spend"),
        _or_zero(F.avg("total_orders")).alias("average_orders_per_customer"),
        _or_zero(exact_avg("average_order_value")).alias("average_customer_order_value"),
        _or_zero(exact_avg("average_review_score")).alias("average_review_score"),
    )


def customer_count_by_state(gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS) -> DataFrame:
    return (
        _customers(gold, chosen)
        .groupBy("customer_state")
        .agg(_rows("customer_count"))
        .orderBy(F.desc("customer_count"), F.asc("customer_state"))
    )


def customer_spend_by_state(gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS) -> DataFrame:
    return (
        _customers(gold, chosen)
        .groupBy("customer_state")
        .agg(exact_sum("total_spend").alias("total_spend"))
        .orderBy(F.desc_nulls_last("total_spend"), F.asc("customer_state"))
    )


def customer_order_frequency_distribution(
    gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS
) -> DataFrame:
    return (
        _customers(gold, chosen)
        .groupBy("total_orders")
        .agg(_rows("customer_count"))
        .orderBy("total_orders")
    )


def customer_spending_distribution(
    gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS
) -> DataFrame:
    label, ordinal = spend_band(F.col("total_spend"))
    return (
        _customers(gold, chosen)
        .groupBy(label.alias("spend_bucket"), ordinal.alias("bucket_order"))
        .agg(_rows("customer_count"))
        .select("spend_bucket", "customer_count", "bucket_order")
        .orderBy("bucket_order")
    )


def new_customers_over_time(gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS) -> DataFrame:
    return (
        _customers(gold, chosen)
        .filter(F.col("first_order_date").isNotNull())
        .groupBy(_month("first_order_date").alias("first_order_month"))
        .agg(_rows("new_customers"))
        .orderBy("first_order_month")
    )


def customer_detail(
    gold: Marts, chosen: CustomerFilter = ALL_CUSTOMERS, limit: int = 25, offset: int = 0
) -> DataFrame:
    rows = _customers(gold, chosen).drop(
        "total_product_value", "total_freight_value", "total_payments"
    )
    return page(
        rows,
        limit,
        offset,
        desc("total_spend"),
        desc("total_orders"),
        *[asc(name) for name in ("customer_unique_id", "customer_city", "customer_state")],
    )


# --- deliveries ------------------------------------------------------------


def _deliveries(gold: Marts, chosen: DeliveryFilter) -> DataFrame:
    return gold.deliveries.filter(chosen.predicate())


def delivery_date_bounds(gold: Marts) -> DataFrame:
    return _day_bounds(gold.deliveries)


def delivery_filter_options(gold: Marts) -> DataFrame:
    return _options(gold.deliveries, {"order_status": "order_statuses"})


def delivery_kpis(gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES) -> DataFrame:
    late = F.col("days_late")
    return _deliveries(gold, chosen).agg(
        _rows("total_orders"),
        _or_zero(F.avg("delivery_days")).alias("average_delivery_days"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY delivery_days)")
        .cast("bigint")
        .alias("median_delivery_days"),
        _or_zero(F.avg("days_late")).alias("average_days_late"),
        _ones(late > 0).alias("late_orders"),
        _ones(late == 0).alias("on_time_orders"),
        _ones(late < 0).alias("early_orders"),
    )


def delivery_time_distribution(
    gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES
) -> DataFrame:
    first, last = two_day_bucket(F.col("delivery_days"))
    return (
        _deliveries(gold, chosen)
        .filter(F.col("delivery_days").isNotNull())
        .groupBy(first.alias("bucket_start"), last.alias("bucket_end"))
        .agg(_rows("order_count"))
        .orderBy("bucket_start")
    )


def delivery_band_labels(distribution: DataFrame) -> DataFrame:
    """The two-day distribution with its display label."""
    return distribution.withColumn(
        "delivery_band", F.format_string("%d-%d days", "bucket_start", "bucket_end")
    )


def delivery_status_distribution(
    gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES
) -> DataFrame:
    label, ordinal = delivery_timing(F.col("days_late"))
    return (
        _deliveries(gold, chosen)
        .filter(F.col("days_late").isNotNull())
        .groupBy(label.alias("delivery_timing"), ordinal.alias("timing_order"))
        .agg(_rows("order_count"))
        .select("delivery_timing", "order_count", "timing_order")
        .orderBy("timing_order")
    )


def average_delivery_days_over_time(
    gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES
) -> DataFrame:
    return (
        _deliveries(gold, chosen)
        .filter(F.col("delivery_days").isNotNull())
        .groupBy(_month("order_purchase_timestamp").alias("purchase_month"))
        .agg(F.avg("delivery_days").alias("average_delivery_days"))
        .orderBy("purchase_month")
    )


def average_days_late_by_seller_state(
    gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES
) -> DataFrame:
    """An order sold from several states counts once in each; no sales filter applies."""
    delivered = (
        _deliveries(gold, chosen)
        .filter(F.col("days_late").isNotNull())
        .select("order_id", "days_late")
    )
    order_states = (
        gold.sales.filter(F.col("seller_state").isNotNull())
        .select("order_id", "seller_state")
        .distinct()
    )
    return (
        delivered.join(order_states, "order_id")
        .groupBy("seller_state")
        .agg(F.avg("days_late").alias("average_days_late"), _rows("order_seller_pairs"))
        .orderBy(F.desc("average_days_late"), F.asc("seller_state"))
    )


def late_orders_by_month(gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES) -> DataFrame:
    return (
        _deliveries(gold, chosen)
        .filter((F.col("days_late") > 0) & F.col("order_delivered_customer_date").isNotNull())
        .groupBy(_month("order_delivered_customer_date").alias("delivered_month"))
        .agg(_rows("late_orders"))
        .orderBy("delivered_month")
    )


def _delivery_flag_counts() -> list[Column]:
    return [
        _ones(F.col("has_timestamp_anomaly")).alias("timestamp_anomalies"),
        *[
            _ones(F.col(flag)).alias(flag)
            for flag in (
                "missing_delivery_timestamp",
                "missing_carrier_timestamp",
                "missing_estimated_delivery_date",
            )
        ],
    ]


def delivery_quality_flags(gold: Marts, chosen: DeliveryFilter = ALL_DELIVERIES) -> DataFrame:
    return _deliveries(gold, chosen).agg(*_delivery_flag_counts())


# --- state of the marts ----------------------------------------------------


def _marts(gold: Marts) -> dict[str, DataFrame]:
    return {"sales": gold.sales, "customers": gold.customers, "deliveries": gold.deliveries}


def _labelled(parts: dict[str, DataFrame]) -> DataFrame:
    """Union of one small frame per mart, each labelled with the mart's name."""
    frames = [df.select(F.lit(name).alias("table_name"), "*") for name, df in parts.items()]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionAll(frame)
    return union


def gold_table_counts(gold: Marts) -> DataFrame:
    return _labelled({name: df.agg(_rows("row_count")) for name, df in _marts(gold).items()})


# The column that tells how new a mart is, and the fields whose NULLs are watched.
NEWEST = {
    "sales": "order_purchase_timestamp",
    "customers": "last_order_date",
    "deliveries": "order_purchase_timestamp",
}
WATCHED = {
    "sales": ["product_category_name", "seller_state"],
    "customers": ["customer_state", "first_order_date", "average_review_score"],
    "deliveries": ["order_delivered_customer_date", "order_estimated_delivery_date", "days_late"],
}


def gold_freshness(gold: Marts) -> DataFrame:
    return _labelled(
        {
            name: df.agg(F.max(NEWEST[name]).alias("latest_business_timestamp"))
            for name, df in _marts(gold).items()
        }
    )


def gold_null_counts(gold: Marts) -> DataFrame:
    """NULLs of the watched fields: one aggregate per mart, then turned into long form."""
    long = {
        name: df.agg(*[_ones(F.col(c).isNull()).alias(c) for c in WATCHED[name]]).unpivot(
            [], WATCHED[name], "field_name", "null_count"
        )
        for name, df in _marts(gold).items()
    }
    return _labelled(long).orderBy("table_name", "field_name")


def quality_indicators(gold: Marts) -> DataFrame:
    """Flag counts of the deliveries beside the uncategorized sales, one scan of each mart."""
    unknown = F.col("product_category_name").isNull()
    uncategorized = gold.sales.agg(
        F.struct(
            _ones(unknown).alias("uncategorized_items"),
            F.count_distinct(F.when(unknown, F.col("order_id"))).alias("uncategorized_orders"),
        )
    )
    return (
        gold.deliveries.agg(*_delivery_flag_counts())
        .select("*", uncategorized.scalar().alias("sales"))
        .select("*", "sales.*")
        .drop("sales")
    )
