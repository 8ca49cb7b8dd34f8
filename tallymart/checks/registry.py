"""One callable ``(spark, folder) -> DataFrame`` per operator, entity, mart and report."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import integrity as ig
from tallymart.operators import profile as pf
from tallymart.operators import rules
from tallymart.operators.distinct import DistinctCounts
from tallymart.operators.filters import CustomerFilter, DeliveryFilter, SalesFilter
from tallymart.plans import gold as marts
from tallymart.plans import reports, sql_reports, state
from tallymart.plans.gold import GoldPlan
from tallymart.plans.layers import LayerNames, build_layers, verify_persisted
from tallymart.plans.silver import FLAGS, KEYS, SilverPlan
from tallymart.session import shared_folder
from tallymart.sources.adapters import Bronze, BronzePlan, bronze_from_layer
from tallymart.sources import tables
from tallymart.sources.ingest import CORRUPT, QUARANTINE, IngestOptions, audit_log, ingest_paths, read_csv
from tallymart.sources.versions import publish, published, rollback, write_version

Query = Callable[[SparkSession, str], DataFrame]

# Filter values of the ``*_filtered`` queries; the SQL side spells the same values out.
SALES_FILTER = SalesFilter(
    start_date="1996-01-01",
    end_date="1999-06-30",
    order_statuses=["delivered", " shipped ", None, ""],
    seller_states=["SP", "PR"],
    product_categories=["promo", "economy", "standard"],
)
SALES_FILTER_ANY_CATEGORY = SalesFilter(
    start_date="1996-01-01",
    end_date="1999-06-30",
    order_statuses=["delivered", "shipped"],
    seller_states=["SP", "PR"],
)
CUSTOMER_FILTER = CustomerFilter(
    customer_states=["SP", "RJ"], minimum_total_spend=100_000, minimum_total_orders=3
)
CUSTOMER_FILTER_ZERO = CustomerFilter(minimum_total_spend=0.0, minimum_total_orders=0)
DELIVERY_FILTER = DeliveryFilter(
    start_date="1996-03-01", end_date="1998-09-15", order_statuses=["delivered"]
)


#: Layers of bronze tables that stand for a folder: queries read them instead of its raw tables.
BRONZE_LAYERS: dict[str, str] = {}


def bronze_of(spark: SparkSession, folder: str) -> Bronze | BronzePlan:
    layer = BRONZE_LAYERS.get(folder)
    return bronze_from_layer(spark, layer) if layer else BronzePlan(spark, folder)


def _bronze(query: Callable[[Bronze], DataFrame]) -> Query:
    return lambda spark, folder: query(bronze_of(spark, folder))


def _silver(query: Callable[[SilverPlan], DataFrame]) -> Query:
    return lambda spark, folder: query(SilverPlan(bronze_of(spark, folder)))


def _both(query: Callable[[BronzePlan, SilverPlan], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        bronze = bronze_of(spark, folder)
        return query(bronze, SilverPlan(bronze))

    return run


def _gold(query: Callable[..., DataFrame], *args, **options) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        gold = GoldPlan(SilverPlan(bronze_of(spark, folder)))
        return query(gold, *args, **options)

    return run


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Payments written as CSV to the shared folder and read back with header and inferred types."""
    payments = BronzePlan(spark, folder).order_payments
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4()}"
    payments.write.option("header", "true").csv(path)
    return read_csv(spark, path)


#: Layers that were written for a session and a folder.
_layers: dict[tuple[str, str], LayerNames] = {}


def written(spark: SparkSession, folder: str) -> LayerNames:
    """Silver and gold tables of a folder, written and verified once a session."""
    key = spark.sparkContext.applicationId, folder
    if key not in _layers:
        mark = uuid.uuid4().hex[:8]
        names = LayerNames(silver=f"checked_silver_{mark}", gold=f"checked_gold_{mark}")
        build_layers(spark, BronzePlan(spark, folder), names)
        _layers[key] = names
    return _layers[key]


INGESTED = ("sellers", "products", "customers")


def ingest_audit(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files of three entities, ingested; what the audit log says of the run."""
    mark = uuid.uuid4().hex[:8]
    paths = []
    for entity in INGESTED:
        paths.append(f"{shared_folder(spark)}/{mark}/olist_{entity}_dataset.csv")
        getattr(BronzePlan(spark, folder), entity).write.option("header", "true").csv(paths[-1])
    options = IngestOptions(layer=f"checked_raw_{mark}")
    ingest_paths(spark, paths, options, run_id=mark)
    log = audit_log(spark, f"{options.layer}.{options.audit_table}").where(F.col("run_id") == mark)
    table = F.substring_index("target_table", ".", -1).alias("target_table")
    stamped = F.col("ingestion_timestamp").isNotNull().alias("stamped")
    return log.select("source_file", table, "rows_read", "status", "error_message", stamped)


# Lines of a file, of which some lack fields, have too many, or a word for a number.
DAMAGED_LINES = """SELECT CASE WHEN s_suppkey % 7 = 0 THEN concat('lost', s_suppkey)
    WHEN s_suppkey % 11 = 0 THEN concat_ws(',', s_suppkey, 'name', s_suppkey, 'more')
    WHEN s_suppkey % 13 = 0 THEN concat_ws(',', s_suppkey, 'name', 'many')
    ELSE concat_ws(',', s_suppkey, 'name', s_suppkey * 2) END AS value FROM {lines}"""


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """A file with damaged lines, ingested: rows read, rows of the table and of its quarantine."""
    mark = uuid.uuid4().hex[:8]
    path = f"{shared_folder(spark)}/{mark}/lines.csv"
    spark.sql(DAMAGED_LINES, lines=spark.read.parquet(f"{folder}/supplier.parquet")).write.text(path)
    schema = "supplier long, name string, amount long"
    options = IngestOptions(
        layer=f"checked_raw_{mark}", reader={"header": "false"}, schemas={"lines": schema}, quarantine=True
    )
    ingest_paths(spark, [path], options)
    log = spark.table(f"{options.layer}.{options.audit_table}")
    loaded = spark.table(f"{options.layer}.lines").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.sum("amount").alias("amount_loaded")
    )
    aside = spark.table(f"{options.layer}.lines{QUARANTINE}").agg(
        F.count(F.col(CORRUPT)).alias("rows_quarantined"), F.max(CORRUPT).alias("last_record")
    )
    both = loaded.select(F.struct("*").alias("t"), aside.select(F.struct("*")).scalar().alias("q"))
    return both.select(log.select("rows_read").scalar().alias("rows_read"), "t.*", "q.*")


def table_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """What the operators on tables say of one that was written, changed and set back."""
    layer = f"checked_tables_{uuid.uuid4().hex[:8]}"
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    tables.create_layer(spark, layer)
    publish(spark, write_version(nation, f"{layer}.nations"))
    publish(spark, write_version(nation.select("n_name").limit(3), f"{layer}.nations"))
    rollback(spark, f"{layer}.nations")
    tables.write_table(nation.where("n_regionkey = 1"), f"{layer}.plain")
    here = tables.read_table(spark, layer, "nations")
    listed = tables.list_tables(spark, layer).agg(F.array_join(F.sort_array(F.collect_list("tableName")), " ").alias("value"))
    described = tables.describe_table(spark, f"{layer}.nations").where("col_name LIKE 'n\\_%'")
    listing = F.array_join(F.sort_array(F.collect_list("col_name")), " ").alias("value")
    above = tables.query(spark, f"SELECT count(*) FROM {layer}.nations WHERE n_nationkey >= :least", least=20)
    values = {
        "list": tables.scalar(listed),
        "describe": tables.scalar(described.agg(listing)),
        "rows": here.count(),
        "preview": pf.preview(here, 10).count(),
        "plain": spark.table(f"{layer}.plain").count(),
        "bound query": tables.scalar(above),
        "statistics": published(spark, f"{layer}.nations").statistics.rows,
    }
    return spark.createDataFrame([(k, str(v)) for k, v in values.items()], "operator string, value string")


# Calls of table functions with the values of the filters above.
SALES_CALL = """(start_date => DATE'1996-01-01', end_date => DATE'1999-06-30',
    order_statuses => array('delivered', ' shipped ', NULL, ''), seller_states => array('SP', 'PR'),
    product_categories => array('promo', 'economy', 'standard'))"""
CUSTOMER_CALL = "(array('SP', 'RJ'), 100000, minimum_total_orders => 3)"
DELIVERY_CALL = "(DATE'1996-03-01', DATE'1998-09-15', array('delivered'))"


def order_counts(*by: str, where: str | None = None) -> Query:
    """Distinct orders from bitmaps per day, status and state; the bitmaps are written once a session."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        key = spark.sparkContext.applicationId, folder
        if key not in _counts:
            sales = GoldPlan(SilverPlan(bronze_of(spark, folder))).sales
            _counts[key] = DistinctCounts.of(
                sales, "order_id", "order_purchase_timestamp", ["order_status", "seller_state"]
            )
        return _counts[key].count(*by, name="orders", where=where)

    return run


_counts: dict[tuple[str, str], DistinctCounts] = {}


def table_function(name: str, call: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        layer = written(spark, folder).gold
        sql_reports.register(spark, layer, prefix=f"{layer}_")
        return spark.sql(f"SELECT * FROM {layer}_{name}{call}")

    return run


DELIVERED = "order_status = 'delivered'"
UNDELIVERED = "order_status <> 'delivered'"
ITEM_SIGNS = {
    "negative_price": "price < 0",
    "zero_price": "price = 0",
    "negative_freight": "freight_value < 0",
    "zero_freight": "freight_value = 0",
}
PRODUCT_SIZES = ["product_length_cm", "product_height_cm", "product_width_cm"]
PRODUCT_TEXT = ["product_name_length", "product_description_length", "product_photos_qty"]
PRODUCT_VALIDITY = {
    **{c.replace("product_", "negative_"): f"{c} < 0" for c in PRODUCT_TEXT},
    "non_positive_weight": "product_weight_g <= 0",
    **{f"non_positive_{c.split('_')[1]}": f"{c} <= 0" for c in PRODUCT_SIZES},
}
ZIP_LIMITS = {
    "zip_below_1000": "seller_zip_code_prefix < 1000",
    "zip_above_99999": "seller_zip_code_prefix > 99999",
}


def _day_ranges() -> list[Column]:
    return [
        F.min("delivery_days").alias("min_delivery_days"),
        F.max("delivery_days").alias("max_delivery_days"),
        F.count_if(F.col("delivery_days").isNull()).alias("delivery_days_nulls"),
        F.min("days_late").alias("min_days_late"),
        F.max("days_late").alias("max_days_late"),
        F.count_if(F.col("days_late").isNull()).alias("days_late_nulls"),
    ]


def profile_queries() -> dict[str, Query]:
    arrived = "order_delivered_customer_date"
    stages = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )

    def by_status(column: str, name: str) -> Query:
        return _bronze(
            lambda b: pf.missing_by_group(b.orders, "order_status", column, "order_count", name)
        )

    return {
        "profile_orders_row_count": _bronze(lambda b: pf.row_count(b.orders)),
        "profile_orders_completeness": _bronze(
            lambda b: pf.completeness(
                b.orders,
                {
                    "order_approved_at": "approved_timestamp",
                    "order_delivered_carrier_date": "carrier_timestamp",
                    "order_delivered_customer_date": "customer_delivery_timestamp",
                },
                total="total_orders",
            )
        ),
        "profile_orders_null_counts": _bronze(lambda b: pf.null_counts(b.orders)),
        "profile_orders_status_distribution": _bronze(
            lambda b: pf.value_counts(b.orders, "order_status")
        ),
        "profile_orders_date_range": _bronze(
            lambda b: pf.value_range(
                b.orders, "order_purchase_timestamp", "earliest_order", "latest_order"
            )
        ),
        "profile_orders_timestamp_disorder": _bronze(lambda b: pf.out_of_order(b.orders, *stages)),
        "profile_orders_delivered_without_date": _bronze(
            lambda b: pf.share(b.orders, DELIVERED, f"{arrived} IS NULL")
        ),
        "profile_orders_undelivered_with_date": _bronze(
            lambda b: pf.share(b.orders, UNDELIVERED, f"{arrived} IS NOT NULL")
        ),
        "profile_orders_missing_delivery_by_status": by_status(
            "order_delivered_customer_date", "missing_delivery_date"
        ),
        "profile_orders_missing_approval_by_status": by_status(
            "order_approved_at", "missing_approved_at"
        ),
        "profile_orders_missing_carrier_by_status": by_status(
            "order_delivered_carrier_date", "missing_carrier_date"
        ),
        "profile_items_row_count": _bronze(lambda b: pf.row_count(b.order_items)),
        "profile_items_null_counts": _bronze(lambda b: pf.null_counts(b.order_items)),
        "profile_items_sign_combinations": _bronze(
            lambda b: pf.combination_counts(b.order_items, ITEM_SIGNS)
        ),
        "profile_items_distribution": _bronze(
            lambda b: pf.distribution(b.order_items, ["price", "freight_value"])
        ),
        "profile_products_null_counts": _bronze(
            lambda b: pf.null_counts(b.products, [c for c in b.products.columns if c != "product_id"])
        ),
        "profile_products_numeric_validity": _silver(
            lambda s: pf.conditional_counts(s.products, PRODUCT_VALIDITY)
        ),
        "profile_products_distribution": _silver(
            lambda s: pf.distribution(s.products, [*PRODUCT_TEXT, "product_weight_g", *PRODUCT_SIZES])
        ),
        "profile_products_weight_flag": _silver(
            lambda s: pf.value_counts(s.products, "non_positive_weight")
        ),
        "profile_products_without_category": _bronze(
            lambda b: b.products.filter(F.col("product_category_name").isNull())
        ),
        "profile_products_without_weight_value": _silver(
            lambda s: rules.flagged_rows(s.products, ["non_positive_weight"]).select(
                "product_id",
                "product_category_name",
                "product_weight_g",
                *PRODUCT_SIZES,
                "product_photos_qty",
            )
        ),
        "profile_sellers_null_counts": _bronze(lambda b: pf.null_counts(b.sellers)),
        "profile_sellers_blank_counts": _silver(
            lambda s: pf.conditional_counts(
                s.sellers,
                {
                    f"missing_{c}": rules.missing_or_blank(c)
                    for c in ("seller_id", "seller_city", "seller_state")
                },
            )
        ),
        "profile_sellers_zip_range": _bronze(
            lambda b: pf.conditional_counts(b.sellers, ZIP_LIMITS)
        ),
        "profile_sellers_states": _bronze(lambda b: pf.distinct_values(b.sellers, "seller_state")),
        "profile_sellers_state_flag": _silver(
            lambda s: pf.value_counts(s.sellers, "invalid_seller_state")
        ),
        "profile_sellers_invalid_state_rows": _silver(
            lambda s: rules.flagged_rows(s.sellers, ["invalid_seller_state"]).select(
                "seller_id", "seller_state"
            )
        ),
        "profile_payments_invalid_installments": _silver(
            lambda s: rules.flagged_rows(s.order_payments, ["invalid_payment_installments"]).select(
                "order_id",
                "payment_sequential",
                "payment_type",
                "payment_installments",
                "payment_value",
            )
        ),
        "profile_reviews_typed_scores": _silver(
            lambda s: pf.conditional_counts(
                s.order_reviews,
                {
                    "valid_typed_scores": "review_score_int IS NOT NULL",
                    "missing_scores": "review_score IS NULL",
                    "invalid_scores": "review_score IS NOT NULL AND review_score_int IS NULL",
                },
            )
        ),
        "profile_reviews_parsed_timestamps": _silver(
            lambda s: pf.conditional_counts(
                s.order_reviews,
                {
                    "valid_creation_timestamps": "review_creation_ts IS NOT NULL",
                    "valid_answer_timestamps": "review_answer_ts IS NOT NULL",
                    "answer_before_creation": "answer_before_creation",
                },
            )
        ),
        "profile_reviews_malformed_rows": _silver(
            lambda s: rules.flagged_rows(
                s.order_reviews,
                [
                    "malformed_order_id",
                    "malformed_review_id",
                    "invalid_review_score",
                    "invalid_review_creation_timestamp",
                    "invalid_review_answer_timestamp",
                ],
            ).drop(
                "review_score_int",
                "review_creation_ts",
                "review_answer_ts",
                "answer_before_creation",
            )
        ),
    }


def integrity_queries() -> dict[str, Query]:
    def key(entity: str, *columns: str, name: str) -> Query:
        return _silver(lambda s: ig.key_profile(getattr(s, entity), *columns, name=name))

    def duplicates(entity: str, *columns: str) -> Query:
        return _silver(lambda s: ig.duplicate_keys(getattr(s, entity), *columns))

    def orphans(child: str, parent: str, column: str) -> Query:
        return _bronze(lambda b: ig.orphan_keys(getattr(b, child), getattr(b, parent), column))

    def parity(entity: str) -> Query:
        return _both(lambda b, s: ig.row_parity(getattr(b, entity), getattr(s, entity)))

    return {
        "integrity_orphan_customer_ids": orphans("orders", "customers", "customer_id"),
        "integrity_orphan_order_ids": orphans("order_items", "orders", "order_id"),
        "integrity_orphan_product_ids": orphans("order_items", "products", "product_id"),
        "integrity_orphan_seller_ids": orphans("order_items", "sellers", "seller_id"),
        "integrity_orphan_payments": _silver(
            lambda s: ig.orphan_rows(s.order_payments, s.orders, "order_id").select(
                "order_id",
                "payment_sequential",
                "payment_type",
                "payment_installments",
                "payment_value",
            )
        ),
        "integrity_orders_duplicates": duplicates("orders", "order_id"),
        "integrity_items_duplicates": duplicates("order_items", "order_id", "order_item_id"),
        "integrity_customers_duplicates": duplicates("customers", "customer_id"),
        "integrity_products_duplicates": duplicates("products", "product_id"),
        "integrity_sellers_duplicates": duplicates("sellers", "seller_id"),
        "integrity_payments_duplicates": duplicates(
            "order_payments", "order_id", "payment_sequential"
        ),
        "integrity_products_key": key("products", "product_id", name="distinct_product_id"),
        "integrity_sellers_key": key("sellers", "seller_id", name="distinct_seller_id"),
        "integrity_payments_key": key(
            "order_payments", "order_id", "payment_sequential", name="distinct_payment_keys"
        ),
        "integrity_customers_distinct": _silver(
            lambda s: ig.distinct_key_count(s.customers, "customer_id", name="distinct_customer_id")
        ),
        "integrity_items_longest_orders": _bronze(
            lambda b: ig.longest_sequences(b.order_items, "order_id", "order_item_id")
        ),
        "integrity_items_sequence_violations": _bronze(
            lambda b: ig.sequence_violations(b.order_items, "order_id", "order_item_id")
        ),
        "integrity_parity_items": parity("order_items"),
        "integrity_parity_customers": parity("customers"),
        "integrity_parity_payments": parity("order_payments"),
        "integrity_parity_reviews": parity("order_reviews"),
        "integrity_repeated_persons": _gold(lambda g: ig.repeated_persons(g.customers)),
    }


def entity_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for entity in FLAGS:
        found[f"silver_{entity}"] = _silver(lambda s, e=entity: getattr(s, e))
        found[f"dq_{entity}"] = _silver(lambda s, e=entity: rules.summarise(getattr(s, e), FLAGS[e]))
    found["dq_order_reviews"] = _silver(
        lambda s: rules.summarise(
            s.order_reviews, FLAGS["order_reviews"], [F.count(F.lit(1)).alias("total_rows")]
        )
    )
    found["dq_orders"] = _silver(
        lambda s: rules.summarise(s.orders, FLAGS["orders"], _day_ranges())
    )
    found["dq_order_payments_final"] = _silver(
        lambda s: ig.grain_check(
            s.order_payments,
            {
                "distinct_orders": ["order_id"],
                "distinct_payment_keys": ["order_id", "payment_sequential"],
            },
            FLAGS["order_payments"],
        )
    )
    for entity in KEYS:
        found[f"layers_verify_{entity}"] = lambda spark, folder, entity=entity: verify_persisted(
            spark.table(f"{written(spark, folder).silver}.{entity}"), entity
        )
    for name in ("table_counts", "freshness", "null_counts"):
        found[f"layers_state_{name}"] = lambda spark, folder, name=name: getattr(state, name)(
            spark, written(spark, folder).gold
        )
    found["layers_grain_customers"] = _gold(
        lambda g: ig.grain_check(
            g.customers,
            {"addresses": marts.PERSON_ADDRESS, "persons": [marts.PERSON]},
        )
    )
    found["layers_grain_sales"] = _gold(
        lambda g: ig.grain_check(g.sales, {"items": ["order_id", "order_item_id"], "orders": ["order_id"]})
    )
    found["gold_sales"] = _gold(lambda g: g.sales)
    found["gold_customers"] = _gold(lambda g: g.customers)
    found["gold_customers_by_person"] = _silver(lambda s: marts.customers(s, grain="person"))
    found["gold_deliveries"] = _gold(lambda g: g.deliveries)
    found["source_csv_scan"] = csv_scan
    found["source_ingest_audit"] = ingest_audit
    found["source_quarantine"] = quarantine
    found["source_table_catalog"] = table_catalog
    return found


def report_queries() -> dict[str, Query]:
    plain: list[Callable[[GoldPlan], DataFrame]] = [
        reports.sales_date_bounds,
        reports.sales_filter_options,
        reports.overview_kpis,
        reports.overview_revenue_over_time,
        reports.overview_revenue_by_category,
        reports.overview_uncategorized_sales,
        reports.overview_orders_by_status,
        reports.overview_revenue_by_seller_state,
        reports.customer_filter_options,
        reports.delivery_date_bounds,
        reports.delivery_filter_options,
        reports.gold_table_counts,
        reports.gold_freshness,
        reports.gold_null_counts,
        reports.quality_indicators,
    ]
    filtered: dict[Callable[..., DataFrame], object] = {
        reports.sales_kpis: SALES_FILTER,
        reports.sales_revenue_over_time: SALES_FILTER,
        reports.sales_revenue_by_category: SALES_FILTER,
        reports.sales_uncategorized_summary: SALES_FILTER_ANY_CATEGORY,
        reports.sales_revenue_by_seller_state: SALES_FILTER,
        reports.sales_top_sellers: SALES_FILTER,
        reports.sales_order_status_distribution: SALES_FILTER,
        reports.sales_detail: SALES_FILTER,
        reports.customer_kpis: CUSTOMER_FILTER,
        reports.customer_count_by_state: CUSTOMER_FILTER,
        reports.customer_spend_by_state: CUSTOMER_FILTER,
        reports.customer_order_frequency_distribution: CUSTOMER_FILTER,
        reports.customer_spending_distribution: CUSTOMER_FILTER,
        reports.new_customers_over_time: CUSTOMER_FILTER,
        reports.customer_detail: CUSTOMER_FILTER,
        reports.delivery_kpis: DELIVERY_FILTER,
        reports.delivery_time_distribution: DELIVERY_FILTER,
        reports.delivery_status_distribution: DELIVERY_FILTER,
        reports.average_delivery_days_over_time: DELIVERY_FILTER,
        reports.average_days_late_by_seller_state: DELIVERY_FILTER,
        reports.late_orders_by_month: DELIVERY_FILTER,
        reports.delivery_quality_flags: DELIVERY_FILTER,
    }
    found = {f"report_{f.__name__}": _gold(f) for f in plain}
    for function, chosen in filtered.items():
        name = f"report_{function.__name__}"
        found[name] = _gold(function)
        found[f"{name}_filtered"] = _gold(function, chosen)
    found["report_sales_detail_page_3"] = _gold(reports.sales_detail, limit=50, offset=100)
    days = "day BETWEEN DATE'1996-01-01' AND DATE'1999-06-30'"
    found["distinct_orders"] = order_counts()
    found["distinct_orders_by_status"] = order_counts("order_status")
    found["distinct_orders_by_state_filtered"] = order_counts(
        "seller_state", where=f"{days} AND order_status IN ('delivered', 'shipped')"
    )
    found["report_sales_detail_far_page"] = _gold(reports.sales_detail, limit=100, offset=5000)
    found["report_customer_detail_page_2"] = _gold(reports.customer_detail, limit=100, offset=100)
    found["report_customer_kpis_zero_minimum"] = _gold(reports.customer_kpis, CUSTOMER_FILTER_ZERO)
    found["report_sales_uncategorized_contradiction"] = _gold(
        reports.sales_uncategorized_summary, SALES_FILTER
    )
    calls = {"sales": SALES_CALL, "customers": CUSTOMER_CALL, "deliveries": DELIVERY_CALL}
    for name, report in sql_reports.REPORTS.items():
        found[f"sql_{name}"] = table_function(name, "()")
        found[f"sql_{name}_filtered"] = table_function(name, calls[report.mart])
    found["report_delivery_band_labels"] = _gold(
        lambda g: reports.delivery_band_labels(reports.delivery_time_distribution(g))
    )
    return found


def all_queries() -> dict[str, Query]:
    return {
        **profile_queries(),
        **integrity_queries(),
        **entity_queries(),
        **report_queries(),
    }
