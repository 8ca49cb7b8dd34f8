"""Time the headline queries; prints one JSON line.

Bronze tables are written first, in as many files as there are cores, as an ingest leaves them;
that step has a figure of its own, ``bronze_seconds``, outside the total.  The queries then read
these tables, as every run of the pipeline after its ingest does.  Each query is run to its last
row through the no-op sink, so no optimisation can skip work and no result travels to the
driver; its figure is the median of ``RUNS`` runs.  ``layers_build`` writes all silver and gold
tables (once); the ``table_*`` entries are reports over those written tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from tallymart.checks.registry import BRONZE_LAYERS, DELIVERY_FILTER, SALES_FILTER, all_queries
from tallymart.plans import reports
from tallymart.plans.layers import LayerNames, build_layers
from tallymart.session import local_session
from tallymart.sources.adapters import ADAPTERS, BronzePlan, bronze_from_layer
from tallymart.sources.tables import create_layer

RUNS = 3

HEADLINE = [
    "silver_orders",
    "silver_order_items",
    "silver_order_payments",
    "silver_order_reviews",
    "dq_order_items",
    "dq_order_payments_final",
    "integrity_orphan_order_ids",
    "integrity_items_sequence_violations",
    "profile_items_distribution",
    "gold_sales",
    "gold_customers",
    "gold_deliveries",
    "report_overview_kpis",
    "report_overview_revenue_over_time",
    "report_sales_kpis_filtered",
    "report_sales_top_sellers",
    "report_sales_detail",
    "report_customer_kpis",
    "report_customer_detail",
    "report_delivery_kpis",
    "report_average_days_late_by_seller_state",
    "report_gold_null_counts",
    "report_quality_indicators",
]


def timed(run, runs: int = 1) -> float:
    found = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        found.append(time.perf_counter() - start)
    return round(median(found), 3)


def write_bronze(spark, folder: str, files: int, layer: str = "bronze") -> None:
    create_layer(spark, layer)
    raw = BronzePlan(spark, folder)
    for entity in ADAPTERS:
        getattr(raw, entity).repartition(files).write.saveAsTable(f"{layer}.{entity}")
    BRONZE_LAYERS[folder] = layer


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    warehouse = tempfile.mkdtemp(prefix="tallymart-bench-")
    spark = local_session(cores, "12g", spark__sql__warehouse__dir=warehouse)
    queries = all_queries()
    bronze_seconds = timed(lambda: write_bronze(spark, folder, int(cores)))
    drain(queries["report_overview_revenue_over_time"](spark, folder))  # JVM warm-up

    seconds = {
        name: timed(lambda q=queries[name]: drain(q(spark, folder)), RUNS) for name in HEADLINE
    }
    gold = None

    def build() -> None:
        nonlocal gold
        gold = build_layers(spark, bronze_from_layer(spark, "bronze"), LayerNames(silver="s", gold="g"))

    seconds["layers_build"] = timed(build)
    for name, df in {
        "table_overview_kpis": reports.overview_kpis(gold),
        "table_sales_kpis_filtered": reports.sales_kpis(gold, SALES_FILTER),
        "table_customer_kpis": reports.customer_kpis(gold),
        "table_delivery_kpis_filtered": reports.delivery_kpis(gold, DELIVERY_FILTER),
        "table_gold_null_counts": reports.gold_null_counts(gold),
    }.items():
        seconds[name] = timed(lambda d=df: drain(d), RUNS)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "bronze_seconds": bronze_seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
