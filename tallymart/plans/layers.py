"""Batch job over the layers: bronze tables -> silver tables -> gold tables, verified as they are written.

Every table is written before the next one reads it.  A lost executor therefore
costs at most a part of one table, and no plan carries the lineage of a whole layer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.compact import compact, restored
from tallymart.operators.curve import Curve, along
from tallymart.operators.integrity import assert_row_parity, grain_check
from tallymart.plans import gold as marts
from tallymart.plans import silver as entities
from tallymart.plans.gold import Gold
from tallymart.plans.silver import FLAGS, IDS, KEYS, Silver
from tallymart.sources.adapters import Bronze
from tallymart.sources.tables import DEFAULT_FORMAT, create_layer, writer
from tallymart.sources.versions import publish, write_version


@dataclass(frozen=True)
class LayerNames:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


# Curves along which the marts are clustered unless ``cluster=False``: filters on any of the
# columns, alone or together, then skip files.  Each ends with the key, so that one busy place
# still spreads over many tasks.
CLUSTER_BY = {
    "sales": Curve(
        ("order_purchase_timestamp", "seller_state", "product_category_name"),
        ("order_id", "order_item_id", "product_id", "seller_id"),
    ),
    "customers": Curve(
        ("customer_state", "total_spend", "total_orders"), ("customer_unique_id", "customer_city")
    ),
    "deliveries": Curve(("order_purchase_timestamp", "order_status"), ("order_id",)),
}


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside gives its shuffle files back when it ends.  Otherwise those of all
    tables stay on the executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def verify_persisted(table: DataFrame, entity: str) -> DataFrame:
    """One-row check of a written silver table: rows, distinct keys and all flag counts."""
    key = KEYS[entity]
    return grain_check(table, {"distinct_keys": key} if key else {}, FLAGS[entity])


class VerificationError(AssertionError):
    """A table that was written differs from what was to be written."""


def write_verified(
    df: DataFrame,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    flags: Iterable[str] = (),
    key: Iterable[str] = (),
    source: DataFrame | Observation | None = None,
    unique: bool = False,
    curve: Curve | None = None,
    replace_schema: bool = False,
    packed: Iterable[str] = (),
) -> DataFrame:
    """Write ``df`` as the next version of the table ``name``, check what was written, publish it.

    With a ``curve`` the rows are stored once as they come, then dealt out along it, so that what
    ``df`` stands for (joins, aggregates) is computed once.  Columns named ``packed`` that ``df`` has are
    ``compact`` and stay so on the way; they are written as they were before.

    Rows and flag counts seen while writing must be those of the written version; its rows those
    of ``source`` (a frame, or what was observed as ``source_rows`` by the job that writes); and the key
    must be unique where that is promised (else it is not counted, which would shuffle all rows).  On
    failure readers go on to see the version they saw, and the new one stays unpublished, to be looked at.
    """
    spark, flags = df.sparkSession, list(flags)
    aside = f"{name}__staged_{uuid.uuid4().hex[:8]}"
    try:
        if curve is not None:
            writer(df, fmt).saveAsTable(aside)
            df = along(spark.table(aside), curve)
        df = restored(df, packed)
        version = write_version(df, name, fmt, flags, replace_schema=replace_schema)
    finally:
        if curve is not None:
            spark.sql(f"DROP TABLE IF EXISTS {aside}")
    seen = {"total_rows": version.statistics.rows} | version.statistics.flags
    table = spark.table(version.stored)
    found = grain_check(table, {"distinct_keys": key} if unique else {}, flags).first().asDict()
    wrong = {k: (v, found[k]) for k, v in seen.items() if found[k] != v}
    if isinstance(source, Observation) and source.get["source_rows"] != found["total_rows"]:
        wrong["source_rows"] = (source.get["source_rows"], found["total_rows"])
    elif isinstance(source, DataFrame) and not wrong:
        assert_row_parity(source, table, name)
    if unique and found["distinct_keys"] != found["total_rows"]:
        wrong["distinct_keys"] = (found["total_rows"], found["distinct_keys"])
    if wrong:
        raise VerificationError(f"{name}: (expected, written) {wrong}")
    return publish(spark, version)


def build_silver(
    spark: SparkSession, bronze: Bronze, layer: str = "silver", fmt: str = DEFAULT_FORMAT
) -> Silver:
    """Write the seven entities; orders come first, because three others look them up.

    Each source is read once: its rows are counted by the job that writes the entity.
    """
    create_layer(spark, layer)
    # orders, products and sellers are also read as parents of others, uncounted
    builders = {
        "orders": lambda rows, done: entities.orders(rows),
        "order_items": lambda rows, done: entities.order_items(
            rows, done["orders"], bronze.products, bronze.sellers
        ),
        "customers": lambda rows, done: entities.customers(rows),
        "products": lambda rows, done: entities.products(rows),
        "sellers": lambda rows, done: entities.sellers(rows),
        "order_payments": lambda rows, done: entities.order_payments(rows, done["orders"]),
        "order_reviews": lambda rows, done: entities.order_reviews(rows, done["orders"]),
    }
    done: dict[str, DataFrame] = {}
    with released_shuffles(spark):
        for entity, build in builders.items():
            counted = Observation()
            rows = getattr(bronze, entity).observe(counted, F.count(F.lit(1)).alias("source_rows"))
            done[entity] = write_verified(
                build(rows, done), f"{layer}.{entity}", fmt, FLAGS[entity], KEYS[entity], counted
            )
    return Silver(**done)


def build_gold(
    spark: SparkSession,
    silver: Silver,
    layer: str = "gold",
    fmt: str = DEFAULT_FORMAT,
    cluster: bool = True,
) -> Gold:
    """Write the three marts.  The customer mart has one row per person and address."""
    create_layer(spark, layer)

    def save(mart: str, df: DataFrame, **checks) -> DataFrame:
        curve = CLUSTER_BY[mart] if cluster else None
        return write_verified(df, f"{layer}.{mart}", fmt, curve=curve, packed=IDS, **checks)

    with released_shuffles(spark):
        rows = Silver(**{f.name: compact(getattr(silver, f.name), IDS) for f in fields(Silver)})
        return Gold(
            sales=save("sales", marts.sales(rows, lookups=("product_id", "seller_id", "order_id"))),
            customers=save("customers", marts.customers(rows)),
            deliveries=save("deliveries", marts.deliveries(rows)),
        )


def build_layers(
    spark: SparkSession,
    bronze: Bronze,
    names: LayerNames = LayerNames(),
    fmt: str = DEFAULT_FORMAT,
    cluster: bool = True,
) -> Gold:
    return build_gold(spark, build_silver(spark, bronze, names.silver, fmt), names.gold, fmt, cluster)


def silver_tables(spark: SparkSession, layer: str = "silver") -> Silver:
    """The entities as they were last written."""
    return Silver(**{entity: spark.table(f"{layer}.{entity}") for entity in FLAGS})


def gold_tables(spark: SparkSession, layer: str = "gold") -> Gold:
    return Gold(*[spark.table(f"{layer}.{mart}") for mart in ("sales", "customers", "deliveries")])
