"""Ids as bytes on the way, and layers that leave no shuffle files behind."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymart.operators.compact import compact, restored
from tallymart.operators.lookups import with_parent
from tallymart.plans import gold as marts
from tallymart.plans import layers, silver as entities
from tallymart.plans.silver import IDS, Silver

HEX = "0123456789abcdef" * 2
TEXTS = [
    None, "", " ", "\0", "\x01", "o1", "chegou bem", HEX, HEX.upper(), HEX[:31], HEX + "0", "A" + HEX[1:], "g" + HEX[1:],
    *[c * n for n in (13, 14, 15, 16, 17, 31, 32, 33) for c in ("a", "\0", "\x01", "z")],
    "a" * 14 + "\0", "a" * 14 + "\x01", "a" * 13 + "\x01\x01", "a" * 15 + "\0", "ção" * 8, "日本" * 16, "é" * 8, "é" * 16,
]


def test_ids_come_back_and_stay_different(spark):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "i int, order_id string, other string")
    small = compact(df, [*IDS, "absent"])
    assert dict(small.dtypes)["order_id"] == "binary" and small.columns == df.columns
    assert restored(small, IDS).collect() == df.collect()
    assert small.select("order_id").distinct().count() == len(set(TEXTS))
    sizes = {r.other: r.n for r in small.select("other", F.octet_length("order_id").alias("n")).collect()}
    assert sizes[HEX] == 16 and {t for t, n in sizes.items() if n == 16} == {HEX, "a" * 32}


def test_lookups_by_packed_ids_find_the_same(spark):
    child = spark.createDataFrame([(t, t, i) for i, t in enumerate(TEXTS * 2)], "order_id string, product_id string, n int")
    parent = spark.createDataFrame([(t and f" {t} ", i) for i, t in enumerate(TEXTS[::2])], "order_id string, v int")
    carry = {"v": F.max("v")}
    found = with_parent(child, parent, "order_id", carry=carry, ids=IDS)
    assert rows(found) == rows(with_parent(child, parent, "order_id", carry=carry))
    assert found.dtypes == [*child.dtypes, ("v", "int"), ("__found", "boolean")]


def shuffled_ids(df) -> list[str]:
    """The keys by which a plan's rows are dealt."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_items_are_shuffled_with_packed_ids(spark, tiny):
    """The rows' ids are bytes below the exchange, for the entity and for the mart."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orders = entities.orders(tiny.orders)
        plan = entities.order_items(tiny.order_items, orders, tiny.products, tiny.sellers)
        text = plan._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled_ids(plan) and text.count("unhex(") >= 4  # three of an item, one of an order


def test_the_sales_mart_is_the_same_in_any_order_of_lookups(spark, tiny):
    plan = entities.SilverPlan(tiny)
    silver = Silver(**{e: getattr(plan, e) for e in entities.FLAGS})
    small = Silver(**{e: compact(getattr(plan, e), IDS) for e in entities.FLAGS})
    last = marts.sales(small, lookups=("product_id", "seller_id", "order_id"))
    assert rows(restored(last, IDS)) == rows(marts.sales(silver))
    assert rows(restored(marts.customers(small), IDS)) == rows(marts.customers(silver))


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*")}


def test_written_layers_leave_no_shuffle_files(spark, tiny):
    before = shuffle_files(spark)
    names = layers.LayerNames(silver="small_silver", gold="small_gold")
    layers.build_layers(spark, tiny, names)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)  # they go in the background
    assert not shuffle_files(spark) - before
    assert spark.conf.get(layers.RELEASE, "false") == "false"
    files = spark.table("small_gold.sales").inputFiles()
    assert files and all(".zstd." in f for f in files)


def test_the_setting_comes_back_after_a_failure(spark):
    spark.conf.set(layers.RELEASE, "false")
    with pytest.raises(ValueError), layers.released_shuffles(spark):
        assert spark.conf.get(layers.RELEASE) == "true"
        raise ValueError
    assert spark.conf.get(layers.RELEASE) == "false"
    spark.conf.unset(layers.RELEASE)
