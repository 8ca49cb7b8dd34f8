"""Lookups split a hot key and NULL keys over many tasks, and give the rows of a plain join."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymart.operators import lookups
from tallymart.operators.integrity import orphan_rows
from tallymart.operators.lookups import split_join, with_parent

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def child(spark):
    """A third on one key, a third with a NULL key, the rest spread out."""
    return spark.range(0, ROWS, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 2, F.concat(F.lit("k"), F.col("id") % 500))
        .alias("key"),
        F.md5(F.col("id").cast("string")).alias("n"),
    )


@pytest.fixture(scope="module")
def parent(spark):
    found = [("hot",), (None,), ("k2",), ("k5",), ("k5",), ("unused",)]
    return spark.createDataFrame(found, "key string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(child, parent, how):
    few, unique = child.limit(3000), parent.distinct().withColumn("tag", F.lit(1))
    assert rows(split_join(few, unique, "key", how)) == rows(few.join(unique, "key", how).select(*split_join(few, unique, "key", how).columns))


@pytest.mark.parametrize("operator", ["with_parent", "orphan_rows"])
def test_hot_rows_reach_many_tasks(spark, child, parent, operator):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        if operator == "with_parent":
            joined = with_parent(child, parent, "key")
        else:
            joined = orphan_rows(child, parent.where("key != 'hot'"), "key")
        read = [F.max(c) for c in joined.columns]  # else the join or the wide column is pruned
        by_task = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n_rows"), *read)
        counts = [r["n_rows"] for r in by_task.collect()]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    # of what 16 tasks would get on average
    assert max(counts) < 2 * ROWS / 16


def test_unused_lookups_are_dropped(child, parent):
    plan = with_parent(child, parent, "key").select("n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_orphans_are_found_without_a_shuffle_of_the_child(child, parent):
    expected = [(r.key, r.n, r.key is not None and r.key not in ("hot", "k2", "k5") or None) for r in child.limit(3000).collect()]
    for few in (lookups.FEW_ORPHANS, 1):  # sent to the child; shuffled
        found = lookups.with_orphans(child.limit(3000), parent, "key", "lost", few)
        assert rows(found) == sorted(expected, key=lambda r: tuple((v is not None, str(v)) for v in r))
    plan = lookups.with_orphans(child, parent, "key", "lost").select("lost", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
