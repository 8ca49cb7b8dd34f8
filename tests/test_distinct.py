"""Counts from bitmaps against COUNT DISTINCT."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymart.operators.distinct import BITS, NUMBER, PIECE, DistinctCounts, numbered


@pytest.fixture(scope="module")
def sales(spark):
    n = F.col("id")
    return spark.range(90_000, numPartitions=6).select(
        F.when(n % 50 != 0, F.md5((n % 40_001).cast("string"))).alias("order id"),
        F.when(n % 40_001 % 31 != 0, F.timestamp_seconds(1_514_800_000 + n % 40_001 * 700)).alias("at"),
        F.when(n % 50 != 0, F.concat(F.lit("s"), (n % 40_001 % 4).cast("string"))).alias("status"),
        F.concat(F.lit("t"), (n % 7).cast("string")).alias("state"),
    )


@pytest.fixture(scope="module")
def counts(sales):
    return DistinctCounts.of(sales, "order id", "at", ["status", "state"])


def test_numbers_are_dense_and_in_the_order_of_days(sales):
    found = numbered(sales, "order id", "at")
    row = found.agg(F.count("*"), F.min(NUMBER), F.max(NUMBER), F.count_distinct("order id"), F.count_distinct(NUMBER)).first()
    n = sales.select("order id").where("`order id` IS NOT NULL").distinct().count()
    assert tuple(row) == (n, 1, n, n, n)
    days = sales.where("`order id` IS NOT NULL").groupBy("order id").agg(F.min("at").alias("at"))
    ordered = found.join(days, "order id").orderBy(NUMBER).select("at").collect()
    seen = [r["at"] for r in ordered if r["at"] is not None]
    assert seen == sorted(seen) and all(r["at"] is None for r in ordered[: n - len(seen)])


@pytest.mark.parametrize("by", [(), ("status",), ("state",), ("status", "state"), ("day",), ("state", "day")])
def test_counts(sales, counts, by):
    distinct = F.count_distinct("order id").alias("count")
    assert rows(counts.count(*by)) == rows(sales.withColumn("day", F.to_date("at")).groupBy(*by).agg(distinct))


def test_any_range_of_days(sales, counts):
    for low, high in (("2018-01-02", "2018-01-20"), ("2018-05-05", "2018-05-05"), ("2030-01-01", "2031-01-01")):
        test = F.col("day").between(F.lit(low).cast("date"), F.lit(high).cast("date")) & (F.col("state") != "t3")
        want = sales.withColumn("day", F.to_date("at")).where(test).groupBy("status").agg(F.count_distinct("order id").alias("count"))
        assert rows(counts.count("status", where=test)) == rows(want)


def test_plan_has_no_expand_and_bitmaps_are_near_their_day(counts):
    plan = counts.count("status")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "FileScan" in plan
    # 40,000 orders of 324 days: a day's orders are neighbours, so a day has one piece or two
    assert counts.bitmaps.where(F.col(PIECE).isNotNull()).groupBy("day").agg(F.count_distinct(PIECE).alias("n")).agg(F.max("n")).first()[0] <= 2
    assert counts.bitmaps.agg(F.max(F.length(BITS))).first()[0] == 4096


def test_no_rows_and_unknown_groups(spark, sales, counts):
    none = DistinctCounts.of(sales.where("false"), "order id", "at", ["status"])
    assert none.count("status").count() == 0 and none.count().first()[0] == 0
    with pytest.raises(ValueError, match="colour"):
        counts.count("colour")
