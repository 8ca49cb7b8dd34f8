from __future__ import annotations

import math
import random
from datetime import date, datetime

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from tallymart.functions import delivery_timing, spend_band, two_day_bucket
from tallymart.operators import integrity as ig
from tallymart.operators import profile as pf
from tallymart.operators import quantiles
from tallymart.operators.filters import CustomerFilter, DeliveryFilter, SalesFilter, one_of
from tallymart.operators.paging import asc, desc, page, page_bounds, top
from tallymart.sources import tables


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", None), (None, 1), (None, None), ("b", 2)], "k string, n int"
    )


def test_key_checks(pairs):
    assert ig.key_profile(pairs, "k", name="d").first().asDict() == {"total_rows": 6, "d": 2}
    assert ig.key_profile(pairs, "k", "n", name="d").first()["d"] == 2  # NULL parts do not count
    assert ig.distinct_key_count(pairs, "k", name="d").first()["d"] == 3  # NULL is a value
    assert rows(ig.duplicate_keys(pairs, "k", "n")) == [("a", 1, 2)]


def test_orphans(spark, pairs):
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(ig.orphan_keys(pairs, parent, "k")) == [(None,), ("b",)]
    assert len(rows(ig.orphan_rows(pairs, parent, "k"))) == 3


def test_sequences(spark):
    df = spark.createDataFrame(
        [("x", 1), ("x", 2), ("y", 1), ("y", 3), ("z", 1), ("z", 1)], "order_id string, item int"
    )
    assert rows(ig.sequence_violations(df, "order_id", "item")) == [("y", 2, 3), ("z", 2, 1)]
    assert [tuple(r) for r in ig.longest_sequences(df, "order_id", "item", 2).collect()] == [
        ("x", 2, 2),
        ("y", 2, 3),
    ]


def test_parity(spark):
    assert tuple(ig.row_parity(spark.range(3), spark.range(3)).first()) == (3, 3, True)
    assert ig.assert_row_parity(spark.range(3), spark.range(3), "t") == 3
    with pytest.raises(AssertionError, match="t: 3 source rows but 2 target rows"):
        ig.assert_row_parity(spark.range(3), spark.range(2), "t")


def test_profiles(pairs):
    assert pf.null_counts(pairs).first().asDict() == {"total_rows": 6, "k_nulls": 2, "n_nulls": 2}
    assert pf.completeness(pairs, {"n": "known"}).first().asDict() == {"total_rows": 6, "known": 4}
    assert pf.value_counts(pairs, "k").first().asDict() == {"k": "a", "count": 3}
    assert rows(pf.missing_by_group(pairs, "k", "n", "total", "missing")) == [
        (None, 2, 1),
        ("a", 3, 1),
        ("b", 1, 0),
    ]
    assert tuple(pf.value_range(pairs, "n", "low", "high").first()) == (1, 2)
    assert [r[0] for r in pf.distinct_values(pairs, "k").collect()] == [None, "a", "b"]
    assert pf.preview(pairs, 2).count() == 2
    assert pf.row_count(pairs).first()[0] == 6
    combos = pf.combination_counts(pairs, {"big": "n > 1"})
    assert rows(combos) == [(None, 2), (False, 3), (True, 1)]


def test_share_of_nothing_is_null(pairs):
    assert tuple(pf.share(pairs, "k = 'a'", "n IS NULL").first())[:2] == (3, 1)
    assert tuple(pf.share(pairs, "false", "k = 'a'").first()) == (0, 0, None)


def test_rule_literals_are_quoted(spark):
    from tallymart.operators.rules import in_domain, malformed

    values = ["o'brien", "back\\slash", 'say "x"']
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert df.filter(in_domain("v", values)).count() == 3
    assert df.filter(malformed("v", r"^\w+\\\w+$")).count() == 2


def test_out_of_order_ignores_unknown_stages(spark):
    df = spark.createDataFrame([(1, 2, 3), (2, 1, None), (None, None, 1), (1, 3, 2)], "a int, b int, c int")
    assert rows(pf.out_of_order(df, "a", "b", "c")) == [(1, 3, 2), (2, 1, None)]


@pytest.mark.parametrize("digit", [16, 8])
def test_quantiles_are_exact(spark, monkeypatch, digit):
    monkeypatch.setattr(quantiles, "DIGIT", digit)
    rng = random.Random(3)
    values = sorted(round(rng.lognormvariate(3, 1.5), 2) for _ in range(20_001))
    df = spark.createDataFrame([(v, None) for v in values], "price double, `no value` int").repartition(6)
    found = {row["column_name"]: row for row in pf.distribution(df, ["price", "no value"]).collect()}
    row = found["price"]
    assert (row["value_count"], row["min_value"], row["max_value"]) == (20_001, values[0], values[-1])
    for name, probability in pf.QUARTILES.items():
        assert row[name] == values[math.ceil(probability * len(values)) - 1]
    assert tuple(found["no value"]) == ("no value", 0, None, None, None, None, None)
    text = {r[0]: r[1] for r in pf.summary(df, "price").collect()}
    assert text["count"] == "20001" and float(text["max"]) == values[-1]


def test_bands(spark):
    spend = [None, -5.0, 0.0, 99.99, 100.0, 249.0, 250.0, 500.0, 1000.0, 1999.99, 2000.0]
    df = spark.createDataFrame([(s,) for s in spend], "s double")
    label, ordinal = spend_band(F.col("s"))
    found = [tuple(r) for r in df.select(label, ordinal).collect()]
    assert found == [
        ("2,000+", 6), ("0-99", 1), ("0-99", 1), ("0-99", 1), ("100-249", 2), ("100-249", 2),
        ("250-499", 3), ("500-999", 4), ("1,000-1,999", 5), ("1,000-1,999", 5), ("2,000+", 6),
    ]
    days = spark.createDataFrame([(-3,), (-1,), (0,), (1,), (2,), (None,)], "d bigint")
    first, last = two_day_bucket(F.col("d"))
    assert [tuple(r) for r in days.select(first, last).collect()] == [
        (-4, -3), (-2, -1), (0, 1), (0, 1), (2, 3), (None, None),
    ]
    timing, place = delivery_timing(F.col("d"))
    assert [tuple(r) for r in days.select(timing, place).collect()] == [
        ("Early", 1), ("Early", 1), ("On time", 2), ("Late", 3), ("Late", 3), (None, None),
    ]


def test_filter_arguments(spark):
    df = spark.createDataFrame(
        [
            (ts("2018-01-01T00:00:00"), "delivered", "SP", "toys"),
            (ts("2018-01-31T23:59:59"), "o'brien\\", "RJ", None),
            (ts("2018-02-01T00:00:00"), None, None, "toys"),
            (None, "delivered", "SP", "toys"),
        ],
        "order_purchase_timestamp timestamp, order_status string, seller_state string, product_category_name string",
    )

    def kept(chosen):
        return df.filter(chosen.predicate()).count()

    assert kept(SalesFilter()) == 4
    assert kept(SalesFilter(order_statuses=[], seller_states=[None, " "], product_categories="")) == 4
    for start, end in [
        ("2018-01-01", "2018-01-31"),
        (date(2018, 1, 1), datetime(2018, 1, 31, 5)),
    ]:
        assert kept(SalesFilter(start, end)) == 2
        assert kept(DeliveryFilter(start, end)) == 2
    # The default range of a form spans all known days and so drops rows without one.
    assert kept(SalesFilter("2018-01-01", "2018-02-01")) == 3
    assert kept(SalesFilter(order_statuses=[" delivered "])) == 2
    assert kept(SalesFilter(order_statuses=["o'brien\\"])) == 1
    assert kept(DeliveryFilter(end_date="2018-01-31", order_statuses=["delivered"])) == 1
    assert one_of("x", None) is None
    with pytest.raises(ValueError):
        SalesFilter("not a day").predicate()


def test_minimum_of_zero_is_a_predicate(spark):
    df = spark.createDataFrame(
        [("SP", 10.0, 1), ("RJ", None, 0)],
        "customer_state string, total_spend double, total_orders bigint",
    )
    for unset in (CustomerFilter(), CustomerFilter([], "", None)):
        assert df.filter(unset.predicate()).count() == 2
    assert df.filter(CustomerFilter(minimum_total_spend=0.0).predicate()).count() == 1
    assert df.filter(CustomerFilter(minimum_total_orders=0).predicate()).count() == 2
    assert df.filter(CustomerFilter(["RJ"], minimum_total_orders="1").predicate()).count() == 0


def test_day_limits_reach_the_scan_as_a_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT TIMESTAMP '2018-01-01' AS order_purchase_timestamp, 'x' AS order_status").write.parquet(path)
    df = spark.read.parquet(path).filter(DeliveryFilter("2018-01-01", "2018-01-31").predicate())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_purchase_timestamp), GreaterThanOrEqual" in plan
    assert ">= 2018-01-01 00:00:00)" in plan and "< 2018-02-01 00:00:00)" in plan


def test_pages(spark):
    df = spark.range(120).select((F.col("id") % 7).alias("v"), "id")
    order = (desc("v"), asc("id"))
    columns = [k.column() for k in order]
    whole = [tuple(r) for r in df.orderBy(*columns).collect()]
    found = [tuple(r) for offset in range(0, 125, 25) for r in page(df, 25, offset, *order).collect()]
    assert found == whole
    assert [tuple(r) for r in page(df, 0, -5, *order).collect()] == whole[:1]
    assert [tuple(r) for r in top(df, 3, *columns).collect()] == whole[:3]
    assert top(df, 0, *columns).count() == 1


@pytest.mark.parametrize(
    "total, size, asked, expected",
    [
        (0, 25, 1, (1, 1, 0, 25)),
        (25, 25, 2, (1, 1, 0, 25)),
        (26, 25, 2, (2, 2, 25, 25)),
        (1001, 100, 99, (11, 11, 1000, 100)),
        (10, 50, -1, (1, 1, 0, 50)),
    ],
)
def test_page_bounds(total, size, asked, expected):
    b = page_bounds(total, size, asked)
    assert (b.page, b.max_page, b.offset, b.size) == expected


def test_tables(spark):
    tables.create_layer(spark, "ops")
    df = spark.createDataFrame([(2, "b"), (1, "a"), (None, "c")], "n int, s string")
    written = tables.write_table(df, "ops.t", range_by=["n", "s"])
    assert rows(written) == rows(df)
    assert rows(tables.read_table(spark, "ops", "t")) == rows(df)
    assert [r["tableName"] for r in tables.list_tables(spark, "ops").collect()] == ["t"]
    described = [tuple(r)[:2] for r in tables.describe_table(spark, "ops.t").collect()]
    assert described == tables.schema_rows(df) == [("n", "int"), ("s", "string")]
    # A new schema replaces the old table.
    tables.write_table(df.select("s"), "ops.t", replace_schema=True)
    assert spark.table("ops.t").columns == ["s"]
    found = tables.query(spark, "SELECT count(*) FROM ops.t WHERE s > :low", low="a")
    assert tables.scalar(found) == 2
    assert tables.scalar(df.filter("false")) is None
    assert [r["n"] for r in tables.newest_first(df, "n").collect()] == [2, 1, None]
