"""Pages found by counted ranges against slices of the sorted rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymart.operators import paging
from tallymart.operators.paging import Pages, asc, desc, page


def whole(df, order):
    return [tuple(r) for r in df.orderBy(*[k.column() for k in order]).collect()]


@pytest.fixture(scope="module")
def mixed(spark):
    """Many ties, NULLs in every order column, all the types the marts have."""
    n = F.col("id")

    def sparse(column, every):
        return F.when(n % every != 0, column)

    return spark.range(6000, numPartitions=7).select(
        sparse(n % 11, 13).cast("int").alias("a b"),
        sparse(F.timestamp_seconds(n % 29 * 3600 + 1_540_000_000), 17).alias("t"),
        sparse(F.timestamp_seconds(n % 31 * 1800 + 1_540_000_000).cast("timestamp_ntz"), 19).alias("local"),
        sparse(F.when(n % 5 == 0, float("nan")).otherwise(F.sin(n.cast("double"))), 7).alias("x"),
        sparse((n % 97).cast("decimal(9,2)") / 7, 23).alias("d"),
        sparse(F.concat(F.lit("é'\\"), (n % 37).cast("string")), 29).alias("s"),
        sparse(F.date_add(F.lit("2020-01-01").cast("date"), (n % 41).cast("int")), 31).alias("day"),
        (n % 2 == 0).alias("even"),
        n.alias("id"),
    )


ORDERS = [
    (desc("a b"), asc("id")),
    (asc("a b"), desc("t"), asc("local"), desc("id")),
    (desc("x"), asc("s"), asc("id")),
    (asc("x"), desc("d"), desc("day"), asc("even"), asc("id")),
    (asc("id"),),
    (desc("local"), desc("s"), desc("id")),
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_any_page_of_any_order(spark, mixed, monkeypatch, order, zone):
    monkeypatch.setattr(paging, "PASSED", 40)
    monkeypatch.setattr(paging, "RANGES", 8)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        want, pages = whole(mixed, order), Pages(mixed, *order)
        for offset in (0, 39, 41, 1000, 3117, 5975, 5999, 6000, 7000):
            got = [tuple(r) for r in pages.page(50, offset).collect()]
            # NaN differs from itself, its text does not
            assert repr(got) == repr(want[offset : offset + 50]), offset
        assert repr([tuple(r) for r in pages.page(4000, 1500).collect()]) == repr(want[1500:5500])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_counts_are_kept_and_ranges_are_small(spark, mixed, monkeypatch):
    monkeypatch.setattr(paging, "PASSED", 100)
    pages = Pages(mixed, asc("id"))
    pages.page(10, 3000).collect()
    root = pages._root
    assert sum(r.size for r in root.parts) == root.size == 6000
    assert [r.start for r in root.parts] == [sum(x.size for x in root.parts[:i]) for i in range(len(root.parts))]
    before = [id(r.parts) for r in root.parts]
    pages.page(10, 3010).collect()
    assert before == [id(r.parts) for r in root.parts]


def test_a_page_reads_only_its_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paging, "PASSED", 500)
    path = str(tmp_path / "t")
    spark.range(40_000).select("id", F.md5(F.col("id").cast("string")).alias("v")).repartitionByRange(16, "id").write.parquet(path)
    df = spark.read.parquet(path)
    got = Pages(df, asc("id")).page(25, 20_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan
    assert "TakeOrderedAndProject" in plan and "Exchange range" not in plan
    assert [r.id for r in got.collect()] == list(range(20_000, 20_025))


def test_the_first_page_needs_no_count(spark, mixed, monkeypatch):
    pages = Pages(mixed, asc("id"))
    monkeypatch.setattr(pages, "_whole", lambda: pytest.fail("counted"))
    assert pages.page(25, 100).count() == 25


def test_rows_that_do_not_divide(spark, monkeypatch):
    """All order columns agree on more rows than a page may pass."""
    monkeypatch.setattr(paging, "PASSED", 10)
    df = spark.range(500).select(F.lit(1).alias("k"), "id")
    assert page(df, 7, 490, desc("k")).count() == 7
    assert page(df.where("id < 0"), 7, 490, desc("k")).count() == 0


def test_a_far_page_divides_by_the_leading_column_and_keeps_its_range(spark, monkeypatch):
    monkeypatch.setattr(paging, "PASSED", 100)
    n = F.col("id")
    df = spark.range(0, 60_000, 1, 4).select((n % 300).alias("day"), F.md5(n.cast("string")).alias("name"))
    pages = Pages(df, desc("day"), asc("name"))
    wanted = [tuple(r) for r in df.orderBy(F.desc("day"), "name").offset(30_030).limit(20).collect()]
    assert [tuple(r) for r in pages.page(20, 30_030).collect()] == wanted
    assert all(len(r.upper or "x") == 1 for r in pages._root.parts)
    kept = [r for r in pages._root.parts if r.rows is not None]
    assert [r.rows.count() for r in kept] == [r.size for r in kept] and len(kept) == 1
