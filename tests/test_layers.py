"""The batch job over real tables: ingest from CSV, silver, gold, reports over the written marts."""

from __future__ import annotations

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from tallymart.plans import layers, reports, state
from tallymart.plans.gold import GoldPlan
from tallymart.plans.silver import FLAGS, KEYS, SilverPlan
from tallymart.sources.adapters import ADAPTERS, BronzePlan, bronze_from_layer
from tallymart.sources import versions
from tallymart.sources.ingest import MULTILINE, IngestOptions, ingest_folder


@pytest.fixture(scope="module")
def lazy(spark):
    bronze = BronzePlan(spark, DATA)
    silver = SilverPlan(bronze)
    return bronze, silver, GoldPlan(silver)


@pytest.fixture(scope="module")
def built(spark, lazy):
    names = layers.LayerNames(silver="t_silver", gold="t_gold")
    return layers.build_layers(spark, lazy[0], names, cluster=True)


def test_written_marts_equal_the_lazy_ones(built, lazy):
    for mart in ("sales", "customers", "deliveries"):
        assert rows(getattr(built, mart)) == rows(getattr(lazy[2], mart)), mart


def test_persisted_entities_pass_their_check(spark, built, lazy):
    silver = layers.silver_tables(spark, "t_silver")
    for entity, flags in FLAGS.items():
        check = layers.verify_persisted(getattr(silver, entity), entity).first()
        again = layers.verify_persisted(getattr(lazy[1], entity), entity).first()
        assert check == again and check["total_rows"] == getattr(lazy[0], entity).count()
        assert set(flags) <= set(check.asDict())
        assert ("distinct_keys" in check.asDict()) == bool(KEYS[entity])


def test_reports_run_over_written_marts(spark, built, lazy):
    gold = layers.gold_tables(spark, "t_gold")
    for report in (reports.overview_kpis, reports.gold_null_counts, reports.customer_detail):
        assert rows(report(gold)) == rows(report(lazy[2]))


def test_state_of_the_marts_is_read_from_statistics(spark, built):
    gold = layers.gold_tables(spark, "t_gold")
    pairs = [
        (state.table_counts, reports.gold_table_counts),
        (state.freshness, reports.gold_freshness),
        (state.null_counts, reports.gold_null_counts),
    ]
    for of_statistics, of_rows in pairs:
        found = of_statistics(spark, "t_gold")
        assert rows(found) == rows(of_rows(gold))
        assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(versions.NotVersioned):
        state.table_counts(spark, "default")


def test_each_source_is_read_once(spark, lazy, monkeypatch):
    """Rows of the source are counted by the job that writes, so parity needs no read of its own."""
    monkeypatch.setattr(layers, "assert_row_parity", lambda *a: pytest.fail("read again"))
    layers.build_silver(spark, lazy[0], "t_once")
    lost = layers.Observation()
    source = lazy[0].sellers.observe(lost, F.count(F.lit(1)).alias("source_rows"))
    with pytest.raises(layers.VerificationError, match="source_rows"):
        layers.write_verified(source.where("seller_state = 'SP'"), "t_once.lost", "parquet", source=lost)


def test_unknown_bronze_entity(spark):
    with pytest.raises(AttributeError):
        BronzePlan(spark, DATA).nothing


def test_from_csv_files_to_reports(spark, lazy, tmp_path):
    """Bronze written as CSV files, ingested, and built again gives the same customer mart."""
    bronze, _, gold = lazy
    names = {
        entity: f"olist_{entity}_dataset.csv" for entity in ADAPTERS
    }
    for entity, name in names.items():
        getattr(bronze, entity).toPandas().to_csv(tmp_path / name, index=False)
    options = IngestOptions(layer="csv_bronze", reader=MULTILINE)
    results = ingest_folder(spark, str(tmp_path), options)
    assert {r.status for r in results} == {"SUCCESS"} and len(results) == 7
    layer_names = layers.LayerNames("csv_bronze", "csv_silver", "csv_gold")
    rebuilt = layers.build_layers(spark, bronze_from_layer(spark, "csv_bronze"), layer_names)
    assert rebuilt.customers.count() == gold.customers.count()
    assert rows(reports.overview_kpis(rebuilt)) == rows(reports.overview_kpis(gold))


def test_a_failing_check_keeps_the_old_table(spark, built):
    old = spark.table("t_silver.sellers")
    fewer = old.limit(3)
    with pytest.raises(AssertionError):
        layers.write_verified(fewer, "t_silver.sellers", "parquet", source=old)
    twice = old.unionByName(old)
    with pytest.raises(layers.VerificationError):
        layers.write_verified(twice, "t_silver.sellers", "parquet", key=KEYS["sellers"], unique=True)
    assert spark.table("t_silver.sellers").count() == old.count() > 3
    # what failed stays beside it, unpublished
    last = versions.versions(spark, "t_silver.sellers")[-1]
    assert spark.table(last).count() == 2 * old.count()


def test_keys_that_may_repeat_are_not_counted(spark, monkeypatch):
    from tallymart.operators.integrity import grain_check

    asked = []

    def noted(df, keys, flags=()):
        asked.append(dict(keys))
        return grain_check(df, keys, flags)

    monkeypatch.setattr(layers, "grain_check", noted)
    layers.create_layer(spark, "keyed")
    df = spark.createDataFrame([("a", True), ("b", None)], "k string, f boolean")
    layers.write_verified(df, "keyed.free", flags=["f"], key=["k"])
    layers.write_verified(df, "keyed.bound", flags=["f"], key=["k"], unique=True)
    assert asked == [{}, {"distinct_keys": ["k"]}]
