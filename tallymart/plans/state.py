"""The state of written marts, from the statistics that their last write left: no data is read.

Same columns and rows as ``reports.gold_table_counts``, ``gold_freshness`` and ``gold_null_counts``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.plans.reports import NEWEST, WATCHED
from tallymart.sources.versions import NotVersioned, Statistics, from_held, published


def statistics(spark: SparkSession, layer: str) -> dict[str, Statistics]:
    """Per mart what was observed while the version that readers see was written."""
    found = {mart: published(spark, f"{layer}.{mart}") for mart in NEWEST}
    missing = [mart for mart, version in found.items() if version is None]
    if missing:
        raise NotVersioned(f"{layer} has no versions of {', '.join(missing)}")
    return {mart: version.statistics for mart, version in found.items()}


def table_counts(spark: SparkSession, layer: str) -> DataFrame:
    rows = [(mart, s.rows) for mart, s in statistics(spark, layer).items()]
    return spark.createDataFrame(rows, "table_name string, row_count long")


def freshness(spark: SparkSession, layer: str) -> DataFrame:
    frames = []
    for mart, s in statistics(spark, layer).items():
        column = NEWEST[mart]
        kind = spark.table(f"{layer}.{mart}").schema[column].dataType
        newest = from_held(s.greatest[column], kind).alias("latest_business_timestamp")
        frames.append(spark.range(1).select(F.lit(mart).alias("table_name"), newest))
    return reduce(DataFrame.unionAll, frames)


def null_counts(spark: SparkSession, layer: str) -> DataFrame:
    """The watched fields of each mart; NULL where a mart has no rows, as over a scan."""
    rows = [
        (mart, name, s.nulls[name] if s.rows else None)
        for mart, s in statistics(spark, layer).items()
        for name in WATCHED[mart]
    ]
    schema = "table_name string, field_name string, null_count long"
    return spark.createDataFrame(sorted(rows, key=lambda r: r[:2]), schema)
