"""Key, grain and reference checks."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators.rules import quoted
from tallymart.operators.lookups import split_join


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys without a parent.  Copies of a key are merged before the shuffle."""
    return child.select(key).distinct().join(parent.select(key).distinct(), key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Every child row without a parent, rows with a NULL key included."""
    return split_join(child, parent.select(key).distinct(), key, "left_anti")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key groups that hold more than one row (NULL counts as a value)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def key_profile(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """Rows and distinct keys on one row; keys with a NULL part are not counted."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(*[F.col(k) for k in keys]).alias(name),
    )


def distinct_key_count(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """Distinct keys, a NULL key counted as one value."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(name))


def sequence_profile(df: DataFrame, parent_key: str, number: str) -> DataFrame:
    """Rows per parent and the highest line number."""
    return df.groupBy(parent_key).agg(
        F.count(F.lit(1)).alias("item_rows"), F.max(number).alias(f"max_{number}")
    )


def longest_sequences(df: DataFrame, parent_key: str, number: str, n: int = 10) -> DataFrame:
    return (
        sequence_profile(df, parent_key, number)
        .orderBy(F.desc("item_rows"), F.asc(parent_key))
        .limit(n)
    )


def sequence_violations(df: DataFrame, parent_key: str, number: str) -> DataFrame:
    """Parents whose line numbers cannot be 1..n: row count and highest number differ."""
    return (
        sequence_profile(df, parent_key, number)
        .filter(F.col("item_rows") != F.col(f"max_{number}"))
        .orderBy(F.desc("item_rows"), F.asc(parent_key))
    )


def row_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of two tables on one row and whether they agree."""
    sides = source.select(F.lit(True).alias("is_source")).unionAll(
        target.select(F.lit(False).alias("is_source"))
    )
    return sides.agg(
        F.count_if("is_source").alias("source_rows"),
        F.count_if(~F.col("is_source")).alias("target_rows"),
    ).withColumn("rows_match", F.col("source_rows") == F.col("target_rows"))


def assert_row_parity(source: DataFrame, target: DataFrame, label: str) -> int:
    """Raise when rows were lost or added; returns the common row count."""
    counts = row_parity(source, target).first()
    if not counts["rows_match"]:
        raise AssertionError(
            f"{label}: {counts['source_rows']} source rows but {counts['target_rows']} target rows"
        )
    return counts["target_rows"]


def grain_check(
    df: DataFrame, keys: dict[str, Iterable[str]], flags: Iterable[str] = ()
) -> DataFrame:
    """Rows, distinct keys of one or more grains and flag counts, all on one row.

    Keys with a NULL part are not counted.  Rows are merged by the widest key first, then by
    the narrower ones, each of which must be part of the one before: rows are never repeated
    as they are for several distinct counts in one aggregate.
    """
    grains = sorted(((name, list(columns)) for name, columns in keys.items()), key=lambda g: -len(g[1]))
    flags = list(flags)
    counters = {"total_rows": F.count(F.lit(1))}
    counters |= {flag: F.count_if(F.col(quoted(flag))) for flag in flags}
    for name, columns in grains:
        merged = df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(
            *[value.alias(done) for done, value in counters.items()]
        )
        whole = reduce(and_, [F.col(quoted(c)).isNotNull() for c in columns])
        counters = {done: F.sum(F.col(quoted(done))) for done in counters}
        counters[name] = F.count_if(whole)
        df = merged
    order = ["total_rows", *keys, *flags]
    return df.agg(*[F.coalesce(counters[name], F.lit(0)).alias(name) for name in order])


def repeated_persons(gold_customers: DataFrame) -> DataFrame:
    """Persons that appear on more than one row of the customer mart (one row per address)."""
    return gold_customers.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("address_rows")
    ).filter(F.col("address_rows") > 1)
