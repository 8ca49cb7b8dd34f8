"""Read-only profiling of a table: completeness, distributions, ratios, quantiles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators.quantiles import order_statistics
from tallymart.operators.rules import any_of, quoted

# Output name and place of the quartiles.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def completeness(df: DataFrame, columns: dict[str, str], total: str = "total_rows") -> DataFrame:
    """Rows and non-NULL values per column; ``columns`` maps a column to its output name."""
    return df.agg(
        F.count(F.lit(1)).alias(total), *[F.count(F.col(quoted(c))).alias(name) for c, name in columns.items()]
    )


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows and NULLs per column, in one pass over the named (default: all) columns."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(f"{c}_nulls") for c in columns or df.columns],
    )


def conditional_counts(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """Rows and the number of rows that meet each condition (SQL predicates by output name)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.expr(f"count_if({test})").alias(name) for name, test in conditions.items()],
    )


def value_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (NULL is a value), most frequent first."""
    return df.groupBy(*columns).count().orderBy(F.desc("count"), *[F.asc(c) for c in columns])


def missing_by_group(df: DataFrame, group: str, column: str, total: str, name: str) -> DataFrame:
    """Rows and NULLs of ``column`` per group, biggest group first."""
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias(total), F.count_if(F.col(column).isNull()).alias(name))
        .orderBy(F.desc(total), F.asc(group))
    )


def combination_counts(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """Rows per combination of computed booleans (SQL predicates by output name)."""
    tests = [f"{test} AS {quoted(name)}" for name, test in flags.items()]
    return df.selectExpr(*tests).groupBy(*flags).count()


def share(df: DataFrame, base: str, part: str) -> DataFrame:
    """Rows in ``base``, those that also meet ``part``, and the percentage (NULL for an empty base)."""
    counts = df.agg(
        F.expr(f"count_if({base}) AS base_rows"),
        F.expr(f"count_if(({base}) AND ({part})) AS part_rows"),
    )
    return counts.selectExpr("*", "try_divide(part_rows * 100.0D, base_rows) AS percentage")


def out_of_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which a later stage has an earlier timestamp than the stage before it."""
    steps = zip(columns, columns[1:])
    return df.filter(any_of(f"{later} < {earlier}" for earlier, later in steps))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_first(column))


def distribution(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per numeric column: count, minimum, exact quartiles (values that occur), maximum.

    A quartile is the least value with at least that part of the values not above it.  The
    figures are computed when the function is called, by ``quantiles.order_statistics``.
    """
    columns = list(columns)
    found = order_statistics(df, columns, QUARTILES.values())
    rows = [(c, s.count, s.least, *(s.quantiles[q] for q in QUARTILES.values()), s.greatest) for c, s in found.items()]
    quartiles = ", ".join(f"{name} double" for name in QUARTILES)
    schema = f"column_name string, value_count long, min_value double, {quartiles}, max_value double"
    return df.sparkSession.createDataFrame(rows, schema)


def summary(df: DataFrame, *columns: str) -> DataFrame:
    """Spark's own text summary of the same figures."""
    return df.select(*columns).summary("count", "min", "25%", "50%", "75%", "max")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
