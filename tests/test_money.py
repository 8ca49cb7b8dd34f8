from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tallymart.functions import exact_avg, exact_sum, rounded_ratio


def test_sum_is_exact_in_any_order(spark):
    rng = random.Random(7)
    amounts = [rng.randrange(-10**9, 10**11) / 100 for _ in range(5000)]
    expected = float(sum(Decimal(repr(a)) for a in amounts))
    for parts in (1, 7, 64):
        df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(parts)
        assert df.agg(exact_sum("x")).first()[0] == expected


def test_fractions_of_a_cent_are_kept(spark):
    df = spark.createDataFrame([(0.005,)] * 3 + [(0.0001,), (-0.125,)], "x double")
    assert math.isclose(df.agg(exact_sum("x")).first()[0], -0.1099, abs_tol=1e-9)


def test_null_handling(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "x double, y double")
    row = df.agg(exact_sum("x"), exact_sum("y"), exact_sum("x", "y"), exact_avg("x")).first()
    assert tuple(row) == (None, 1.0, None, None)


def test_ratio_rounds_ties_away_from_zero(spark):
    cases = [(2099757.9, 12), (1.005, 1), (-1.005, 1), (10.0, 3), (0.0, 5), (0.05, 10)]
    df = spark.createDataFrame(cases, "x double, n bigint")
    found = [r[0] for r in df.select(rounded_ratio(F.col("x"), F.col("n"))).collect()]
    expected = [
        float((Decimal(repr(x)) / n).quantize(Decimal("0.01"), ROUND_HALF_UP)) for x, n in cases
    ]
    assert found == expected
    zero = spark.createDataFrame([(1.0, 0), (None, 0)], "x double, n bigint")
    assert [r[0] for r in zero.select(rounded_ratio(F.col("x"), F.col("n"))).collect()] == [None, None]


def test_values_that_are_no_amounts_show_in_the_sum(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1.5, 1e300), (2.0, float("-inf"), 1.0), (None, 0.1, None)],
        "x double, y double, z double",
    )
    total = df.agg(exact_sum("x"), exact_sum("y"), exact_sum("z"), exact_avg("z")).first()
    assert math.isnan(total[0]) and tuple(total)[1:] == (float("-inf"), 1e300, 5e299)
    only_nan = df.filter("isnan(x)").agg(exact_sum("x")).first()[0]
    assert math.isnan(only_nan)
    ratio = df.select(rounded_ratio(F.col("x"), F.lit(2))).collect()
    assert math.isnan(ratio[0][0]) and [r[0] for r in ratio][1:] == [1.0, None]


def test_nothing_is_rounded_away_and_nothing_overflows(spark):
    small = spark.range(1_000_000).select(F.lit(1e-7).alias("x"))
    assert math.isclose(small.agg(exact_sum("x")).first()[0], 0.1, rel_tol=1e-9)
    large = spark.range(2000).select(F.lit(9e15).alias("x"), F.lit(8.9e9).alias("y"))
    row = large.agg(exact_sum("x"), F.sum("x"), exact_sum("y"), exact_avg("x")).first()
    assert row[0] == row[1] == 1.8e19 and row[2] == 1.78e13 and row[3] == 9e15
    mixed = spark.createDataFrame([(-0.01, ), (-5e9,), (1e-9,), (0.25,)], "x double")
    assert math.isclose(mixed.agg(exact_sum("x")).first()[0], -4999999999.76, rel_tol=1e-15)
    ratio = spark.createDataFrame([(2e18, 2), (1.0, 10**17)], "x double, n bigint")
    found = [r[0] for r in ratio.select(rounded_ratio(F.col("x"), F.col("n"))).collect()]
    assert found == [1e18, 0.0]
