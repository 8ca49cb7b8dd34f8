"""Order statistics against sorted lists; sort keys against the numbers' own order."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tallymart.operators import profile
from tallymart.operators.quantiles import order_statistics, sort_key

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def awkward() -> list[float]:
    tiny, huge = 5e-324, 1.7976931348623157e308
    ends = [0.0, -0.0, tiny, -tiny, 2.0**-1022, -(2.0**-1022), 2.0**-1023, huge, -huge, math.inf, -math.inf, math.nan]
    near = [math.nextafter(2.0**e, way) * sign for e in (-1022, -1021, -1, 0, 1, 52, 53, 1023) for way in (0, math.inf) for sign in (1, -1)]
    rng = random.Random(1)
    bits = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(2000)]
    powers = [sign * 2.0**e for e in range(-1074, 1024, 7) for sign in (1, -1)]
    return ends + near + bits + powers


def bits_of(x: float) -> int:
    if math.isnan(x):
        return 2**63 - 1
    magnitude = struct.unpack("<Q", struct.pack("<d", abs(x)))[0]
    return -magnitude if x < 0 else magnitude


def test_sort_keys_are_the_bits_of_the_number(spark):
    values = awkward()
    df = spark.createDataFrame([(x,) for x in values], "v double").withColumn("k", sort_key(F.col("v")))
    got = [r.k for r in df.collect()]
    assert got == [bits_of(x) for x in values]


def at_share(values: list[float], q: float) -> float:
    return sorted(values, key=bits_of)[max(1, math.ceil(len(values) * q)) - 1]


def same(a: float, b: float) -> bool:
    return a == b or (math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize(
    "values",
    [
        awkward(),
        [1.5],
        [2.0] * 500 + [3.0],
        [random.Random(2).gauss(0, 1) for _ in range(3000)],
        [math.nextafter(1.0, 2.0), 1.0, 1.0, math.nextafter(1.0, 0.0)] * 5,
        [1e300, -1e300, 1e-300, 0.0, 7.25],
        [float(i * i) for i in range(-400, 400)],
    ],
)
def test_quantiles(spark, values):
    df = spark.createDataFrame([(x, None if i % 3 else x) for i, x in enumerate(values)], "`a b` double, sparse double")
    found = order_statistics(df.repartition(5), ["a b", "sparse"], SHARES)
    for name, mine in (("a b", values), ("sparse", values[::3])):
        s = found[name]
        assert s.count == len(mine)
        assert same(s.least, at_share(mine, 0)) and same(s.greatest, at_share(mine, 1))
        for q in SHARES:
            assert same(s.quantiles[q], at_share(mine, q)), (name, q)


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "x double, n int")
    found = order_statistics(df, ["x", "n"], [0.5])
    assert (found["x"].count, found["x"].least, found["x"].quantiles) == (0, None, {0.5: None})
    assert (found["n"].count, found["n"].greatest, found["n"].quantiles) == (2, 2.0, {0.5: 1.0})
    assert profile.distribution(df.where("n > 2"), ["x", "n"]).collect()[1].value_count == 0


def test_passes_move_counts_only(spark):
    """No plan of a pass sorts, samples or exchanges values: one exchange of groups each."""
    plans = []
    df = spark.range(20_000).select(F.sqrt("id").alias("v"))
    collect = type(df).collect

    def seen(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    type(df).collect = seen
    try:
        found = order_statistics(df, ["v"], [0.5])["v"]
    finally:
        type(df).collect = collect
    assert found.quantiles[0.5] == math.sqrt(9999)
    assert 2 <= len(plans) <= 4
    for plan in plans:
        assert plan.count("Exchange") == 1 and "Window" not in plan and "Sort" not in plan
        assert "percentile" not in plan
