"""Exact order statistics of numbers, by radix selection.

A DOUBLE is mapped to a whole number of 64 bits that sorts the same.  Each pass counts the values
by the next 16 of these bits among those whose earlier bits are the ones a wanted rank fell
into.  So a pass combines on the map side, leaves at most 65,536 groups per column and rank,
moves no value, and four of them settle every rank; fewer do where the values of a group
turn out to be equal.  Nothing is sampled, sketched or sorted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.rules import quoted

#: Bits of a number that a pass looks at.
DIGIT = 16
COLUMN, KEY, VALUE = "column_index", "sort_key", "value"
# The layout of a 64-bit floating-point number.
FRACTION, BIAS = 52, 1023
LEAST_NORMAL = 2.0**-1022


def sort_key(value: Column) -> Column:
    """A BIGINT for each DOUBLE, in the same order; equal values (0.0 and -0.0 too) get the same.

    NaN sorts last, as in Spark.  The number's exponent and fraction are computed, not reinterpreted, so
    the expression stays within generated code; every step of it is exact.
    """
    value = value.cast("double")
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    two = F.lit(2.0)
    # the logarithm may round across a whole number
    exponent = guess + F.when(F.pow(two, guess) > size, -1).when(F.pow(two, guess + 1) <= size, 1).otherwise(0)
    # in two steps, as the power for the least numbers is beyond a DOUBLE
    half = F.floor(-exponent / 2)
    fraction = size * F.pow(two, half) * F.pow(two, -exponent - half) - 1
    normal = F.shiftleft((exponent + BIAS).cast("long"), FRACTION) + (fraction * 2.0**FRACTION).cast("long")
    subnormal = (size * 2.0**537 * 2.0**537).cast("long")
    infinite = F.lit((2 * BIAS + 1) << FRACTION)
    magnitude = (
        F.when(size == float("inf"), infinite).when(size < LEAST_NORMAL, subnormal).otherwise(normal)
    )
    return F.when(F.isnan(value), F.lit(2**63 - 1)).when(value < 0, -magnitude).otherwise(magnitude)


@dataclass
class Statistics:
    """Values, least and greatest one, and the value at each wanted share (None without values)."""

    count: int
    least: float | None
    greatest: float | None
    quantiles: dict[float, float | None]


def order_statistics(df: DataFrame, columns: Iterable[str], shares: Iterable[float]) -> dict[str, Statistics]:
    """Per column the exact quantiles: the least value with at least that share of the values not above it.

    NULLs are left out; a share of 0 gives the least value.  A column without values has none.
    """
    columns, shares = list(columns), list(shares)
    pairs = [F.struct(F.lit(i).alias(COLUMN), F.col(quoted(c)).cast("double").alias(VALUE)) for i, c in enumerate(columns)]
    long = df.select(F.explode(F.array(*pairs)).alias("r")).select("r.*").where(F.col(VALUE).isNotNull())
    keyed = long.withColumn(KEY, sort_key(F.col(VALUE)))
    out = {c: Statistics(0, None, None, dict.fromkeys(shares)) for c in columns}
    # (column, earlier bits) -> the shares whose rank falls there and the rank within
    wanted: dict[tuple[int, int], list[tuple[float, int]]] = {}
    shift = 64
    while True:
        rows = keyed
        if shift < 64:
            if not wanted:
                return out
            prefix = F.shiftright(F.col(KEY), shift)
            by_column = defaultdict(list)
            for i, bits in wanted:
                by_column[i].append(bits)
            # at most one group per column and share
            rows = rows.where(reduce(or_, ((F.col(COLUMN) == i) & prefix.isin(b) for i, b in by_column.items())))
        shift -= DIGIT
        digit = F.shiftright(F.col(KEY), shift).alias("bits")
        groups = (
            rows.groupBy(COLUMN, digit)
            .agg(F.count(F.lit(1)).alias("n"), F.min(VALUE).alias("low"), F.max(VALUE).alias("high"))
            .collect()  # at most 65,536 rows per column and rank
        )
        groups.sort(key=lambda g: (g[COLUMN], g.bits))
        if shift == 64 - DIGIT:
            for i, c in enumerate(columns):
                mine = [g for g in groups if g[COLUMN] == i]
                if mine:
                    total = sum(g.n for g in mine)
                    out[c].count, out[c].least, out[c].greatest = total, mine[0].low, mine[-1].high
                    wanted[i, 0] = [(q, max(1, ceil(total * q))) for q in shares]
        found: dict[tuple[int, int], list[tuple[float, int]]] = {}
        inside = defaultdict(list)
        for g in groups:
            above = 0 if shift == 64 - DIGIT else g.bits >> DIGIT
            inside[g[COLUMN], above].append(g)
        for (i, bits), ranks in wanted.items():
            for q, rank in ranks:
                for g in inside[i, bits]:
                    if rank <= g.n:
                        break
                    rank -= g.n
                if shift == 0 or g.low == g.high:
                    out[columns[i]].quantiles[q] = g.low
                else:
                    found.setdefault((i, g.bits), []).append((q, rank))
        wanted = found
