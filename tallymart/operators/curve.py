"""Clustering by several columns at once: a space-filling curve over ranges of their values.

Sorting by (a, b, c) keeps rows of one ``a`` together and spreads each ``b`` over all files.  Here the
values of each column are cut into ranges of about as many rows, and the bits of the range numbers
are interleaved into one number; rows near each other in that number are near in every column.
So files narrow each column, and a filter on any of them, or on two, skips most files.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.rules import quoted

#: Bits of a range number, so 2**BITS ranges a column, and rows looked at to choose their borders.
BITS, LOOKED_AT = 5, 20_000


@dataclass(frozen=True)
class Curve:
    """Columns to interleave, most filtered first, and the key that orders rows of one place."""

    columns: tuple[str, ...]
    key: tuple[str, ...] = ()


def borders(df: DataFrame, columns: Iterable[str], bits: int = BITS) -> dict[str, list]:
    """Per column up to 2**bits - 1 values that divide its rows about evenly, as SQL text casts them.

    From a sample of about ``LOOKED_AT`` rows: any borders give a right clustering, better ones a
    more even one.  A value that many rows have is a border once.
    """
    columns = list(columns)
    share = min(1.0, LOOKED_AT / max(1, df.count()))
    sample = df.select(*[F.col(quoted(c)) for c in columns]).sample(share, seed=11).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in sample if r[i] is not None)
        places = [len(values) * k // (1 << bits) for k in range(1, 1 << bits)] if values else []
        out[c] = sorted({values[p] for p in places})
    return out


def rank(column: Column, edges: list) -> Column:
    """How many borders a value is not below, by bisection; NULLs are before all."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(edges[middle]), within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(edges))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """One number with the bits of all ranks in turn, the highest ones first."""
    out = F.lit(0)
    for j, r in enumerate(ranks):
        for i in range(bits):
            place = i * len(ranks) + len(ranks) - 1 - j
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, i).bitwiseAND(F.lit(1)), place))
    return out


def along(df: DataFrame, curve: Curve, bits: int = BITS) -> DataFrame:
    """Rows dealt out by ranges of the curve, and sorted along it.  Reads ``df`` three times (count, sample
    and the exchange's own sample come before the rows), so hand in what is stored."""
    edges = borders(df, curve.columns, bits)
    place = interleaved([rank(F.col(quoted(c)), edges[c]) for c in curve.columns], bits)
    name = "__place"
    order = [F.col(name), *[F.col(quoted(c)) for c in (*curve.columns, *curve.key)]]
    rows = df.withColumn(name, place)
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(name)
