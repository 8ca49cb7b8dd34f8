"""Order-independent sums of money kept as DOUBLE.

A plain ``sum(double)`` depends on the order in which tasks are merged, so two
runs of the same job can differ in the last digits.  Here an amount that is a
whole number of millionths (within 1e-15 of it) is summed as BIGINT in two halves, which is exact in
any order, stays in whole-stage codegen and costs a fraction of a DECIMAL sum.

All other values (finer or larger ones, NaN, infinities) are added as DOUBLE on
the side, whole, so nothing is rounded away and they show in the result as they
would in a plain sum.  Should a half overflow, the plain sum is the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Below this a millionth is more than a DOUBLE's own step.
LARGEST = "9e9D"
# The lower half holds so many millionths.
HALF = 1 << 26


def _millionths(name: str) -> str:
    return f"rint({name} * 1000000D)"


def _counted(name: str) -> str:
    """Whether the value is a whole number of millionths but for the last digits of a DOUBLE,
    in which a sum such as price + freight differs from the amount it stands for."""
    off = f"abs({_millionths(name)} / 1000000D - {name})"
    return f"(abs({name}) < {LARGEST} AND {off} <= abs({name}) * 1e-15D)"


def _whole(name: str) -> str:
    value = f"CAST({_millionths(name)} AS BIGINT)"
    return f"CASE WHEN {_counted(name)} THEN {value} WHEN {name} IS NOT NULL THEN 0L END"


def _beyond(name: str) -> str:
    return f"CASE WHEN {_counted(name)} THEN 0D ELSE {name} END"


def sum_text(*names: str) -> str:
    """``exact_sum`` as SQL."""
    upper = " + ".join(f"CAST(try_sum(shiftright({_whole(n)}, 26)) AS DECIMAL(20, 0))" for n in names)
    lower = " + ".join(f"CAST(try_sum(({_whole(n)}) & {HALF - 1}L) AS DECIMAL(20, 0))" for n in names)
    beyond = " + ".join(f"sum({_beyond(n)})" for n in names)
    plain = " + ".join(f"sum({n})" for n in names)
    total = f"CAST(({upper}) * {HALF}BD + ({lower}) AS DECIMAL(38, 0))"
    cents = f"CAST({total} div 10000BD AS DOUBLE) / 100D + CAST({total} % 10000BD AS DOUBLE) / 1000000D"
    return f"coalesce(({cents}) + ({beyond}), {plain})"


def exact_sum(*names: str) -> Column:
    """Sum of one DOUBLE money column, or of several added up; NULL if one of them has no value."""
    return F.expr(sum_text(*names))


def exact_avg(name: str) -> Column:
    """Mean of a DOUBLE money column over its non-NULL values."""
    return F.expr(f"try_divide({sum_text(name)}, count({name}))")


def rounded_ratio(amount: Column, n: Column, digits: int = 2) -> Column:
    """amount / n rounded half away from zero; NULL for n = 0.

    Divided as DECIMAL, because a DOUBLE quotient can fall just below a tie; an amount that
    no DECIMAL holds (very large, NaN, infinite) is divided as DOUBLE.
    """
    ratio = F.try_divide(amount.try_cast("decimal(24,6)"), n.try_cast("decimal(15,0)"))
    plain = F.round(F.try_divide(amount, n.cast("double")), digits)
    return F.coalesce(F.round(ratio, digits).cast("double"), plain)
