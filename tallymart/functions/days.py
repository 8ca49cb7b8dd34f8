from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: str, end: str) -> Column:
    """Complete 24-hour periods from ``start`` to ``end``, cut toward zero; NULL if either is NULL."""
    return F.timestamp_diff("DAY", F.col(start), F.col(end))
