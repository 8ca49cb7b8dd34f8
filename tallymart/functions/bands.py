"""Display bands of the reports, each with an ordinal to sort by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limit (exclusive) and label of each spend band, then the open last band.
SPEND_BANDS = [
    (100, "0-99"),
    (250, "100-249"),
    (500, "250-499"),
    (1000, "500-999"),
    (2000, "1,000-1,999"),
]
TOP_SPEND_BAND = "2,000+"

# Labels by the sign of days_late.
EARLY, ON_TIME, LATE = "Early", "On time", "Late"


def spend_band(spend: Column) -> tuple[Column, Column]:
    """(label, ordinal).  A NULL spend passes no limit and lands in the open last band."""
    label: Column | None = None
    ordinal: Column | None = None
    for position, (limit, text) in enumerate(SPEND_BANDS, start=1):
        below = spend < limit
        label = F.when(below, text) if label is None else label.when(below, text)
        ordinal = F.when(below, position) if ordinal is None else ordinal.when(below, position)
    return label.otherwise(TOP_SPEND_BAND), ordinal.otherwise(len(SPEND_BANDS) + 1)


def delivery_timing(days_late: Column) -> tuple[Column, Column]:
    """(label, ordinal) by the sign of the lateness; NULL stays NULL."""
    step = F.signum(days_late)
    label = F.when(step < 0, EARLY).when(step == 0, ON_TIME).when(step > 0, LATE)
    return label, (step + 2).cast("int")


def two_day_bucket(days: Column) -> tuple[Column, Column]:
    """First and last day of the two-day bucket that holds ``days``."""
    first = (F.floor(days / 2) * 2).cast("int")
    return first, (first + 1).cast("int")
