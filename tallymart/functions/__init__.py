"""Column helpers shared by the plans."""

from tallymart.functions.bands import delivery_timing, spend_band, two_day_bucket
from tallymart.functions.days import whole_days
from tallymart.functions.money import exact_avg, exact_sum, rounded_ratio

__all__ = [
    "delivery_timing",
    "exact_avg",
    "exact_sum",
    "rounded_ratio",
    "spend_band",
    "two_day_bucket",
    "whole_days",
]
