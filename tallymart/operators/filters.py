"""Report filters.  Each turns its optional arguments into one Column predicate; no SQL text is built."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(value: date | datetime | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(str(value))


def one_of(column: str, values: Iterable[str] | None) -> Column | None:
    """IN list of the stripped, non-blank values; no predicate when none is left."""
    kept = [text for text in (str(v).strip() for v in values or [] if v is not None) if text]
    return F.col(column).isin(kept) if kept else None


def day_range(column: str, start, end) -> list[Column]:
    """Inclusive calendar-day limits; Catalyst turns the date cast into a timestamp range for the scan."""
    day = F.to_date(F.col(column))
    limits = []
    if start:
        limits.append(day >= F.lit(to_day(start)))
    if end:
        limits.append(day <= F.lit(to_day(end)))
    return limits


def all_of(predicates: Iterable[Column | None]) -> Column:
    """AND of the given predicates; TRUE when there is none."""
    return reduce(and_, (p for p in predicates if p is not None), F.lit(True))


@dataclass(frozen=True)
class SalesFilter:
    start_date: date | datetime | str | None = None
    end_date: date | datetime | str | None = None
    order_statuses: Iterable[str] | None = None
    seller_states: Iterable[str] | None = None
    product_categories: Iterable[str] | None = None

    def predicate(self) -> Column:
        return all_of(
            [
                *day_range("order_purchase_timestamp", self.start_date, self.end_date),
                one_of("order_status", self.order_statuses),
                one_of("seller_state", self.seller_states),
                one_of("product_category_name", self.product_categories),
            ]
        )


@dataclass(frozen=True)
class CustomerFilter:
    """A minimum of 0 is a predicate (it removes NULLs); only None and '' mean "not set"."""

    customer_states: Iterable[str] | None = None
    minimum_total_spend: float | int | str | None = None
    minimum_total_orders: int | str | None = None

    def predicate(self) -> Column:
        spend, orders = self.minimum_total_spend, self.minimum_total_orders
        return all_of(
            [
                one_of("customer_state", self.customer_states),
                None if spend in (None, "") else F.col("total_spend") >= float(spend),
                None if orders in (None, "") else F.col("total_orders") >= int(orders),
            ]
        )


@dataclass(frozen=True)
class DeliveryFilter:
    start_date: date | datetime | str | None = None
    end_date: date | datetime | str | None = None
    order_statuses: Iterable[str] | None = None

    def predicate(self) -> Column:
        return all_of(
            [
                *day_range("order_purchase_timestamp", self.start_date, self.end_date),
                one_of("order_status", self.order_statuses),
            ]
        )
