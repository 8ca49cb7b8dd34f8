"""Top-k, pages and page arithmetic."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.distinct import stored
from tallymart.operators.rules import quoted

# The page sizes offered for detail tables.
PAGE_SIZES = (25, 50, 100)
# Rows that a page's task may have to pass before the page begins.
PASSED = 2000
# Ranges into which one pass divides the rows, and rows looked at per range to choose where.
RANGES, LOOKED_AT = 64, 20
# Part of all rows that a range may have at most for its rows to be kept while it is divided.
KEPT = 1 / 8


@dataclass(frozen=True)
class PageBounds:
    page: int
    max_page: int
    offset: int
    size: int


def page_bounds(total: int, size: int = PAGE_SIZES[0], page: int = 1) -> PageBounds:
    """Page number kept within 1..max_page and the row offset at which the page starts."""
    size = max(1, int(size))
    max_page = max(1, -(-int(total) // size))
    page = min(max(1, int(page)), max_page)
    return PageBounds(page, max_page, (page - 1) * size, size)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` (at least one) rows of a total order; each task keeps its own n best rows only."""
    return df.orderBy(*order).limit(max(1, int(n)))


@dataclass(frozen=True)
class Key:
    """A column to order by.  NULLs come first in ascending order and last in descending order."""

    name: str
    descending: bool = False

    def column(self) -> Column:
        found = F.col(quoted(self.name))
        return found.desc_nulls_last() if self.descending else found.asc_nulls_first()


def asc(name: str) -> Key:
    return Key(name)


def desc(name: str) -> Key:
    return Key(name, descending=True)


@dataclass
class Range:
    """Rows from ``lower`` (included) to ``upper`` (not), both in order; None: open.  ``start`` rows come
    before them, ``size`` are in it; ``parts`` divide it, once they were asked for; ``rows`` are its
    stored rows or those of a range around it, which ends ``within`` so many rows of all."""

    lower: tuple | None
    upper: tuple | None
    start: int
    size: int
    parts: list[Range] | None = None
    rows: DataFrame | None = None
    within: int = 0


class Pages:
    """Any page of a totally ordered result, however far down, without sorting or copying all of it.

    Rows are counted by range of the order: a pass chooses up to ``RANGES`` - 1 rows that occur as
    the borders, from a small sample (any choice gives the same pages), and a second counts exactly the
    rows between them.  All rows are first divided by the leading column alone, so that a result with
    joins moves nothing else for it.  The range that the page begins in is divided again until at most
    ``PASSED`` of its rows come before the page; a range of at most ``KEPT`` of all rows is stored
    before that, so that the result is not computed again for each pass.  Then only the rows from its first to the page's last
    border are read: the borders are range predicates on the order columns, which
    reach the files, and a heap of ``PASSED`` rows and a page finds the page among them.  The first
    page needs no pass but the last one.  Counts stay with the object, for further pages.

    The order should end with a key.  Rows that agree in every order column are not divided;
    if more than ``PASSED`` of them do, the heap has to hold them.
    """

    def __init__(self, df: DataFrame, *order: Key) -> None:
        self.df, self.order = df, order
        self._root: Range | None = None

    def page(self, limit: int, offset: int) -> DataFrame:
        limit, offset = max(1, int(limit)), max(0, int(offset))
        start, lower, upper, source = 0, None, None, self.df
        if offset > PASSED:
            here = self._whole()
            if offset >= here.size:
                return self.df.limit(0)
            stop = min(offset + limit, here.size)
            while offset - here.start > PASSED and self._divided(here):
                if stop <= here.start + here.size:  # else the page runs on, to the border found before
                    upper = next(r for r in here.parts if stop <= r.start + r.size).upper
                here = next(r for r in here.parts if offset < r.start + r.size)
            start, lower = here.start, here.lower
            if here.rows is not None and stop <= here.within:
                source = here.rows
        columns = [k.column() for k in self.order]
        rows = source.filter(self._within(lower, upper))
        return rows.orderBy(*columns).offset(offset - start).limit(limit)

    def _whole(self) -> Range:
        if self._root is None:
            self._root = Range(None, None, 0, self.df.count())
        return self._root

    def _divided(self, here: Range) -> bool:
        """Counts the parts of a range; False where it does not divide."""
        if here.parts is None:
            if here is self._root:
                here.parts = self._parts(here, 1)
            elif here.rows is None and here.size <= KEPT * self._root.size:
                rows = self.df.filter(self._within(here.lower, here.upper))
                here.rows, here.within = stored(rows, "range"), here.start + here.size
            if here.parts is None or len(here.parts) < 2:
                here.parts = self._parts(here, len(self.order))
        return len(here.parts) > 1

    def _parts(self, here: Range, leading: int) -> list[Range]:
        """The parts of a range by so many leading columns of the order."""
        rows = (self.df if here.rows is None else here.rows).filter(self._within(here.lower, here.upper))
        borders = self._borders(rows, here.size, leading)
        place = self._place(borders, 0, len(borders)).alias("place")
        counts = {r.place: r["count"] for r in rows.groupBy(place).count().collect()}
        parts, start = [], here.start
        edges = [here.lower, *borders, here.upper]
        for i, (lower, upper) in enumerate(zip(edges, edges[1:])):
            size = counts.get(i, 0)
            if size:
                parts.append(Range(lower, upper, start, size, rows=here.rows, within=here.within))
            start += size
        return parts

    def _borders(self, rows: DataFrame, size: int, leading: int) -> list[tuple]:
        share = min(1.0, RANGES * LOOKED_AT / size)
        types = {f.name: f.dataType for f in self.df.schema.fields}
        order = self.order[:leading]
        sample = rows.select(*[quoted(k.name) for k in order]).sample(share, seed=7)
        sample = sample.orderBy(*[k.column() for k in order])
        found = sample.select(*[_held(k.name, types[k.name]) for k in order]).collect()
        step = max(1, len(found) // RANGES)
        return list(dict.fromkeys(tuple(r) for r in found[step::step]))

    def _place(self, borders: list[tuple], low: int, high: int) -> Column:
        """How many of the borders a row is not before, by bisection."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        left, right = self._place(borders, low, middle), self._place(borders, middle + 1, high)
        return F.when(self._from(borders[middle]), right).otherwise(left)

    def _within(self, lower: tuple | None, upper: tuple | None) -> Column:
        found = F.lit(True)
        if lower is not None:
            found = self._reaching(lower, after=True) & self._from(lower)
        if upper is not None:
            found = found & self._reaching(upper, after=False) & ~self._from(upper)
        return found

    def _reaching(self, border: tuple, after: bool) -> Column:
        """What the first order column tells on its own: simple enough for the files' statistics."""
        key, value = self.order[0], self._literal(self.order[0], border[0])
        column = F.col(quoted(key.name))
        if border[0] is None:
            return F.lit(True)
        if after != key.descending:
            return column >= value
        # the other side is where NULLs are
        return column.isNull() | (column <= value)

    def _from(self, border: tuple) -> Column:
        """Whether a row is the border or comes after it.  Never NULL."""

        def further(rest: Column | None, part: tuple[Key, object]) -> Column:
            key, held = part
            column, value = F.col(quoted(key.name)), self._literal(key, held)
            if held is None:
                # NULLs first: all values come after; NULLs last: nothing does
                after = F.lit(False) if key.descending else column.isNotNull()
                same = column.isNull()
            else:
                after = column.isNull() | (column < value) if key.descending else column > value
                same = column == value
            found = after | (same if rest is None else same & rest)
            return F.coalesce(found, F.lit(False))

        return reduce(further, list(zip(self.order, border))[::-1], None)

    def _literal(self, key: Key, held: object) -> Column:
        kind = self.df.schema[key.name].dataType
        value = F.lit(held)
        return F.timestamp_micros(value) if isinstance(kind, T.TimestampType) else value.cast(kind)


def _held(name: str, kind: T.DataType) -> Column:
    """A column in a form that comes to the driver and back as it was, whatever the time zones."""
    column = F.col(quoted(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).alias(name)
    return (column.cast("string") if isinstance(kind, T.TimestampNTZType) else column).alias(name)


def page(df: DataFrame, limit: int, offset: int, *order: Key) -> DataFrame:
    """Rows offset+1 .. offset+limit of a total order; see ``Pages``, which serves several."""
    return Pages(df, *order).page(limit, offset)
