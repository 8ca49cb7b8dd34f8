"""Exact distinct counts that can be put together again: dense numbers and bitmaps.

COUNT DISTINCT has to see all rows each time, and rows repeated once for each further distinct count
beside it.  Here every key gets a number, in the order of a day, so that the keys of a day are
neighbours; a bitmap then holds the keys of each day and group, in pieces of 32,768 numbers.  The
pieces of any days and groups are merged with OR, and counting is counting bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.rules import quoted
from tallymart.session import shared_folder

PART, ROW, NUMBER, DAY, PIECE, BITS = "__part", "__row", "__number", "day", "piece", "bits"
ROW_MASK = (1 << 33) - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: numbers must not change when a task runs again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, key: str, by: str) -> DataFrame:
    """key and a number from 1, without gaps, for each key that is not NULL, in the order of its least ``by``.

    The rows of a part are numbered by the task that sorts them; the driver adds up one size a part.
    """
    spark = df.sparkSession
    keys = df.where(F.col(quoted(key)).isNotNull()).groupBy(F.col(quoted(key)).alias(key)).agg(F.min(quoted(by)).alias(by))
    placed = (
        keys.repartitionByRange(quoted(by), quoted(key))
        .sortWithinPartitions(quoted(by), quoted(key))
        .select(
            quoted(key),
            F.spark_partition_id().alias(PART),
            F.monotonically_increasing_id().bitwiseAND(ROW_MASK).alias(ROW),
        )
    )
    placed = stored(placed, "numbers")
    starts, total = [], 1
    for r in sorted(placed.groupBy(PART).count().collect()):
        starts.append((r[PART], total))
        total += r["count"]
    begins = spark.createDataFrame(starts, f"{PART} int, begin long")  # a row a part
    return placed.join(F.broadcast(begins), PART).select(quoted(key), (F.col("begin") + F.col(ROW)).alias(NUMBER))


@dataclass(frozen=True)
class DistinctCounts:
    """Bitmaps of keys per day and group, written once, for any number of counts."""

    bitmaps: DataFrame
    groups: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame, key: str, at: str, groups: Iterable[str]) -> DistinctCounts:
        groups = tuple(groups)
        day = F.to_date(F.col(quoted(at))).alias(DAY)
        rows = df.select(F.col(quoted(key)).alias("key"), day, *[F.col(quoted(g)) for g in groups])
        numbers = numbered(rows, "key", DAY)
        rows = rows.join(numbers, "key", "left")
        # rows without a key still show their group, with an empty bitmap
        piece = F.bitmap_bucket_number(NUMBER).alias(PIECE)
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS)
        found = rows.groupBy(DAY, *[F.col(quoted(g)) for g in groups], piece).agg(bits)
        return cls(stored(found, "bitmaps"), groups)

    def count(self, *by: str, name: str = "count", where: Column | str | None = None) -> DataFrame:
        """Distinct keys per value of some of the groups, or of all rows; ``where`` tests day and groups."""
        unknown = set(by) - {*self.groups, DAY}
        if unknown:
            raise ValueError(f"no group {', '.join(sorted(unknown))}")
        rows = self.bitmaps if where is None else self.bitmaps.where(where)
        columns = [F.col(quoted(b)) for b in by]
        merged = rows.groupBy(*columns, PIECE).agg(F.bitmap_or_agg(BITS).alias(BITS))
        counted = F.coalesce(F.sum(F.bitmap_count(F.col(BITS))), F.lit(0)).alias(name)
        return merged.groupBy(*columns).agg(counted)
