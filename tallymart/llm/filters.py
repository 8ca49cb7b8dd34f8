"""Bitmaps of a fixed size that tell which keys can be left out before a shuffle.

They let some keys through that are not among those wanted, the more the fuller they are;
the join that follows decides.  They only save work, results do not depend on them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 4 MB, whatever the input, unless a caller chooses some more.
BITS = 1 << 25


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def bitmap(slots: DataFrame, bits: int = BITS) -> bytes:
    """Bitmap of a column ``slot``: filled in the tasks, at most ``bits`` / 8 bytes come back."""
    one = F.col("slot") + 1  # Spark's buckets begin with 1
    parts = (
        slots.groupBy(F.bitmap_bucket_number(one).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
        .collect()
    )
    out = bytearray(bits // 8)
    for r in parts:
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = r.bits
    return bytes(out)


def held(filled: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots are set in a bitmap given as bytes."""
    return (filled[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0
