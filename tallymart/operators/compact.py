"""Ids in half their bytes while rows are shuffled or staged.

An id of 32 lower-case hexadecimal digits is 16 bytes; the codecs of shuffle files do not find that out.
Any other text keeps its own bytes and ends with a mark, which also keeps it from being 16 bytes long.  So
different ids stay different, NULL stays NULL, and each text comes back byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.rules import quoted


def packed(column: str) -> Column:
    """A text column as bytes: 16 for 32 lower-case hexadecimal digits, else those of the text and its mark."""
    c = quoted(column)
    return F.expr(
        f"""coalesce(CASE WHEN octet_length({c}) = 32 AND lower({c}) = {c} THEN unhex({c}) END,
            concat(CAST({c} AS BINARY), if(octet_length({c}) = 15, X'0101', X'00')))"""
    )


def unpacked(column: str) -> Column:
    """The text that ``packed`` was given."""
    c = quoted(column)
    return F.expr(
        f"""CASE WHEN octet_length({c}) = 16 THEN lower(hex({c}))
            ELSE CAST(substring({c}, 1, octet_length({c}) - if(right(hex({c}), 2) = '01', 2, 1)) AS STRING) END"""
    )


def compact(df: DataFrame, ids: Iterable[str]) -> DataFrame:
    """The columns of ``ids`` that ``df`` has, packed."""
    return df.withColumns({c: packed(c) for c in ids if c in df.columns})


def restored(df: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Reverses ``compact``."""
    return df.withColumns({c: unpacked(c) for c in ids if c in df.columns})
