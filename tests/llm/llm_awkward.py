"""Documents with every awkward case: nulls, empty and long texts, ties, repeated rows,
columns whose names the operators use themselves."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.001"


def texts() -> list[tuple]:
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(400)]
    prose = [" ".join(rng.choices(words, k=rng.randint(30, 120))) for _ in range(12)]
    passage = " ".join(rng.choices(words, k=60))
    out = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, "one two three four"),
        (6, "one  two three\tfour"),
        (7, prose[0]),
        (7, prose[0]),
        (8, prose[0].replace(" ", "\n", 3)),
        (8, prose[1]),
        (None, prose[1]),
        (None, None),
        (9, prose[2] + " " + passage + " " + prose[3]),
        (10, prose[4] + "\n" + passage),
        (11, passage + " " + passage),
        (12, "same " * 50),
        (13, "same " * 24),
        (14, " ".join(rng.choices(words, k=9000))),
        (15, "x" * 40_000),
        (16, "é" * 3000 + " 日本語 " + prose[5]),
        (17, prose[6]),
        (18, " ".join(w for i, w in enumerate(prose[6].split()) if i != 5)),
        (19, prose[7] + " " + " ".join(prose[6].split()[:25])),
    ]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in out]


def frame(spark, rows=None):
    """The rows with further columns that clash with names inside the operators."""
    df = spark.createDataFrame(texts() if rows is None else rows, SCHEMA)
    for name in ("file", "row", "node", "digest", "found", "y", "slot", "first", "n", "_metadata"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return frame(spark, [])


def words(text) -> list[str]:
    return (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if text else []


def split(text) -> list[str]:
    return [w for w in words(text) if w]
