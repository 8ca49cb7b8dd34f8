"""What a space-filling curve lets a filter skip, by the statistics of the written files."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallymart.operators.curve import Curve, along, borders, interleaved, rank
from tallymart.sources.tables import clustered

FILES = 32


@pytest.fixture(scope="module")
def sales(spark):
    n = F.col("id")
    return spark.range(64_000).select(
        (F.lit("2018-01-01").cast("timestamp_ntz") + F.make_dt_interval(n * 7919 % 720)).alias("at"),
        F.when(n % 97 != 0, F.concat(F.lit("S"), F.lpad(((n * 31) % 24).cast("string"), 2, "0"))).alias("state"),
        F.concat(F.lit("c"), F.lpad(((n * 17) % 40).cast("string"), 2, "0")).alias("category"),
        n.alias("id"),
    )


def files_of(spark, df, path) -> list[dict[str, tuple]]:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(FILES))
    try:
        df.write.parquet(str(path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    out = []
    for file in Path(path).glob("*.parquet"):
        found = pq.read_metadata(file)
        ranges = {}
        for g in range(found.num_row_groups):
            for c in range(found.num_columns):
                column = found.row_group(g).column(c)
                low, high = column.statistics.min, column.statistics.max
                old = ranges.get(column.path_in_schema, (low, high))
                ranges[column.path_in_schema] = min(old[0], low), max(old[1], high)
        out.append(ranges)
    return out


def read(files, **limits) -> int:
    """Files that a scan with these inclusive limits cannot skip."""
    return sum(all(f[c][0] <= high and low <= f[c][1] for c, (low, high) in limits.items()) for f in files)


MONTH = (datetime(2018, 6, 1), datetime(2018, 6, 30))


def test_files_read_per_filter(spark, sales, tmp_path):
    columns = ("at", "state", "category")
    plain = files_of(spark, clustered(sales, [*columns, "id"]), tmp_path / "plain")
    curve = files_of(spark, along(sales, Curve(columns, ("id",))), tmp_path / "curve")
    assert len(plain) == len(curve) == FILES
    filters = {
        "month": {"at": MONTH},
        "state": {"state": ("S05", "S05")},
        "category": {"category": ("c11", "c11")},
        "state and category": {"state": ("S05", "S05"), "category": ("c11", "c11")},
        "month and state": {"at": MONTH, "state": ("S05", "S05")},
    }
    found = {name: (read(plain, **f), read(curve, **f)) for name, f in filters.items()}
    # sorted by time first, nothing but time skips a file
    assert found["state"][0] == found["category"][0] == found["state and category"][0] == FILES
    assert all(found[name][1] <= FILES * 0.6 for name in ("month", "state", "category"))
    assert found["state and category"][1] <= FILES * 0.35 and found["month and state"][1] <= FILES * 0.35
    rows = spark.read.parquet(str(tmp_path / "curve"))
    assert rows.count() == 64_000 and rows.columns == sales.columns
    assert rows.exceptAll(sales).count() == 0


def test_bits_in_turn(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), (F.col("id") / 8).cast("int").alias("b"))
    for r in df.withColumn("z", interleaved([F.col("a"), F.col("b")], 3)).collect():
        want = sum(((r.a >> i) & 1) << (2 * i + 1) | ((r.b >> i) & 1) << (2 * i) for i in range(3))
        assert r.z == want


def test_ranks(spark):
    df = spark.createDataFrame([(x,) for x in (None, 1.0, 2.0, 2.5, 9.0)], "v double")
    got = [r.r for r in df.select(rank(F.col("v"), [2.0, 3.0]).alias("r")).collect()]
    assert got == [0, 0, 1, 1, 2]
    assert spark.range(3).select(rank(F.col("id"), []).alias("r")).distinct().collect()[0].r == 0


def test_borders_divide_evenly(spark, sales):
    found = borders(sales, ["state", "at"], 3)
    assert len(found["state"]) == 7 and found["state"] == sorted(found["state"])
    step = timedelta(days=90)
    assert all(abs(b - a - step) < timedelta(days=12) for a, b in zip(found["at"], found["at"][1:]))
    assert borders(sales.where("id < 0"), ["state"]) == {"state": []}
    assert along(sales.where("id < 0"), Curve(("state",))).count() == 0
