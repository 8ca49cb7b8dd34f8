"""Staging in the shared folder, samples to train on, folds."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from shutil import make_archive, rmtree

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``; below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, reader: SparkSession | None = None, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and rows read
    from it stay what they were when a task runs again."""
    spark = reader or df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside sends Arrow batches of about ``size`` bytes to its Python functions, or one row, instead of
    so many rows however long they are.  For what is staged inside; a lazy frame is not bound."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int) -> DataFrame:
    """(text, y) of documents with a 0/1 label outside the held-out fold (remainder 0).

    An id with several labels counts with their mean, rounded; a null text is empty.
    """
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.round(F.avg(label)).cast("int").alias("y"))
    )
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .where(fold(F.col("doc_id"), modulus) != 0)
        .join(one, "doc_id")
    )


def sample(df: DataFrame, rows: int) -> Iterator[Row]:
    """About ``rows`` rows (all if there are fewer), chosen by a hash of id and text; texts are whole.

    For training only: the bound is the callers' documented parameter.  Repeated rows count once, so
    that one row repeated very often cannot fill the driver.  The same rows come at every
    parallelism, in the order of that hash, one partition at a time.
    """
    n = df.select("doc_id").count()
    part = min(1.0, rows / max(n, 1))
    mark = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    taken = df.where(mark < int(part * (1 << 30))).distinct()
    return taken.orderBy(F.xxhash64("doc_id", "text"), *[F.col(c) for c in sorted(df.columns)]).toLocalIterator()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp()  # the driver serves the archive from there to its end
        atexit.register(rmtree, folder, ignore_errors=True)
        to = f"{folder}/{package.name}_text"
        context.addPyFile(make_archive(to, "zip", package.parent, package.name))
