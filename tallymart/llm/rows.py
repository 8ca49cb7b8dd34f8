"""Rows by their place in the files they are read from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import stage

PLACE = ("file", "row")


def _of_files(df: DataFrame, *columns: str) -> DataFrame:
    found = df.select(
        *columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    found.schema  # noqa: B018  analysed here
    return found


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text, file and row of each row; a frame that is no file scan is staged first."""
    try:
        return _of_files(docs, "doc_id", "text")
    except AnalysisException:
        return _of_files(stage(docs.select("doc_id", "text"), "documents"), "doc_id", "text")


def without(docs: DataFrame, dropped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``docs``, their columns as they were, but those at the places that ``dropped``
    gives for a view of them (doc_id and text, rows of files)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    try:
        whole = _of_files(plain, *names)
    except AnalysisException:
        plain = stage(plain, "documents")
        whole = _of_files(plain, *names)
    new = {name: names[docs.columns.index(name)] for name in ("doc_id", "text")}
    gone = dropped(plain.select(*[F.col(old).alias(name) for name, old in new.items()]))
    return whole.join(gone, list(PLACE), "left_anti").select(*names).toDF(*docs.columns)
