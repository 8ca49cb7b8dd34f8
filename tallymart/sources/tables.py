"""Reading, writing and listing the tables of a layer (one database per layer)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"
# What the name of a version of a table has behind the table's own (see ``versions``).
VERSION_NAME = r"__v([0-9]{6,})_[0-9a-f]{8}"
# Formats that can replace the schema of an existing table in place.
SCHEMA_REPLACING = {"delta"}

# Codecs of formats that have better ones than their default: texts such as ids take half the bytes.
CODECS = {"parquet": "zstd", "orc": "zstd"}


def writer(df: DataFrame, fmt: str = DEFAULT_FORMAT) -> DataFrameWriter:
    """Writes ``df`` in a format, with the codec of ``CODECS`` if it has one there."""
    out = df.write.format(fmt)
    return out.option("compression", CODECS[fmt]) if fmt in CODECS else out


def create_layer(spark: SparkSession, layer: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def read_table(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.table(f"{layer}.{table}")


def clustered(df: DataFrame, range_by: Iterable[str] = ()) -> DataFrame:
    """Rows dealt out and sorted by a range of these columns; as they are if there is none."""
    range_by = list(range_by)
    return df.repartitionByRange(*range_by).sortWithinPartitions(*range_by) if range_by else df


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    replace_schema: bool = False,
    range_by: Iterable[str] = (),
) -> DataFrame:
    """Save ``df`` as a table and return the table as written.

    ``range_by`` clusters the files by a range of these columns, so that later
    range filters skip whole files by their statistics.  End it with the key of
    the table: then a frequent leading value still spreads over many tasks.
    """
    out = writer(clustered(df, range_by), fmt).mode(mode)
    if replace_schema and fmt in SCHEMA_REPLACING:
        out = out.option("overwriteSchema", "true")
    out.saveAsTable(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, layer: str, versions: bool = False) -> DataFrame:
    """Tables of a layer; their stored versions too where asked for."""
    found = spark.sql(f"SHOW TABLES IN {layer}")
    return found if versions else found.filter(~F.col("tableName").rlike(VERSION_NAME + "$"))


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs in column order."""
    return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL over the layers with bound parameters (``:name``)."""
    return spark.sql(sql, args=args)


def scalar(df: DataFrame):
    """First cell, or None when there is no row."""
    row = df.first()
    return row[0] if row else None


def newest_first(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.desc(column))
