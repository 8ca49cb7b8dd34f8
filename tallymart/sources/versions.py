"""Tables that change from one whole version to the next.

A version is a table of its own, ``<table>__v<number>_<id>``, which is never changed once written.
What readers name is a view over one of them.  Publishing replaces the view, which is one
step of the catalog: a reader sees the old version or the new one, whatever fails
between two steps, and a query that has begun goes on with the version it began with.  The view
also carries the statistics seen while its version was written, so that they change with
it, and the name of the version before, which stays for ``rollback``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.rules import count_flags, literal, quoted
from tallymart.sources.schemas import SchemaError, Shape, compare, shaped
from tallymart.sources.tables import DEFAULT_FORMAT, VERSION_NAME, clustered, writer

PREFIX = "tallymart."
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Statistics:
    """Rows, rows per flag, NULLs per column, and greatest value per time column (as ``held``)."""

    rows: int
    flags: dict[str, int] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)
    greatest: dict[str, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    """A written version; ``name`` is the table's, ``stored`` that of the version."""

    name: str
    stored: str
    statistics: Statistics

    @property
    def number(self) -> int:
        return number_of(self.stored)


class NotVersioned(ValueError):
    """A plain table stands where a versioned one is to be."""


def number_of(stored: str) -> int:
    return int(re.search(VERSION_NAME, stored)[1])


def held(column: str, kind: T.DataType) -> Column:
    """The greatest value of a time column as text that is the same in every session's time zone."""
    greatest = F.max(F.col(quoted(column)))
    greatest = F.unix_micros(greatest) if isinstance(kind, T.TimestampType) else greatest
    return greatest.cast("string")


def from_held(text: str | None, kind: T.DataType) -> Column:
    """The value that ``held`` gave."""
    value = F.lit(text)
    return F.timestamp_micros(value.cast("long")) if isinstance(kind, T.TimestampType) else value.cast(kind)


def _split(name: str) -> tuple[str, str]:
    layer, table = name.rsplit(".", 1)
    return layer, table


def versions(spark: SparkSession, name: str) -> list[str]:
    """All versions that were written, published or not, oldest first."""
    layer, table = _split(name)
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {layer}").collect()]
    mine = [t for t in found if re.fullmatch(re.escape(table) + VERSION_NAME, t)]
    return [f"{layer}.{t}" for t in sorted(mine, key=number_of)]


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r.key.removeprefix(PREFIX): r.value for r in rows if r.key.startswith(PREFIX)}


def published(spark: SparkSession, name: str) -> Version | None:
    """The version that readers see; None before the first one."""
    found = _properties(spark, name)
    if not found:
        return None
    return Version(name, found["version"], Statistics(**json.loads(found["statistics"])))


def write_version(
    df: DataFrame,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    flags: Iterable[str] = (),
    range_by: Iterable[str] = (),
    replace_schema: bool = False,
) -> Version:
    """Write ``df`` as the next version of a table, which readers do not see yet.

    A schema that does not fit the published one (``schemas.compare``) is refused before anything
    is written, unless ``replace_schema`` says that it is meant.  Statistics are observed by the job
    that writes, behind the range exchange, which reads its input twice.
    """
    spark = df.sparkSession
    now = published(spark, name)
    if now is not None and not replace_schema:
        wrong = [c for c in compare(spark.table(now.stored).schema, df.schema) if not c.fits]
        if wrong:
            raise SchemaError(f"{name}: " + "; ".join(map(str, wrong)))
    number = max([number_of(v) for v in versions(spark, name)], default=0) + 1
    stored = f"{name}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    flags, times = list(flags), [f for f in df.schema.fields if isinstance(f.dataType, TIMES)]
    seen = Observation()
    counted = clustered(df, range_by).observe(
        seen,
        F.struct(F.count(F.lit(1)).alias("rows")).alias("all"),
        F.struct(F.lit(0).alias("_"), *count_flags(flags)).alias("flags"),
        F.struct(F.lit(0).alias("_"), *[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns]).alias("nulls"),
        F.struct(F.lit(0).alias("_"), *[held(f.name, f.dataType).alias(f.name) for f in times]).alias("greatest"),
    )
    writer(counted, fmt).saveAsTable(stored)
    parts = {part: values.asDict() for part, values in seen.get.items()}
    for values in parts.values():
        values.pop("_", None)
    return Version(name, stored, Statistics(parts["all"]["rows"], parts["flags"], parts["nulls"], parts["greatest"]))


def publish(spark: SparkSession, version: Version, keep: int = 2) -> DataFrame:
    """Show a written version to readers, then drop those older than the ``keep`` last ones shown."""
    name = version.name
    before = _properties(spark, name)
    if not before and spark.catalog.tableExists(name):
        raise NotVersioned(f"{name} is a plain table; rename it, or adopt() it")
    if before.get("version") == version.stored:
        return spark.table(name)
    shown = [version.stored, *json.loads(before["shown"])] if before else [version.stored]
    shown = list(dict.fromkeys(shown))[:keep]
    _show(spark, version, shown)
    for old in versions(spark, name):
        if old not in shown and number_of(old) < version.number:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def _show(spark: SparkSession, version: Version, shown: list[str]) -> None:
    held_properties = {
        "version": version.stored,
        "shown": json.dumps(shown),
        "statistics": json.dumps(version.statistics.__dict__),
    }
    listed = ", ".join(f"{literal(PREFIX + k)} = {literal(v)}" for k, v in held_properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {version.name} TBLPROPERTIES ({listed}) AS SELECT * FROM {version.stored}")


def rollback(spark: SparkSession, name: str) -> DataFrame:
    """Show the version that was shown before; the one that was left stays as a table."""
    found = _properties(spark, name)
    shown = json.loads(found["shown"]) if found else []
    if len(shown) < 2:
        raise ValueError(f"{name} has no version to go back to")
    _show(spark, Version(name, shown[1], _measured(spark, shown[1])), shown[1:])
    return spark.table(name)


def adopt(spark: SparkSession, name: str) -> DataFrame:
    """Turn a plain table into the first version of a versioned one.  Its name is gone for a moment."""
    stored = f"{name}__v000001_{uuid.uuid4().hex[:8]}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {stored}")
    _show(spark, Version(name, stored, _measured(spark, stored)), [stored])
    return spark.table(name)


def _measured(spark: SparkSession, stored: str) -> Statistics:
    """Statistics of a stored version, read from it: NULLs and greatest times, no flags."""
    df = spark.table(stored)
    times = [f for f in df.schema.fields if isinstance(f.dataType, TIMES)]
    found = df.agg(
        F.count(F.lit(1)),
        *[F.count_if(F.col(quoted(c)).isNull()) for c in df.columns],
        *[held(f.name, f.dataType) for f in times],
    ).first()
    nulls, greatest = found[1 : 1 + len(df.columns)], found[1 + len(df.columns) :]
    return Statistics(
        found[0], {}, dict(zip(df.columns, nulls)), dict(zip([f.name for f in times], greatest))
    )


def read_version(spark: SparkSession, name: str, stored: str, shape: Shape | None = None) -> DataFrame:
    """A version in the columns and types of the published one: what it lacks has the default of
    ``shape`` or is NULL, narrower types are widened, columns that were dropped are left out."""
    return shaped(spark.table(stored), spark.table(name).schema, shape)
