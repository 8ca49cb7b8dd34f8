"""CSV folder -> one bronze table per file, with one audit row per file."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.rules import quoted
from tallymart.sources.tables import DEFAULT_FORMAT, create_layer, newest_first
from tallymart.sources.versions import publish, write_version

SUCCESS, FAILED = "SUCCESS", "FAILED"

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("rows_read", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
    ]
)

# Column that holds the text of a record which does not fit the schema.
CORRUPT = "_corrupt_record"
# What the name of a table's quarantine has behind the table's own.
QUARANTINE = "__quarantine"

# Records with quoted line breaks survive with these reader options; the default
# read keeps the source's one-line-one-record behaviour.
MULTILINE = {"multiLine": "true", "escape": '"'}


# Affixes of the data set's file names (regular expressions), dropped to get
# the table name.
FILE_PREFIX = "^olist_"
FILE_SUFFIX = "_dataset$"

# Files that are loaded at the same time; each is a Spark job of its own.
FILES_AT_ONCE = 8


@dataclass(frozen=True)
class IngestOptions:
    layer: str = "bronze"
    audit_table: str = "ingestion_audit"
    fmt: str = DEFAULT_FORMAT
    prefix: str = FILE_PREFIX
    suffix: str = FILE_SUFFIX
    # Reader options added to header and inferSchema.
    reader: dict[str, str] = field(default_factory=dict)
    # Explicit schema per table name; saves the inference pass over the file.
    schemas: dict[str, T.StructType | str] = field(default_factory=dict)
    # Records that do not fit the schema go to ``<table>__quarantine``; else they stay, with NULLs
    # for what could not be read, as the source pipeline has it.
    quarantine: bool = False
    # Each load may change the schema of its table, as the source pipeline has it.
    replace_schema: bool = True


@dataclass(frozen=True)
class IngestResult:
    run_id: str
    source_file: str
    target_table: str
    rows_read: int
    status: str
    error_message: str | None = None
    rows_quarantined: int = 0

    @property
    def rows_loaded(self) -> int:
        return self.rows_read - self.rows_quarantined


def list_csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the ``*.csv`` files of a folder on any file system, empty files included.

    The files are those that a data source would read; nothing of their content is.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    # the scan itself would leave empty files out, and its names are escaped
    return sorted(unquote(path) for path in files.inputFiles())


def table_name(file_name: str, prefix: str = FILE_PREFIX, suffix: str = FILE_SUFFIX) -> str:
    stem = file_name.removesuffix(".csv")
    return re.sub(suffix, "", re.sub(prefix, "", stem))


def read_csv(
    spark: SparkSession,
    path: str,
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    reader = spark.read.option("header", "true").options(**(options or {}))
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def with_corrupt_column(
    spark: SparkSession,
    path: str,
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """The rows of ``read_csv`` and, beside them, the text of each record that does not fit its schema
    (wrong number of fields, a value of another type); NULL for those that do."""
    kind = read_csv(spark, path, options, schema).schema
    whole = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    held = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return read_csv(spark, path, {**(options or {}), **held}, whole)


def create_audit_table(spark: SparkSession, name: str, fmt: str = DEFAULT_FORMAT) -> None:
    columns = ", ".join(
        f"{c} {t}"
        for c, t in [
            ("run_id", "STRING"),
            ("source_file", "STRING"),
            ("target_table", "STRING"),
            ("rows_read", "BIGINT"),
            ("ingestion_timestamp", "TIMESTAMP"),
            ("status", "STRING"),
            ("error_message", "STRING"),
        ]
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}")


def write_audit(
    spark: SparkSession, name: str, results: Iterable[IngestResult], fmt: str = DEFAULT_FORMAT
) -> None:
    """Append the audit rows of a run, stamped with the time of writing, as one small file."""
    rows = [
        (r.run_id, r.source_file, r.target_table, r.rows_read, r.status, r.error_message)
        for r in results
    ]
    if not rows:
        return
    audit = (
        spark.createDataFrame(rows, AUDIT_SCHEMA)
        .withColumn("ingestion_timestamp", F.current_timestamp())
        .select(*spark.table(name).columns)
        .coalesce(1)
    )
    audit.write.format(fmt).mode("append").saveAsTable(name)


def audit_log(spark: SparkSession, name: str) -> DataFrame:
    """Audit rows, newest first."""
    return newest_first(spark.table(name), "ingestion_timestamp")


def ingest_file(
    spark: SparkSession, path: str, options: IngestOptions, run_id: str
) -> IngestResult:
    """Load one file as the next version of its table, and show it once all of it is written.

    The rows are counted while they are written; ``rows_read`` counts those in quarantine too.
    """
    file_name = path.rstrip("/").rsplit("/", 1)[-1]
    short = table_name(file_name, options.prefix, options.suffix)
    target = f"{options.layer}.{short}"
    reader, schema = options.reader, options.schemas.get(short)

    def write(df: DataFrame, name: str):
        return write_version(df, name, options.fmt, replace_schema=options.replace_schema)

    try:
        if not options.quarantine:
            version = write(read_csv(spark, path, reader, schema), target)
            publish(spark, version)
            return IngestResult(run_id, file_name, target, version.statistics.rows, SUCCESS)
        records = with_corrupt_column(spark, path, reader, schema)
        damaged = F.col(quoted(CORRUPT)).isNotNull()
        seen = Observation()
        counted = records.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(damaged).alias("damaged"))
        version = write(counted.filter(~damaged).drop(CORRUPT), target)
        # the damaged records of this file, none too, so that the table tells of the last load
        aside = records.filter(damaged).withColumns({"run_id": F.lit(run_id), "source_file": F.lit(file_name)})
        apart = write(aside, target + QUARANTINE)
        rows, bad = seen.get["rows"], seen.get["damaged"]
        if (version.statistics.rows, apart.statistics.rows) != (rows - bad, bad):
            written = f"{version.statistics.rows} + {apart.statistics.rows}"
            raise ValueError(f"{rows} records read, {bad} of them damaged, but {written} written")
        publish(spark, apart)
        publish(spark, version)
        note = f"{bad} of {rows} records are in {target}{QUARANTINE}" if bad else None
        return IngestResult(run_id, file_name, target, rows, SUCCESS, note, bad)
    except Exception as error:  # one bad file must not stop the others
        return IngestResult(run_id, file_name, target, 0, FAILED, str(error))


def ingest_folder(
    spark: SparkSession,
    folder: str,
    options: IngestOptions | None = None,
    run_id: str | None = None,
) -> list[IngestResult]:
    """Load every CSV file of a folder; a failing file is recorded and the run goes on."""
    return ingest_paths(spark, lambda: list_csv_files(spark, folder), options, run_id)


def ingest_paths(
    spark: SparkSession,
    paths: Iterable[str] | Callable[[], Iterable[str]],
    options: IngestOptions | None = None,
    run_id: str | None = None,
) -> list[IngestResult]:
    """As ``ingest_folder``, for files (or folders of part files) that are known or listed by a function."""
    options = options or IngestOptions()
    run_id = run_id or str(uuid.uuid4())
    audit = f"{options.layer}.{options.audit_table}"
    create_layer(spark, options.layer)
    create_audit_table(spark, audit, options.fmt)
    results: list[IngestResult] = []
    try:
        paths = paths() if callable(paths) else paths
        with ThreadPoolExecutor(FILES_AT_ONCE) as pool:  # the jobs run in Spark
            results.extend(pool.map(lambda path: ingest_file(spark, path, options, run_id), paths))
    finally:
        write_audit(spark, audit, results, options.fmt)
    return results
