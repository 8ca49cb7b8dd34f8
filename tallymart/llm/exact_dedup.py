"""Exact dedup by stateful streaming: keyed state on disk that never expires.

Arrivals (digest, id, locator of the content) are appended to a table in a folder; a
streaming aggregation over that table keeps, per digest, the least id with its locator and
the number of arrivals, in RocksDB state below the same folder.  The state is read back as
a table.  Where a digest has been met more than once, the full bytes behind each arrival's
locator are compared with those of the row that stays; rows that differ in spite of an equal
digest are grouped by their bytes.  Calling again with the same folder adds to the state; content
of earlier calls is opened at its locator, so their files must still be there.  A call with
the name of a batch that was taken in before adds nothing, so a call that failed can be repeated.

Only DataFrame operations run on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.llm.rows import PLACE, located, without
from tallymart.llm.shared import shared_folder, stage

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """The text with each run of U+0020 and U+0009 to U+000D as one space; a null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def arrived(spark: SparkSession, schema: StructType, folder: str, batch: str = "") -> DataFrame:
    """The arrivals of a batch, or of all of them; none if there are none yet."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    try:
        return reader.parquet(f"{folder}/arrivals/{batch}")
    except AnalysisException:  # no such folder
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def state_after(spark: SparkSession, arrivals: DataFrame, folder: str, batch: str = "batch") -> DataFrame:
    """Add a batch of arrivals to the folder's table, stream them into the state, and read it:
    digest, first (struct of no_id, doc_id, file, row), n.

    The files of a batch are written once; the stream takes in each file once.
    """
    if arrived(spark, arrivals.schema, folder, batch).isEmpty():
        arrivals.write.mode("overwrite").parquet(f"{folder}/arrivals/{batch}")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    partitions = "spark.sql.shuffle.partitions"
    session.conf.set(partitions, spark.conf.get(partitions))
    # many small stores: no room set aside on disk for each
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *PLACE)
    query = (
        session.readStream.schema(arrivals.schema)
        .option("recursiveFileLookup", "true")
        .parquet(f"{folder}/arrivals")
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kept = session.read.format("statestore").load(f"{folder}/state")
    value = [F.col(f"value.`{name}`") for name in kept.schema["value"].dataType.fieldNames()]
    return stage(kept.select("key.digest", value[0].alias("first"), value[1].alias("n")), "state", spark)


def group(
    spark: SparkSession,
    docs: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    folder: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Per row of ``docs``, and of earlier calls with the same folder: doc_id, file, row, digest,
    keep_id, group_size, kept.

    Of equal texts the least id stays, ids that are null come last, and of rows with the same
    id the first in the files.  Repeated rows are copies of each other: one stays.  Null
    and empty texts are one group.  An empty table gives no rows.  Columns other than doc_id
    and text are not read.  ``batch`` names the call: one that was taken in before adds nothing, so
    rows count once however often it is repeated.  Without a name every call is a batch of its own.
    """
    again = folder is not None
    folder = folder or f"{shared_folder(spark)}/exact_dedup"
    placed_rows = located(docs)
    text = normalised(F.col("text"))
    arrivals = placed_rows.select("doc_id", *PLACE, digest(text).alias("digest"))
    state = state_after(spark, arrivals, folder, batch or uuid.uuid4().hex)
    seen = arrived(spark, arrivals.schema, folder)
    if again:
        placed_rows = opened(spark, placed_rows, seen, state)
    placed = seen.join(state, "digest")

    # hits: the bytes of every row whose digest was met more than once
    often = state.where("n > 1").select("digest", "first")
    texts = placed_rows.select("doc_id", *PLACE, text.alias("text"), digest(text).alias("digest"))
    hits = stage(texts.join(often.hint("shuffle_hash"), "digest"), "hits")
    is_first = F.expr("file = first.file and row = first.row")
    firsts = hits.where(is_first).select("digest", F.col("text").alias("first_text"))
    others = hits.where(~is_first)
    differ = others.join(firsts, "digest").where("text != first_text")
    apart = stage(differ.select("doc_id", *PLACE, "digest", "text"), "apart")
    keep = placed.select("*", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"))
    if not apart.isEmpty():
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *PLACE)
        anew = apart.groupBy("digest", "text").agg(F.min(order).alias("own"), F.count("*").alias("m"))
        moved = apart.join(anew, ["digest", "text"]).select(*PLACE, "own", "m")
        lost = apart.groupBy("digest").agg(F.count("*").alias("lost"))
        keep = (
            placed.join(moved, list(PLACE), "left")
            .join(lost, "digest", "left")
            .withColumn("first", F.coalesce("own", "first"))
            .withColumn("group_size", F.coalesce("m", F.col("n") - F.coalesce("lost", F.lit(0))))
            .withColumn("keep_id", F.col("first.doc_id"))
        )
    return keep.select("doc_id", *PLACE, "digest", "keep_id", "group_size", is_first.alias("kept"))


def opened(spark: SparkSession, rows: DataFrame, seen: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, text, file and row of ``rows``, and of what earlier calls left in other files, as far as its
    digest was met more than once.  The names of these files come to the driver."""
    hits = seen.join(state.where("n > 1").select("digest"), "digest", "left_semi")
    earlier = hits.select("file").distinct().join(rows.select("file").distinct(), "file", "left_anti")
    files = [r.file for r in earlier.collect()]
    if not files:
        return rows
    content = spark.read.schema("doc_id long, text string").parquet(*files)
    return rows.unionByName(located(content))


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    found = group(spark, docs)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that stay, with their columns as they were."""
    return without(docs, lambda view: group(spark, view).where("not kept").select(*PLACE))
