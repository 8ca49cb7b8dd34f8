"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs.  All but the last return the columns of documents, whatever
their names.  A null text counts as an empty one and a null id sorts last.  Equal rows are told apart by
their place in the files, so of repeated rows a stage that keeps one keeps exactly one.  An empty
table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import byte_bpe, decontamination, exact_dedup, jaccard_join, toxicity
from tallymart.llm.queries import ranks, table
from tallymart.llm.shared import BATCH_BYTES, ship, stage

#: A trained network, an approximate join's recall and byte pairs are beyond SQL; the tests
#: hold the pipeline against a brute-force version.
ORACLE_SQL = None

#: Bytes of an Arrow batch in all stages; 10,000 texts at a time fill tasks and executors.
BATCH = 1 << 22


def bind(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches: stages return lazy frames, which run when this module's work is done."""
    spark.conf.set(BATCH_BYTES, BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a network trained on the labels; null and empty texts by the score
    of an empty window, rows of equal text alike."""
    bind(spark)
    return toxicity.keep_clean(spark, docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of each group of equal texts, of equal ids the first in the files; null and
    empty texts are one group."""
    bind(spark)
    return exact_dedup.keep_first(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of each class of similar texts, of equal ids the first in the files; texts without
    words are one class."""
    bind(spark)
    ship(spark)
    return jaccard_join.keep_one(spark, docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null and empty texts hold none."""
    bind(spark)
    return decontamination.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left; a null or empty text has no tokens."""
    bind(spark)
    ship(spark)
    return byte_bpe.digests(spark, docs, *ranks())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
