"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else counts as a space; n-grams of one to three
characters are hashed to ``SLOTS``.  Document frequencies are counted over all learning
rows.  Weights come from follow-the-regularised-leader (proximal, per-coordinate rates)
with an L1 and an L2 penalty, on a bounded sample; a temperature fitted on a part of it
that the weights have not seen makes the probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import fold, sample

SLOTS = 1 << 15
#: Bound on the training sample (training only): rows expected, and characters of each, taken in
#: so many stretches evenly from the whole text.
TRAIN_ROWS, TRAIN_CHARACTERS, STRETCHES = 4000, 3000, 10
EPOCHS, ALPHA, BETA, L1, L2 = 2, 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"
_tables: list[np.ndarray] = []


def _characters(text: str) -> np.ndarray:
    """Code points, letters in lower case, the rest as spaces."""
    if not _tables:
        every = [chr(i) for i in range(0x110000)]
        fold_to = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in every], np.uint32)
        fold_to[[not c.isalpha() for c in every]] = 32
        _tables.append(fold_to)
    return _tables[0][np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]


def slots(characters: np.ndarray) -> np.ndarray:
    """Slot of every n-gram, n from 1 to 3."""
    a = characters * np.uint32(0x9E3779B1)
    parts = [a]
    if len(a) > 1:
        b = (a[:-1] ^ (characters[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        parts.append(b)
    if len(a) > 2:
        parts.append((b[:-1] ^ (characters[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1))
    return np.concatenate(parts) >> np.uint32(32 - 15)


def counts(text: str | None) -> np.ndarray | None:
    """N-gram counts by slot; None where there is no letter."""
    if not text:
        return None
    characters = _characters(text)
    if not (characters != 32).any():
        return None
    return np.bincount(slots(characters), minlength=SLOTS)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slot, language
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(n).astype(np.int32)
        x = (1 + np.log(n[at])) * self.idf[at]
        return at, (x / max(np.sqrt((x * x).sum()), 1e-12)).astype(np.float32)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        n = counts(text)
        if n is None or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*self.vector(n)) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[str, str]], idf: np.ndarray) -> Model:
    """Fit on (text, language) pairs; every fifth one is kept for the temperature."""
    model = Model([], idf, np.zeros((SLOTS, 0)), np.zeros(0))
    vectors, of = [], []
    for text, lang in rows:
        n = counts(text)
        if n is not None:
            vectors.append(model.vector(n))  # only the slots that occur
            of.append(lang)
    if not of:
        return model
    languages = model.languages = sorted(set(of))
    k = len(languages)
    y = np.array([languages.index(lang) for lang in of])
    z, squares = np.zeros((SLOTS + 1, k)), np.zeros((SLOTS + 1, k))
    learn = [i for i in range(len(y)) if i % 5 or len(y) < 50]
    order = np.random.default_rng(3)

    def solved(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for i in order.permutation(learn):
            at, x = vectors[i]
            at, x = np.append(at, SLOTS), np.append(x, 1.0)  # the last one is the bias
            w = solved(at)
            p = softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(squares[at] + g * g) - np.sqrt(squares[at])) / ALPHA
            z[at] += g - step * w
            squares[at] += g * g
    everything = solved(np.arange(SLOTS + 1))
    model.weights, model.bias = everything[:-1], everything[-1]
    held = [i for i in range(len(y)) if i % 5 == 0]
    logits = np.array([model.logits(*vectors[i]) for i in held])

    def loss(temperature: float) -> float:
        s = logits / temperature
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(held)), y[held]]).mean())

    model.temperature = float(min(np.geomspace(0.05, 5, 80), key=loss))
    return model


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows whose language may be learned: it is known, and the fold is not the held-out one."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return known.where(fold(F.col("doc_id"), 3) != 1)


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """log((1 + documents) / (1 + documents with the slot)) + 1, over all rows.

    Each task adds up its own counts; one row a slot comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                n = counts(text.as_py())
                if n is not None:
                    total[:-1] += n > 0
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["slot", "documents"]
        )

    found = rows.select("text").mapInArrow(count, "slot int, documents long")
    total = np.zeros(SLOTS + 1)
    for r in found.groupBy("slot").agg(F.sum("documents").alias("documents")).collect():
        total[r.slot] = r.documents
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1


def stretches(text: Column) -> Column:
    """A text of up to ``TRAIN_CHARACTERS``; of a longer one as many, evenly from its beginning to its end."""
    width = TRAIN_CHARACTERS // STRETCHES
    begin = lambda i: F.floor(i * (F.length(text) - width) / (STRETCHES - 1)).cast("int") + 1
    parts = [F.substring(text, begin(F.lit(i)), F.lit(width)) for i in range(STRETCHES)]
    return F.when(F.length(text) <= TRAIN_CHARACTERS, text).otherwise(F.concat_ws(" ", *parts))


def fit(docs: DataFrame) -> Model:
    rows = learning_rows(docs)
    taken = sample(rows.select("doc_id", stretches(F.col("text")).alias("text"), "lang"), TRAIN_ROWS)
    return train([(r.text, r.lang) for r in taken], inverse_frequencies(rows))


def language(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, and everywhere if there is
    nothing to learn from.  Ties go to the language that sorts first; repeated rows stay.
    """
    shared = spark.sparkContext.broadcast(fit(docs))  # slots x languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([x for _, x in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    out = docs.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
