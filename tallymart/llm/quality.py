"""Quality: Bradley-Terry ranking of documents by pairwise preferences.

Each document has a strength, linear in features of its text.  A labelled good document
is preferred to a labelled bad one; the weights minimise the logistic loss on differences
of features over such pairs.  The strength at which good is told from bad is kept as a
quantile and looked up among the strengths of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import fold, labelled, sample, stage
from tallymart.llm.words import Block, blocks
from tallymart.operators.quantiles import order_statistics

#: Bounds on the training sample: rows expected (whole texts), preference pairs.
TRAIN_ROWS, PAIRS = 6000, 60_000
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
THRESHOLD = 0.3
_kind = np.zeros((8, 256), np.float32)
for _row, _bytes in enumerate(
    (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b"!?",
        b".,;:",
        b"#$%&*+<=>@\\^_`~{}[]/",
        b"|",
        b"\n",
    )
):
    _kind[_row, list(_bytes)] = 1
_kind[7, 128:] = 1


def features(block: Block) -> np.ndarray:
    """One row per text: shares of kinds of bytes and words, each also as root and capped."""
    sizes = np.diff(block.offsets).astype(np.float64)
    n = np.diff(block.bounds).astype(np.float64)
    one, some = np.maximum(sizes, 1), np.maximum(n, 1)

    def per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return total[edges[1:]] - total[edges[:-1]]

    shares = [per_text(row[block.data], block.offsets) / one for row in _kind]
    h, text = block.hashes(), np.repeat(np.arange(block.n), np.diff(block.bounds))
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((h, text))
    fresh = np.zeros(len(h))
    fresh[order] = np.concatenate(
        [[1.0][: len(h)], (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])]
    )
    length = (block.ends - block.starts).astype(np.float64)
    first = block.data[block.starts] if len(h) else np.zeros(0, np.uint8)
    last = block.data[block.ends - 1] if len(h) else np.zeros(0, np.uint8)
    odd = _kind[2][last] + _kind[4][last] + _kind[5][last]
    shares += [
        per_text(again, block.bounds) / some,
        per_text(1 - fresh, block.bounds) / some,
        per_text(odd.astype(np.float64), block.bounds) / some,
        per_text(_kind[0][first].astype(np.float64), block.bounds) / some,
        per_text((length == 1).astype(np.float64), block.bounds) / some,
    ]
    x = np.stack(shares, axis=1)
    mean = per_text(length, block.bounds) / some
    rest = np.stack([np.log1p(n), np.minimum(mean, 40) / 10, (n == 0).astype(float)], axis=1)
    return np.concatenate([x, np.sqrt(x), np.minimum(x * 10, 1), rest], axis=1)


def text_features(texts: list[str]) -> np.ndarray:
    return np.concatenate([features(b) for b in blocks(pa.array(texts, pa.string()))])


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Weights and centre of the strength, the quantile that divides, and the slope there.

    With one class only, or none, all strengths are 0; the quantile then is 0 if the rows
    are good and 1 if they are bad.
    """
    if not rows:
        return np.zeros(1), np.zeros(1), 0.0, 1.0
    x = text_features([t for t, _ in rows])
    y = np.array([y for _, y in rows])
    centre = x.mean(axis=0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.zeros(x.shape[1]), centre, float(not len(good)), 1.0
    rng = np.random.default_rng(17)
    winners, losers = rng.choice(good, PAIRS), rng.choice(bad, PAIRS)
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    for step in range(1, STEPS + 1):
        part = slice((step % 10) * (PAIRS // 10), (step % 10 + 1) * (PAIRS // 10))
        d = x[winners[part]] - x[losers[part]]
        g = -(d / (1 + np.exp(np.clip(d @ w, -50, 50)))[:, None]).mean(axis=0) + RIDGE * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    s = (x - centre) @ w
    order = np.argsort(s, kind="stable")
    # right answers if the lowest i are called bad
    right = np.concatenate([[0], np.cumsum(y[order] == 0)]) + (y == 1).sum()
    right = right - np.concatenate([[0], np.cumsum(y[order] == 1)])
    best = int(np.argmax(right))
    cut = s[order[min(best, len(s) - 1)]]
    slopes = np.geomspace(0.01, 10, 60)
    base = np.log(THRESHOLD / (1 - THRESHOLD))

    def loss(slope: float) -> float:
        z = slope * (s - cut) + base
        return float(np.logaddexp(0, np.where(y == 1, -z, z)).mean())

    return w, centre, best / len(s), float(min(slopes, key=loss))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (score of 0.3 or more).

    Null texts count as empty; empty ones have features of their own.  Rows of equal text
    have equal scores; repeated rows stay; an empty table gives none.
    """
    taken = sample(labelled(docs, labels, "quality", 5), TRAIN_ROWS)
    weights, centre, quantile, slope = train([(r.text, r.y) for r in taken])

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for block in blocks(batch.column("text")):
                if len(weights) > 1:
                    s[block.first : block.first + block.n] = (features(block) - centre) @ weights
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "strength"])

    found = stage(
        docs.select("doc_id", "text").mapInArrow(strengths, "doc_id long, strength double"), "strengths"
    )
    # exact, so that the same rows fall on the same side however they are dealt out
    cut = order_statistics(found, ["strength"], [quantile])["strength"].quantiles[quantile] or 0.0
    if quantile >= 1:
        cut = float(np.nextafter(cut, np.inf))
    base = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    # the sigmoid may round to either side at the cut itself, so the cut decides there
    score = 1 / (1 + F.exp(-(F.lit(slope) * (F.col("strength") - F.lit(cut)) + F.lit(base))))
    above = F.col("strength") >= F.lit(cut)
    score = F.when(above, F.greatest(score, F.lit(THRESHOLD))).otherwise(
        F.least(score, F.lit(float(np.nextafter(THRESHOLD, 0))))
    )
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        score.alias("score"),
        above.cast("int").alias("predicted"),
    )
