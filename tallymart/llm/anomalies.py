"""Quality rules: an isolation forest over the rules' statistics of a document.

A tree splits a small random part of the training rows at a random place of a random
statistic until every row is alone; rows that few splits tell from the rest are anomalies.
The score of a document is 2**(-mean path / path of a random search), in (0, 1); the
threshold is the least one that keeps all but ``LOST`` of the labelled good rows, all of
which are scored for it, as are all documents.  Two plain rules come first
(``base_failed``); the forest judges the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.names import Words, apart, codes
from tallymart.llm.shared import stage
from tallymart.llm.words import Block, blocks

#: Rows that trees draw from (the only bounded sample; it decides where trees split, nothing
#: else), trees, rows of each, and the greatest depth of a split.
FIT_ROWS, TREES, PART = 8192, 128, 256
#: Share of labelled good rows that the threshold may reject.
LOST = 0.002
#: Scores are counted, and compared, in steps of one part of so many.
STEPS = 100_000
FEWEST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_KINDS = {
    "symbols": _SYMBOLS,
    "upper": np.isin(np.arange(256), np.arange(0x41, 0x5B)),
    "marks": np.isin(np.arange(256), list(b"!?")),
    "stops": np.isin(np.arange(256), list(b".,;:")),
}
#: A byte that begins a character.
_BEGINS = (np.arange(256) & 0xC0) != 0x80


def per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of values from each edge to the next."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def repeated_lines(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them that equal an earlier line.  Lines end at
    line feeds, and are compared as they are."""
    feeds = np.flatnonzero(block.data == 0x0A)
    # a line feed that ends a text is followed by nothing, where the next text's first line starts
    starts = np.unique(np.concatenate([block.offsets[:-1], feeds + 1]))
    text = np.searchsorted(block.offsets[1:], starts, side="right")
    inside = np.flatnonzero(text < block.n)
    starts, text = starts[inside], text[inside]
    after = np.append(feeds, len(block.data))[np.searchsorted(feeds, starts)]
    ends = np.minimum(after, block.offsets[text + 1])
    worded = np.searchsorted(block.starts, ends) > np.searchsorted(block.starts, starts)
    starts, ends, text = starts[worded], ends[worded], text[worded]
    line = codes(apart(block.data, starts, ends))
    _, first = np.unique(text * (line.max(initial=0) + 1) + line, return_index=True)
    again = np.ones(len(line), bool)
    again[first] = False
    return np.bincount(text, minlength=block.n), np.bincount(text[again], minlength=block.n)


def statistics(block: Block) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The contract's counts, and the forest's statistics: one row per text, one column each."""
    n = np.diff(block.bounds)
    begins = np.concatenate([[0], np.cumsum(_BEGINS[block.data])])
    chars = begins[block.ends] - begins[block.starts]
    words = Words.of(block)
    kinds = {k: per_text(of[block.data], block.offsets) for k, of in _KINDS.items()}
    lines, again = repeated_lines(block)
    counts = {
        "n_words": n,
        "word_chars": per_text(chars, block.bounds),
        "n_symbols": kinds["symbols"],
        "n_dup_lines": again,
        "n_repeat_words": per_text(words.repeated_in_windows(WINDOW), block.bounds),
    }
    some, letters = np.maximum(n, 1), np.maximum(counts["word_chars"], 1)
    double = np.zeros(len(words.text), np.int64)
    double[1:] = (words.names[1:] == words.names[:-1]) & (words.names[1:] >= 0)
    shares = [
        np.log1p(n),
        counts["word_chars"] / some,
        again / np.maximum(lines, 1),
        counts["n_repeat_words"] / some,
        per_text(double, block.bounds) / some,
        per_text(chars == 1, block.bounds) / some,
        *(kind / letters for kind in kinds.values()),
    ]
    return counts, np.stack(shares, axis=1).astype(np.float64)


@dataclass
class Forest:
    """Trees side by side: node i of a tree splits ``column`` at ``place`` and leads to ``left`` or
    the node behind it; a leaf has column -1 and the length of its path in ``place``."""

    column: np.ndarray  # (trees, nodes)
    place: np.ndarray
    left: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """2**(-mean path / normal path) of each row, as whole ``STEPS``-ths."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for column, place, left in zip(self.column, self.place, self.left, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                c = column[node]
                inner = c >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(c, 0)] >= place[node]
                node = np.where(inner, left[node] + right, node)
            total += place[node]
        return np.rint(STEPS * 2.0 ** (-total / len(self.column) / normal_path(PART))).astype(np.int64)


def normal_path(n: int) -> float:
    """Mean path of an unsuccessful search among n values in a random binary tree."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, seed: int = 23) -> Forest:
    """A forest over the rows of x; without rows every path has length 0."""
    rng = np.random.default_rng(seed)
    deepest = int(np.ceil(np.log2(PART)))
    trees = []
    for _ in range(TREES):
        part = x[rng.permutation(len(x))[:PART]]
        column, place, left = [-1], [0.0], [0]
        todo = [(0, part, 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0),) * 2
            open_ = np.flatnonzero(high > low)
            if depth == deepest or not len(open_):
                place[node] = depth + normal_path(len(rows))
                continue
            c = int(rng.choice(open_))
            # the greatest value itself is a place that divides, the least one is not
            p = high[c] - (high[c] - low[c]) * rng.random()
            p = p if p > low[c] else high[c]
            column[node], place[node], left[node] = c, float(p), len(column)
            below = rows[:, c] < p
            for side in (rows[below], rows[~below]):
                todo.append((len(column), side, depth + 1))
                column.append(-1)
                place.append(0.0)
                left.append(0)
        trees.append((column, place, left))
    size = max(len(c) for c, _, _ in trees)

    def table(k: int, kind: type) -> np.ndarray:
        return np.array([tree[k] + [0] * (size - len(tree[k])) for tree in trees], kind)

    return Forest(table(0, np.int64), table(1, np.float64), table(2, np.int64), deepest)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the forest's statistics (an array, x) of each row of ``docs``."""
    schema = "doc_id long, " + "".join(f"{c} long, " for c in COUNTS) + "x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                counts, x = statistics(block)
                edges = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.n),
                        *(pa.array(counts[c], pa.int64()) for c in COUNTS),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(x.ravel())),
                    ],
                    ["doc_id", *COUNTS, "x"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` of ``measured`` with the forest's score (long, STEPS-ths) in place of x."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # TREES trees of at most 2 * PART nodes
    kept = ["doc_id", *COUNTS]
    schema = "".join(f"{c} long, " for c in kept) + "score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            # an empty batch has no columns to tell
            s = shared.value.score(x) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(s)], [*kept, "score"])

    return rows.select(*kept, "x").mapInArrow(run, schema)


def sample_rows(rows: DataFrame) -> np.ndarray:
    """Statistics of about ``FIT_ROWS`` rows (all if there are fewer), by a hash of id and statistics.

    Repeated rows count once, so that one that is repeated very often does not fill the driver.
    """
    n = rows.count()
    part = min(1.0, FIT_ROWS / max(n, 1))
    mark = F.pmod(F.xxhash64("doc_id", "x"), F.lit(1 << 30))
    taken = rows.where(mark < int(part * (1 << 30))).select(mark.alias("mark"), "doc_id", "x").distinct().collect()
    taken.sort(key=lambda r: (r.mark, r.x))
    return np.array([r.x for r in taken]) if taken else np.zeros((0, 1))


def threshold(labelled: DataFrame) -> int:
    """The least score that rejects at most ``LOST`` of the good rows, from a table (score, good).

    Of the scores that do, the one that tells good from bad best; ties: the highest, which
    rejects least.  Without labelled rows nothing is rejected.  Counted by score, so at most
    2 * STEPS rows come to the driver.
    """
    good, bad = np.zeros(STEPS + 2), np.zeros(STEPS + 2)
    for r in labelled.groupBy("score", "good").count().collect():
        (good if r.good else bad)[r.score] = r["count"]
    if not good.any():
        return STEPS + 1
    # rejected from this score on
    good, bad = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    gain = np.where(good <= LOST * good[0], bad - good, -np.inf)
    gain[-1] = max(gain[-1], 0)
    return int(len(gain) - 1 - np.argmax(gain[::-1]))


def anomalies(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, and the forest's score and threshold.

    A null or empty text has no words and so fails the base rules.  Rows of equal text get equal
    results; repeated rows stay, rows without an id too; an empty table gives no rows.
    Further columns are not read.  An id with several labels counts with their mean, rounded; the
    threshold is taken over all labelled rows that pass the base rules.  Without a good row or
    without a bad one the forest rejects nothing.
    """
    rows = stage(measured(docs), "statistics")
    found = stage(scored(rows, grow(sample_rows(rows))), "scores")
    found = found.withColumn(
        "base_failed",
        (F.col("n_words") < FEWEST_WORDS)
        | (F.lit(100) * F.col("n_repeat_words") > F.lit(REPEATED_PERCENT) * F.col("n_words")),
    )
    label = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).alias("good"))
    )
    cut = threshold(found.where(~F.col("base_failed")).select("doc_id", "score").join(label, "doc_id"))
    return found.select(
        "doc_id",
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & (F.col("score") < cut)).alias("kept"),
        (F.col("score") / F.lit(float(STEPS))).alias("anomaly"),
        F.lit(cut / STEPS).alias("threshold"),
    )
