"""Periodic runs: a sparse diagonal DP over the words of a text and their earlier occurrences.

Word i that also stands at i - d adds one to the match length of the diagonal of lag d; a
diagonal that is not added to ends, and with ``length`` words matched it is a run of
length + d words with period d.  A diagonal counts from length + d >= max(24, 3 d) on, so
from max(24 - d, 2 d) matched words on, and that thins out the occurrences that must be looked at
without losing a run:

* Lags fall into ranges low..high with high <= 4/3 low; a run of such a lag matches at least
  2 low words.  So an occurrence counts as one only if the word's whole context, the ``2 low``
  words from it on (16 at least), is the same at both places.
* The context's lag d is a repeat of a shorter period p if p is its nearest earlier lag and
  divides d: then all of the stretch has period p, for its whole length (contexts are longer
  than d, and any two periods whose sum a context holds have their common divisor as a
  period), and the diagonal of p gives the same run.  It is left out.
* What is left is at most one lag per range and word: two earlier occurrences in one range
  would be less than a sixth of the context apart, and so both repeats of a shorter period.

Each range thus has one active lag at a time, and a text of n words takes O(n log n) steps,
also if it is one word n times.  A step takes all words of a block of texts at once: one
search finds every word's occurrence, and where place or lag do not go on the diagonal ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm.names import Words
from tallymart.llm.words import blocks

#: A run has so many words at least, and so many periods.
LEAST, PERIODS = 24, 3
#: Words all contexts have in common: 24 - d or 2 d, whichever is more, is 16 at least.
CONTEXT = 16
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def altered(n: int, doc_id: int | None) -> np.ndarray | None:
    """Places of the words that the contract's change of a text puts there; None: no change.

    A null id counts as the empty text.
    """
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def ranges(longest: int) -> Iterator[tuple[int, int]]:
    """Ranges of lags, for texts of up to ``longest`` words."""
    low, high = 1, CONTEXT // 2
    while low * PERIODS <= longest:
        yield low, high
        low = high + 1
        high = 4 * low // 3


def diagonals(words: Words) -> np.ndarray:
    """Runs as rows (text, start, length, period), places counted over all texts of the block."""
    found = [np.zeros((0, 4), np.int64)]
    held, size = words.names, 1  # names of runs of a power of two words
    for low, high in ranges(int(np.diff(words.bounds).max(initial=0))):
        context = max(CONTEXT, 2 * low)
        while size * 2 <= context:
            held, size = words.longer(held, size), size * 2
        names = held if size == context else words.longer(held, context - size)
        at = np.flatnonzero(names >= 0)
        if not len(at):
            if not (held >= 0).any():
                break  # no run of ``size`` words repeats, so none of more words does
            continue
        places = len(names)
        key = names[at] * places + at
        order = np.argsort(key)
        key, at = key[order], at[order]
        before = np.searchsorted(key, key - low, side="right") - 1
        group = key // places
        there = (before >= 0) & (group[before] == group)
        lag = np.where(there, at - at[before], high + 1)
        nearest = np.ones(len(at), np.int64)
        nearest[1:] = at[1:] - at[:-1]
        # the first of a group has no occurrence before it, so its lag is not looked at
        repeat = (nearest < lag) & (lag % np.maximum(nearest, 1) == 0)
        good = np.flatnonzero((lag <= high) & ~repeat)
        good = good[np.argsort(at[good])]
        at, lag = at[good], lag[good]
        if not len(at):
            continue
        begins = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(lag) != 0)]))
        ends = np.append(begins[1:], len(at)) - 1
        d = lag[begins]
        length = at[ends] - at[begins] + context + d
        enough = length >= np.maximum(LEAST, PERIODS * d)
        start = at[begins] - d
        found.append(np.stack([words.text[start], start, length, d], axis=1)[enough])
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1]))]


def longest_exponent(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length over period, compared as whole numbers; ties: the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def detect(ids: list[int | None], words: Words) -> dict[str, list]:
    """The columns of ``SCHEMA`` but doc_id for some texts."""
    bounds = words.bounds
    runs = diagonals(words)
    edge = np.zeros(len(words.text) + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    cuts = np.searchsorted(kept, bounds)
    values = pc.take(words.values, pa.array(kept)).cast(pa.binary())
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values), b" ")
    of = np.searchsorted(runs[:, 0], np.arange(len(bounds)))
    out: dict[str, list] = {name: [] for name in pa_schema().names[1:]}
    for i in range(len(ids)):
        mine = [(s - int(bounds[i]), n, p) for _, s, n, p in runs[of[i] : of[i + 1]].tolist()]
        best = longest_exponent(mine)
        out["n_runs"].append(len(mine))
        for name, value in zip(("start", "length", "period"), best or (None,) * 3, strict=True):
            out[name].append(value)
        out["exponent_milli"].append(best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in mine)
        out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(texts[i].as_buffer()).hexdigest())
    return out


def pa_schema() -> pa.Schema:
    number, text = pa.int64(), pa.string()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")
    return pa.schema([(n, number) for n in names] + [("runs_sha256", text), ("collapsed_sha256", text)])


def periodic_runs(spark: SparkSession, docs: DataFrame, alter: bool = True) -> DataFrame:
    """Per row of ``docs`` the number of periodic runs, the one of greatest exponent, and digests
    of all runs and of the text without what repeats (columns of ``SCHEMA``).

    A null or empty text has no words, so no run; such a row has nulls for the run.  Ties go to the
    least start, then period.  Repeated rows give repeated rows, an empty table none; further
    columns are not read.  A text of any length is read whole, in one task.  ``alter`` applies
    the registered query's change to a tenth of the texts, by id, before the search.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for block in blocks(batch.column("text")):
                mine = ids[block.first : block.first + block.n]
                words = Words.of(block)
                places = [altered(int(n), i) if alter else None for n, i in zip(np.diff(block.bounds), mine, strict=True)]
                if any(p is not None for p in places):
                    at = np.arange(len(words.text))
                    for begin, p in zip(block.bounds, places, strict=False):
                        if p is not None:
                            at[begin : begin + len(p)] = begin + p
                    words = Words.taken(pc.take(words.values, pa.array(at)), block.bounds)
                columns = {"doc_id": mine} | detect(mine, words)
                yield pa.RecordBatch.from_pydict(columns, schema=pa_schema())

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
