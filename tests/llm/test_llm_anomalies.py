"""Rule statistics and the isolation forest against plain recomputation."""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from llm_awkward import empty, frame, split, texts

from tallymart.llm import anomalies
from tallymart.llm.queries import queries
from tallymart.llm.words import blocks

DATA, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    text = text or ""
    w = split(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    inside = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if split(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside)


def failed(n_words, _chars, _symbols, _lines, repeated):
    return n_words < 10 or 100 * repeated > 20 * n_words


def statistics_of(text):
    """Plain version of the forest's statistics."""
    text = text or ""
    w = split(text)
    n, chars, symbols, again, repeated = counts(text)
    lines = [x for x in text.split("\n") if split(x)]
    some, letters = max(n, 1), max(chars, 1)
    double = sum(a == b for a, b in zip(w, w[1:], strict=False))
    kinds = [symbols, *(len(re.findall(k, text)) for k in ("[A-Z]", "[!?]", "[.,;:]"))]
    return [
        np.log1p(n),
        chars / some,
        again / max(len(lines), 1),
        repeated / some,
        double / some,
        sum(len(x) == 1 for x in w) / some,
        *(k / letters for k in kinds),
    ]


def path(forest, tree, x):
    """Plain walk down one tree."""
    node = 0
    while forest.column[tree, node] >= 0:
        c = forest.column[tree, node]
        node = forest.left[tree, node] + int(x[c] >= forest.place[tree, node])
    return forest.place[tree, node]


def plain_scores(forest, rows):
    total = [sum(path(forest, t, x) for t in range(len(forest.column))) for x in rows]
    c = anomalies.normal_path(anomalies.PART)
    return [round(anomalies.STEPS * 2 ** (-t / len(forest.column) / c)) for t in total]


def plain_cut(pairs):
    """Of all cuts that keep the promise the best one, by trying them all."""
    goods = sorted(s for s, good in pairs if good)
    best = (0, anomalies.STEPS + 1)
    if not goods:
        return best[1]
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        lost = sum(s >= cut for s in goods)
        gain = sum(s >= cut for s, good in pairs if not good) - lost
        if lost <= anomalies.LOST * len(goods) and gain > best[0]:
            best = (gain, cut)
    return best[1]


def test_statistics():
    docs = [t for _, t, *_ in texts()] + ["a\nb\na\n\n\na\n", "\n", "x|y|*\n x|y|*\nx|y|*", "é é é é é é é", "!A? b."]
    for limit in (50, 1 << 20):
        row = 0
        for block in blocks(pa.array(docs, pa.string()), limit):
            got, x = anomalies.statistics(block)
            for i in range(block.n):
                assert tuple(int(got[c][i]) for c in anomalies.COUNTS) == counts(docs[row])
                assert np.allclose(x[i], statistics_of(docs[row]), rtol=1e-12)
                row += 1
        assert row == len(docs)


def test_forest_walks_and_isolates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    x[:20] += 9
    forest = anomalies.grow(x)
    got = forest.score(x)
    assert np.abs(got[:200] - plain_scores(forest, x[:200])).max() <= 1
    assert got[:20].min() > np.quantile(got[20:], 0.99)
    flat = anomalies.grow(np.zeros((500, 3)))
    assert len(set(flat.score(np.eye(3)).tolist())) == 1
    assert anomalies.grow(np.zeros((0, 3))).score(np.eye(3)).tolist() == [anomalies.STEPS] * 3


def test_normal_path_is_the_mean_over_random_trees():
    """Each leaf of a random binary search tree of n keys at its depth, averaged."""

    @cache
    def mean(n):
        return 0.0 if n < 2 else 1 + sum((i * mean(i) + (n - i) * mean(n - i)) / n for i in range(1, n)) / (n - 1)

    # the usual formula puts Euler's constant and a logarithm for the harmonic number
    for n in (2, 10, 256):
        assert abs(anomalies.normal_path(n) - mean(n)) < 0.2


@pytest.mark.parametrize("pairs", [[], [(5, True)], [(5, False)], [(7, False), (7, True), (9, False)], [(100_000, False), (0, True)]])
def test_threshold_cases(spark, pairs):
    df = spark.createDataFrame(pairs, "score long, good boolean")
    assert anomalies.threshold(df) == plain_cut(pairs)


def test_registered_query(spark):
    """Whole result against the plain version with the same forest; bad rows found, good ones kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op11_anomalies"](spark, DATA).collect()}
    assert len(got) == len(docs)
    rows = anomalies.measured(spark.read.parquet(f"{DATA}/documents.parquet"))
    forest = anomalies.grow(anomalies.sample_rows(rows))
    plain = dict(zip([r.doc_id for r in docs], plain_scores(forest, [statistics_of(r.text) for r in docs]), strict=True))
    cut = plain_cut([(plain[i], y == 1) for i, y in labels.items() if not got[i].base_failed])
    wrong = 0
    for r in docs:
        g, want = got[r.doc_id], counts(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == failed(*want)
        # sums in another order may round to the next step
        assert abs(g.anomaly * anomalies.STEPS - plain[r.doc_id]) < 1.5
        wrong += g.kept != (not failed(*want) and plain[r.doc_id] < cut)
    assert wrong <= 1
    assert kept_of(got, labels, 0) < 0.7 and kept_of(got, labels, 1) >= 0.998


def kept_of(got, labels, y):
    return np.mean([got[i].kept for i, v in labels.items() if v == y and not got[i].base_failed])


def test_bad_rows_go_and_good_ones_stay(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op11_anomalies"](spark, LARGER).select("doc_id", "base_failed", "kept").collect()}
    assert kept_of(got, labels, 0) < 0.1 and kept_of(got, labels, 1) >= 0.998


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (8, 1, 0), (12, 0, 0), (None, 1, 0), (14, None, 0), (17, 7, 0)], LABELS)
    got = anomalies.anomalies(spark, frame(spark), labels).collect()
    want = Counter((i, *counts(t), failed(*counts(t))) for i, t, *_ in texts())
    assert Counter((r.doc_id, *(r[c] for c in anomalies.COUNTS), r.base_failed) for r in got) == want
    assert not any(r.base_failed and r.kept for r in got)
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept != r.base_failed for r in anomalies.anomalies(spark, frame(spark), none).collect())
    assert anomalies.anomalies(spark, empty(spark), labels).count() == 0
