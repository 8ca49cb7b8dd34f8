"""Periodic runs against the word-by-word recurrence and against the definition."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_awkward import DATA, empty, frame, split, texts

from tallymart.llm import periodic_runs
from tallymart.llm.names import Words
from tallymart.llm.queries import queries
from tallymart.llm.words import blocks


def smallest_period(w):
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def recurrence(w):
    """Every earlier occurrence of every word adds to its diagonal; ended ones are looked at."""
    at, active, runs = {}, {}, set()

    def end(lag, matched, last):
        start, length = last - matched + 1 - lag, matched + lag
        if length >= max(24, 3 * lag) and smallest_period(w[start : start + length]) == lag:
            runs.add((start, length, lag))

    for i, word in enumerate(w):
        now = {i - j: active.get(i - j, 0) + 1 for j in at.get(word, [])}
        for lag in active.keys() - now.keys():
            end(lag, active[lag], i - 1)
        active = now
        at.setdefault(word, []).append(i)
    for lag, matched in active.items():
        end(lag, matched, len(w) - 1)
    return sorted(runs)


def row(doc_id, text, alter=True):
    w = split(text)
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if alter and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = recurrence(w)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (
        doc_id,
        len(runs),
        *best,
        None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def found(*many):
    out = []
    for block in blocks(pa.array([" ".join(w) for w in many], pa.string())):
        words = Words.of(block)
        for t, s, n, p in periodic_runs.diagonals(words).tolist():
            out.append((block.first + t, s - int(block.bounds[t]), n, p))
    return out


def expected(*many):
    return [(i, *r) for i, w in enumerate(many) for r in recurrence(w)]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=9), st.integers(1, 40), st.integers(0, 8)),
        min_size=1,
        max_size=8,
    )
)
def test_any_powers_side_by_side(parts):
    w = [x for root, times, more in parts for x in root * times + (root * 9)[:more]]
    assert found(w) == expected(w)


def test_nested_and_long_periods():
    rng = random.Random(5)
    many = []
    for _ in range(120):
        root = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        for _ in range(rng.randint(1, 3)):
            times = rng.randint(2, 12)
            root = root * times + [rng.choice("abcd") for _ in range(rng.randint(0, 4))]
            root = root[:400]
        w = [rng.choice("ab") for _ in range(10)] + root * rng.randint(3, 5) + root[: rng.randint(0, len(root))]
        many.append(w)
    assert found(*many) == expected(*many)


def test_neighbouring_texts_stay_apart():
    many = [["x"] * 20, ["x"] * 20, ["a", "b"] * 12, ["a", "b"] * 12, [], ["x"] * 24]
    assert found(*many) == expected(*many) == [(2, 0, 24, 2), (3, 0, 24, 2), (5, 0, 24, 1)]


def test_least_lengths():
    for p in (1, 7, 8, 9, 12, 13, 17, 18, 40):
        for n in {23, 24, 3 * p - 1, 3 * p, 3 * p + 1}:
            w = ([f"r{i}" for i in range(p)] * 30)[:n]
            assert found(w) == ([(0, 0, n, p)] if n >= max(24, 3 * p) else []), (p, n)


def test_one_word_very_often():
    """Lags of 1 to n all match; the work stays near n log n."""
    assert found(["x"] * 400_000) == [(0, 0, 400_000, 1)]
    root = [str(i % 19 * (i % 7)) for i in range(133)]
    assert found((root * 3000)[:390_001]) == [(0, 0, 390_001, 133)]


def test_exponents_are_compared_exactly():
    big = 10**9
    assert periodic_runs.longest_exponent([(0, 3 * big, big), (5, 3 * big + 1, big)]) == (5, 3 * big + 1, big)
    assert periodic_runs.longest_exponent([(0, 30, 10), (5, 60, 20)]) == (0, 30, 10)


@pytest.mark.parametrize("alter", [True, False])
def test_awkward_rows(spark, alter):
    got = periodic_runs.periodic_runs(spark, frame(spark), alter=alter).collect()
    assert Counter(map(tuple, got)) == Counter(row(i, t, alter) for i, t, *_ in texts())
    assert any(r.n_runs for r in got)
    assert periodic_runs.periodic_runs(spark, empty(spark)).count() == 0


def test_registered_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = queries()["op13_periodic_runs"](spark, DATA).collect()
    assert Counter(map(tuple, got)) == Counter(row(r.doc_id, r.text) for r in docs)
    assert sum(r.n_runs > 0 for r in got) > len(docs) / 20


def test_names_are_those_of_the_text():
    block = next(blocks(pa.array(["a b a b", "a b", None, "c c"])))
    words = Words.of(block)
    assert (words.names >= 0).tolist() == [True] * 4 + [False] * 2 + [True] * 2
    pairs = words.longer(words.names, 1)
    assert pairs[0] == pairs[2] >= 0 and (np.delete(pairs, [0, 2]) == -1).all()
    assert words.repeated_in_windows(2).tolist() == [True] * 4 + [False] * 4
