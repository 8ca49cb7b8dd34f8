"""Tries against dictionaries, phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_awkward import empty, frame, texts

from tallymart.llm import collocations, filters, tries
from tallymart.llm.shared import stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, limit=2000):
    """The rows by the definition, with whole numbers of any size."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, w), a in frequent.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                if (lang, part) in frequent and 100 * a >= 50 * frequent[lang, part]:
                    dropped.add((lang, part))
    by_lang = defaultdict(list)
    for (lang, w), a in frequent.items():
        if (lang, w) not in dropped:
            cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [
        (lang, i, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in by_lang.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:limit], 1)
    ]


def some_rows(seed=3, docs=150):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ç", "Ç", "x1", "日本", "z-z", "w|", "the"] + [f"v{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(docs):
        t = " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))
        for mark in (". ", "\t", "\n", ",", "  ", "\r\n", "\x0b", "?!"):
            t = t.replace(" ", mark, rng.randint(0, 3)) if rng.random() < 0.3 else t
        out.append((rng.choice(["en", "en", "en", "fr", None]), t))
    return out


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    return [tuple(r) for r in collocations.collocations(spark, df, **kw).collect()]


@settings(max_examples=150, deadline=None)
@given(st.sets(st.lists(st.integers(1, 12), min_size=1, max_size=4).map(tuple), min_size=1, max_size=60))
def test_tries_hold_what_was_put_in(sequences):
    rows = np.array([[*s, 0, 0, 0, 0][:4] for s in sorted(sequences)])
    trie, slot = tries.build(rows)
    prefixes = {s[:k] for s in sequences for k in range(1, len(s) + 1)}
    assert len(set(slot.tolist())) == len(sequences)
    at = {(): 0}
    for level in range(4):
        for s in [s for s in at if len(s) == level]:
            state, symbol = np.full(14, at[s]), np.arange(14)
            for c, to in enumerate(trie.step(state, symbol).tolist()):
                assert (to >= 0) == (s + (c,) in prefixes)
                if to >= 0:
                    at[s + (c,)] = to
    assert len(set(at.values())) == len(at) == len(prefixes) + 1
    assert [at[s] for s in sorted(sequences)] == slot.tolist()


def test_large_tries_are_dense():
    rng = np.random.default_rng(4)
    rows = np.unique(1 + (rng.pareto(0.8, (60_000, 3)) * 20).astype(np.int64) % 20_000, axis=0)
    trie, slot = tries.build(rows)
    state = np.zeros(len(rows), np.int64)
    for level in range(3):
        state = trie.step(state, rows[:, level])
    assert (state == slot).all()
    nodes = sum(len(np.unique(rows[:, : k + 1], axis=0)) for k in range(3))
    assert len(trie.check) < 2 * nodes


@pytest.mark.parametrize("least, shard, limit", [(10, 1 << 19, 2000), (3, 40, 2000), (2, 100, 7)])
def test_phrases(spark, monkeypatch, least, shard, limit):
    rows = some_rows()
    if shard < 1000:
        monkeypatch.setattr(collocations, "AT_A_TIME", 2)
    if limit == 7:
        monkeypatch.setattr(collocations, "RANKED", 50)
        monkeypatch.setattr(collocations, "AT_ONCE", 300)
    want = brute(rows, least, limit)
    assert len(want) > 15
    assert sorted(found(spark, rows, least=least, shard=shard, limit=limit)) == sorted(want)


def test_awkward_rows(spark):
    rows = [(lang, t) for _, t, lang, *_ in texts()]
    got = collocations.collocations(spark, frame(spark)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows)) and got
    assert collocations.collocations(spark, empty(spark)).count() == 0
    assert found(spark, [(None, None), ("en", ""), ("fr", "a b " * 9)]) == []


def test_scores_beyond_64_bits(spark):
    """Counts of 10**12 and more: the products pass 64 bits, the score stays exact."""
    big = 3 * 10**12 + 7
    rows = [("en", "a", big), ("en", "b", big + 5), ("en", "a b", big - 11), ("en", "c", 12), ("en", "b c", 11), ("en", "a b c", 10)]
    got = collocations.scored(stage(spark.createDataFrame(rows, collocations.COUNTED), "counts"), 10**13)
    want = {
        "a b": (big, big + 5, 10**6 * (big - 11) ** 2 // (big * (big + 5))),
        "b c": (big + 5, 12, 0),
        "a b c": (big, 11, 0),
    }
    assert {r.phrase: (r.l, r.r, r.score) for r in got.collect()} == want


def test_hashes_tell_phrases_apart():
    words = pa.array(["a", "b", "ab", ""], pa.large_string())
    h = collocations.hashes(words)
    assert len(set(h.tolist())) == 4 and (collocations.hashes(words.slice(1, 2)) == h[1:3]).all()
    lang = h[:1]
    both = [collocations.phrase_hashes(lang, [h[i : i + 1], h[j : j + 1]]) for i, j in ((0, 1), (1, 0))]
    assert both[0] != both[1] and (collocations.slots(both[0]) < filters.BITS).all()


def test_texts_are_read_twice(spark, monkeypatch):
    """Once to count words, once to number them, however many passes count phrases; those read numbers."""
    rows = some_rows()
    read, places = spark.sparkContext.accumulator(0), collocations.places

    def counted(batch):
        read.add(batch.num_rows)
        return places(batch)

    monkeypatch.setattr(collocations, "places", counted)
    assert sorted(found(spark, rows, least=3, shard=40)) == sorted(brute(rows, 3))
    assert read.value == 2 * len(rows)


def test_numbers_are_told_by_bytes(monkeypatch):
    """Words and languages whose hashes are equal have numbers of their own."""
    monkeypatch.setattr(collocations, "phrase_hashes", lambda lang, words: np.zeros(len(lang), np.uint64) + np.uint64(5))
    known = collocations.Vocabulary(pa.array(["en", "fr", "en"]), pa.array(["a", "a", "b"]))
    langs = pa.array(["fr", "xx", "en"], pa.large_string())
    words = pa.array(["a", "a", "b", "c", "a"], pa.large_string())
    assert known.numbers(langs, np.array([2, 0, 2, 2, 1]), words).tolist() == [1, 2, 3, 0, 0]
    phrase = known.phrases([np.array(c, np.int32) for c in ([1, 3], [3, 1], [0, 3])])
    assert [c.to_pylist() for c in phrase] == [["en", "en"], ["a b", "b a b"]]


def test_a_first_word_of_many_phrases_is_split(spark):
    """4,000 pairs begin with the same word: no trie holds more than some of them."""
    rows = [(1, i, 0) for i in range(2, 4002)] + [(i, i + 1, 0) for i in range(2, 102)]
    phrases = stage(spark.createDataFrame(rows, "a int, b int, c int"), "phrases")
    dealt = collocations.tries_of(phrases, 9, 500).groupBy("shard").agg({"rows": "collect_list"}).collect()
    held = {r.shard: np.frombuffer(b"".join(map(bytes, r[1])), np.int32).reshape(-1, 3) for r in dealt}
    assert sorted(tuple(x) for part in held.values() for x in part.tolist()) == sorted(rows)
    assert len(held) > 3 and max(map(len, held.values())) < 2500


def test_numbers_are_read_as_often_with_many_tries(spark, monkeypatch):
    """Two bitmaps, two kinds of candidates, and the places dealt to the tries: five passes, not one for each two tries."""
    rows, read = some_rows(), {}
    flat_numbers, tries_of = collocations.flat_numbers, collocations.tries_of
    for shard in (1 << 19, 40):
        seen, shards = spark.sparkContext.accumulator(0), []

        def counted(batches):
            for flat in flat_numbers(batches):
                seen.add(len(flat))
                yield flat

        def noted(phrases, n, *more):
            shards.append(n)
            return tries_of(phrases, n, *more)

        monkeypatch.setattr(collocations, "flat_numbers", counted)
        monkeypatch.setattr(collocations, "tries_of", noted)
        assert sorted(found(spark, rows, least=3, shard=shard)) == sorted(brute(rows, 3))
        read[shards[0]] = seen.value
    few, many = sorted(read)
    assert few == 1 and many > 10 and read[many] == read[few]


def test_a_place_of_many_times_counts_as_often(spark):
    """Texts repeated many times are dealt once a task, with their number; a split first word keeps its places."""
    rows = [("en", "a b c . a b d")] * 300 + [("en", f"a w{i % 40} z") for i in range(200)] + some_rows()
    assert sorted(found(spark, rows, least=3, shard=6)) == sorted(brute(rows, 3))


def test_bitmaps_grow_with_the_words(spark, monkeypatch):
    """Half full or more, a bitmap would let most phrases through; larger ones keep them out and change no result."""
    assert [collocations.bits_for(n) >> 25 for n in (0, 1 << 27, (1 << 27) + 1, 1 << 29, 1 << 40)] == [1, 1, 2, 4, 8]
    monkeypatch.setattr(collocations, "bits_for", lambda words: 1 << 27)
    rows = some_rows()
    assert sorted(found(spark, rows, least=3, shard=40)) == sorted(brute(rows, 3))
    flat = np.array([3, 1, 2, 0], np.int32)
    numbers = stage(spark.createDataFrame([(flat.tobytes(),)] * 9, "numbers binary"), "numbers")
    bitmap = np.frombuffer(collocations.seen_often(numbers, [], 9, 1 << 27), np.uint8)
    assert len(bitmap) == 1 << 24 and np.unpackbits(bitmap).sum() == 2
    assert collocations.may_be(flat, np.array([0, 1]), bitmap, 2).tolist() == [0, 1]
