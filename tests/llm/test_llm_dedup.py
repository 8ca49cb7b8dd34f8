"""Exact dedup, Jaccard join and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from llm_awkward import DATA, empty, frame, split, texts
from pyspark.sql import functions as F

from tallymart.llm import components, exact_dedup, jaccard_join, substring_dedup
from tallymart.llm.queries import oracle_sql, queries


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def order(doc_id):
    return (doc_id is None, doc_id or 0)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    docs = frame(spark)
    digest = (lambda c: F.encode(F.length(c).cast("string"), "utf-8")) if weak else exact_dedup.sha256
    found = exact_dedup.group(spark, docs, digest).collect()
    want = defaultdict(list)
    for doc_id, text, *_ in texts():
        want[norm(text)].append(doc_id)
    expected = Counter()
    for ids in want.values():
        keep = min(ids, key=order)
        expected.update((i, keep, len(ids)) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == expected
    assert sum(r.kept for r in found) == len(want)


def test_exact_state_goes_on(spark, tmp_path):
    folder = str(tmp_path / "state")
    one = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "a  b"), (9, "d")], "doc_id long, text string")
    assert exact_dedup.group(spark, one, folder=folder).count() == 2
    arrivals = exact_dedup.located(two)
    text = exact_dedup.normalised(F.col("text"))
    state = exact_dedup.state_after(
        spark, arrivals.select("doc_id", "file", "row", exact_dedup.sha256(text).alias("digest")), folder
    )
    assert sorted((r["first"].doc_id, r.n) for r in state.collect()) == [(1, 2), (6, 1), (9, 1)]


def weak(text):
    return F.encode(F.length(text).cast("string"), "utf-8")


def grouped(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.group(spark, docs, **kw).collect())


def test_bytes_are_compared_across_calls(spark, tmp_path):
    """Equal digests of different texts, met in different calls: the earlier content is opened."""
    folder = str(tmp_path / "state")
    assert grouped(spark, [(5, "aaa"), (6, "cc")], digest=weak, folder=folder, batch="one") == [
        (5, 5, 1, True),
        (6, 6, 1, True),
    ]
    got = grouped(spark, [(7, "bbb"), (8, "cc"), (1, "ddd")], digest=weak, folder=folder, batch="two")
    assert got == [(1, 1, 1, True), (5, 5, 1, True), (6, 6, 2, True), (7, 7, 1, True), (8, 6, 2, False)]
    got = grouped(spark, [(9, "bbb"), (3, "cc")], digest=weak, folder=folder, batch="three")
    keeps = {i: (keep, size, kept) for i, keep, size, kept in got}
    assert keeps == {
        1: (1, 1, True), 5: (5, 1, True), 7: (7, 2, True), 9: (7, 2, False),
        3: (3, 3, True), 6: (3, 3, False), 8: (3, 3, False),
    }


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    folder, rows = str(tmp_path / "state"), [(5, "a"), (6, "a"), (7, "b")]
    first = grouped(spark, rows, folder=folder, batch="one")
    assert first == grouped(spark, rows, folder=folder, batch="one") == [(5, 5, 2, True), (6, 5, 2, False), (7, 7, 1, True)]
    # taken in as files, but not yet by the stream: as after a failure between the two
    docs = spark.createDataFrame([(1, "b"), (2, "c")], "doc_id long, text string")
    arrivals = exact_dedup.located(docs).select("doc_id", "file", "row", exact_dedup.sha256(F.col("text")).alias("digest"))
    arrivals.write.parquet(f"{folder}/arrivals/two")
    state = exact_dedup.state_after(spark, arrivals, folder, "two")
    again = exact_dedup.state_after(spark, arrivals, folder, "two")
    want = [(1, 2), (2, 1), (5, 2)]
    assert sorted((r["first"].doc_id, r.n) for r in state.collect()) == want
    assert sorted((r["first"].doc_id, r.n) for r in again.collect()) == want


@pytest.mark.parametrize("keep", [exact_dedup.keep_first, jaccard_join.keep_one])
def test_filters_return_their_columns(spark, keep):
    docs = frame(spark)
    kept = keep(spark, docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[7] == 1 and ids[1] == 1 and ids[2] == 0
    assert keep(spark, empty(spark)).count() == 0


def test_empty_tables(spark):
    assert exact_dedup.exact_dedup(spark, empty(spark)).count() == 0
    assert jaccard_join.near_duplicates(spark, empty(spark)).count() == 0
    assert substring_dedup.substring_dedup(spark, empty(spark)).count() == 0


def shingles(text):
    w = split(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_links(docs):
    """Class leader and number of linked sets of each row."""
    sets = [shingles(t) for _, t in docs]
    distinct = list(dict.fromkeys(sets))
    links, parent = Counter(), {s: s for s in distinct}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if a and b and len(a & b) * 5 >= 4 * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for (doc_id, _), s in zip(docs, sets, strict=True):
        root = top(s)
        if root not in least or order(doc_id) < order(least[root]):
            least[root] = doc_id
    return Counter((d, least[top(s)], links[s]) for (d, _), s in zip(docs, sets, strict=True))


def near_copies():
    """Groups of texts with a few changed words, on either side of the threshold."""
    import random

    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    common = rng.choices(vocabulary, k=40)
    out = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(60, 200)) + common
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((len(out), " ".join(copy)))
    out += [(len(out) + i, " ".join(rng.choices(vocabulary, k=50) + common)) for i in range(150)]
    return out


def found_links(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard_join.near_duplicates(spark, df, **kw).collect()
    return Counter((r.doc_id, r.class_id, r.n_links) for r in found)


def test_jaccard_awkward(spark):
    docs = [(i, t) for i, t, *_ in texts()]
    assert found_links(spark, docs) == brute_links(docs)


def test_jaccard_blocks_and_recursion(spark, monkeypatch):
    docs = near_copies()
    want = brute_links(docs)
    assert sum(n for _, _, n in want) > 500
    monkeypatch.setattr(jaccard_join, "LEAF", 6)
    monkeypatch.setattr(jaccard_join, "SIDE", 4)
    got = found_links(spark, docs, runs=9)
    assert sum(n for *_, n in got.elements()) >= 0.995 * sum(n for *_, n in want.elements())
    monkeypatch.undo()
    assert found_links(spark, docs) == want


def test_jaccard_sends_batches_of_bounded_size(spark):
    """500 texts of 20 KB, pairs of which differ in a word: no batch holds many of them, whatever the session sets."""
    setting, bound = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 21
    largest = spark.sparkContext.accumulator(0)
    described, linked = jaccard_join.described, jaccard_join.linked

    def watched(df):
        def run(batches):
            for batch in batches:
                largest.add(batch.nbytes > 2 * bound)
                yield batch

        return df.mapInArrow(run, df.schema)

    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(5000)]
    rows = [(i, " ".join(words[(i // 2 * 7919 + j * (1 + i // 2)) % 5000] for j in range(5000)) + f" {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = spark.conf.get(setting)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jaccard_join, "described", lambda df, n: described(watched(df), n))
        patch.setattr(jaccard_join, "linked", lambda df, t: linked(watched(df), t))
        got = jaccard_join.near_duplicates(spark, docs).collect()
    assert spark.conf.get(setting) == before
    assert largest.value == 0
    assert {(r.doc_id, r.class_id) for r in got} >= {(i, i - i % 2) for i in range(2, 500)}


def test_jaccard_runs_one_python_worker_a_task(spark, monkeypatch):
    """The texts that are read again are shuffled between the two functions that see them, however few they are."""
    plans, gram_rows = [], jaccard_join._gram_rows

    def watched(texts, words):
        plans.append(texts._jdf.queryExecution().executedPlan().toString())
        return gram_rows(texts, words)

    monkeypatch.setattr(jaccard_join, "_gram_rows", watched)
    jaccard_join.near_duplicates(spark, frame(spark)).collect()
    assert len(plans) == 1 and "ArrowEvalPython" in plans[0]
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]


def test_jaccard_default_runs_at_every_depth():
    """The promised miss, by an own simulation of pairs at 0.8 over 32 shared coordinates."""
    import numpy as np

    assert jaccard_join.least_agreement() == 15
    rng = np.random.default_rng(6)
    n, runs = 1_000_000, jaccard_join.runs_needed()
    agree = rng.binomial(32, 0.8, n)
    for levels in (1, 3, jaccard_join.LEVELS):
        lost = np.arange(n)
        for _ in range(runs):
            # buckets of a run that still hold both
            together = np.ones(len(lost), int)
            for _ in range(levels):
                together = rng.binomial(2 * together, agree[lost] / 32)
            lost = lost[together == 0]
        assert len(lost) / n < jaccard_join.MISS
        assert abs(len(lost) / n - jaccard_join.missed(runs, levels=levels)) < 3e-5


def test_jaccard_recursion_with_default_runs(spark, monkeypatch):
    docs = near_copies()
    monkeypatch.setattr(jaccard_join, "LEAF", 1)
    monkeypatch.setattr(jaccard_join, "DENSE", 2.0)
    assert found_links(spark, docs) == brute_links(docs)


def test_leaves_find_pairs_as_often_as_computed(spark, monkeypatch):
    """1,000 pairs that agree in half of the coordinates, in one run of the greatest depth."""
    import numpy as np

    monkeypatch.setattr(jaccard_join, "LEAF", 1)
    monkeypatch.setattr(jaccard_join, "DENSE", 2.0)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1000):
        a, b = rng.integers(0, 2**31, (2, 32))
        same = rng.permutation(32)[:16]
        b[same] = a[same]
        rows += [(2 * i, 40, a.tolist()), (2 * i + 1, 40, b.tolist())]
    nodes = spark.createDataFrame(rows, "node long, size int, sig array<int>")
    ended = jaccard_join.leaves(nodes, 1).collect()
    part = len({r.node // 2 for r in ended}) / 1000
    found = 1.0
    for _ in range(jaccard_join.LEVELS):
        found = 1 - (1 - found / 2) ** 2
    assert abs(part - found) < 0.06


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (100, 60), (60, 60), (50, 100)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in got.collect()}
    assert {roots[i] for i in range(31)} == {0} and {roots[i] for i in (50, 60, 100)} == {50}


def brute_substring(docs):
    """Rows in the order of the operator: id, null ids last."""
    rows, seen = [], {}
    whole = {}
    for doc_id, text in sorted(docs, key=lambda r: order(r[0])):
        w = split(text)
        same = whole.setdefault((doc_id, tuple(w)), (len(rows), w))[0]
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            first = seen.setdefault(tuple(w[p : p + 20]), (doc_id, same, p))
            if first != (doc_id, same, p):
                gone[p : p + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        rows.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(rows)


@pytest.mark.parametrize("hot", [1, 10_000])
def test_substring(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    docs = [(i, t) for i, t, *_ in texts()]
    # two texts of one id have no order that a brute-force version could know
    docs = [d for d in docs if not (d[0] == 8 and d[1] == docs[9][1])]
    df = frame(spark, [(i, t, None, None, None) for i, t in docs])
    found = substring_dedup.substring_dedup(spark, df)
    assert Counter(tuple(r) for r in found.collect()) == brute_substring(docs)


def test_factors_refer_to_equal_words(spark):
    docs = [(i, t) for i, t, *_ in texts() if i in (9, 10, 11, 17, 19)]
    by_id = {i: split(t) for i, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = substring_dedup.parse(spark, df, with_text=True).where("n_removed > 0").collect()
    assert {r.doc_id for r in found} == {10, 11, 19}
    for r in found:
        for f in r.factors:
            here = by_id[r.doc_id][f.start : f.start + f.words]
            assert here == by_id[f.ref_doc][f.ref_start : f.ref_start + f.words] and f.words >= 20
        assert len(split(r.kept)) == r.n_words - r.n_removed


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, name):
    assert differences(queries()[name](spark, DATA), connect(DATA), oracle_sql()[name]) == []
