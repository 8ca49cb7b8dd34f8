"""Quality, language and toxicity: gradients, held-out accuracy, awkward rows; the pipeline."""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pytest
from llm_awkward import empty, frame
from pyspark.sql import functions as F

from tallymart.llm import language, quality, shared, toxicity
from tallymart.llm.shared import fold

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    return docs, spark.read.parquet(f"{DATA}/labels.parquet").cache()


def test_fold(spark):
    from pyspark.sql import functions as F

    got = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == crc32(str(r.id).encode()) % 5 for r in got)


def test_quality(spark, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in quality.quality(spark, docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([y == r.predicted for y, r in held]) > 0.9


def test_language(spark, tables):
    docs, _ = tables
    got = {r.doc_id: r for r in language.language(spark, docs).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.97
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())


def test_toxicity(spark, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in toxicity.toxicity(spark, docs, labels).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([y == r.predicted for y, r in held]) > 0.85
    insults = {"idiot", "clown", "loser", "moron", "stupid", "scum"}
    rude = [r.doc_id for r in docs.collect() if insults & set(toxicity.tokens(r.text))]
    assert len(rude) > 10 and np.mean([got[i].predicted for i in rude]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())


ROWS = [(1, None), (2, ""), (3, "123 !"), (3, "123 !"), (None, "x"), (4, "word " * 30_000), (5, "a" * 100_000)]


def test_awkward_rows(spark, tables):
    docs, labels = tables
    df = frame(spark, [(i, t, None, None, None) for i, t in ROWS])
    for function in (quality.quality, toxicity.toxicity):
        got = function(spark, df, labels).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 3}) == 1
        assert function(spark, df, labels.where("false")).count() == len(ROWS)
        assert function(spark, empty(spark), labels).count() == 0
    got = language.language(spark, df).collect()
    assert len(got) == len(ROWS) and {r.lang_pred for r in got} == {"und"}
    learned = language.fit(docs)
    assert learned.predict(None) == learned.predict("1 2 !") == ("und", 0.0)
    assert language.language(spark, empty(spark)).count() == 0
    kept = toxicity.keep_clean(spark, df, labels)
    assert kept.columns == df.columns


def test_network_gradients():
    """Backward pass against differences of the loss."""
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    slots = toxicity.Slots.of(("aa", "bcd", "xyzzy", "e"))
    ids = np.array([[0, 1], [2, 3], [1, 0]])
    mask = np.array([[1.0, 1.0], [1.0, 1.0], [1.0, 0.0]])
    weight = np.array([0.7, -0.4])

    def loss():
        return float(net.forward(net.gates(net.inputs(slots)), ids, mask) @ weight)

    x = net.inputs(slots)
    net.forward(net.gates(x), ids, mask, keep=True)
    grads = net.backward(weight, x)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        flat = np.flatnonzero(np.abs(g).ravel() > 1e-6)
        for i in rng.choice(flat, min(4, len(flat)), replace=False):
            p, eps = net.p[name].reshape(-1), 1e-3
            p[i] += eps
            up = loss()
            p[i] -= 2 * eps
            down = loss()
            p[i] += eps
            assert g.reshape(-1)[i] == pytest.approx((up - down) / (2 * eps), rel=0.02, abs=2e-5), name


def test_reader_scores_as_the_network_does():
    net = toxicity.Network(5)
    texts = ["", None, "one two", "a b c " * 40, "long " * 33]
    got = toxicity.Reader(net).score(texts, held_words=10)
    for text, s in zip(texts, got, strict=True):
        words = toxicity.tokens(text)
        slots = toxicity.Slots.of(words) if words else toxicity.Slots(np.zeros(1, int), np.zeros(0, int), np.zeros(2, int))
        gates = net.gates(net.inputs(slots))
        best = -np.inf
        for a, b in toxicity.windows(len(words)):
            ids = np.arange(a, b)[:, None] if b > a else np.zeros((1, 1), int)
            mask = np.ones((max(1, b - a), 1), np.float32) * (b > a)
            best = max(best, float(net.forward(gates, ids, mask)[0]))
        assert s == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-4)


def test_windows_of_many_texts():
    lengths = np.array([0, 1, 31, 32, 33, 55, 56, 57, 80, 500])
    bag, start, size = toxicity.window_places(lengths)
    want = [(i, a, b - a) for i, n in enumerate(lengths.tolist()) for a, b in toxicity.windows(n)]
    assert list(zip(bag.tolist(), start.tolist(), size.tolist(), strict=True)) == want


def test_slots_of_some_words():
    words = ["a", "long" * 30, "", "x1", "ü"]
    slots = toxicity.Slots.of(words)
    for at in ([0, 1, 2, 3, 4], [4, 1, 1], []):
        part = slots.take(np.array(at, np.int64))
        for i, k in enumerate(at):
            slot, grams = toxicity.features(words[k])
            assert part.word[i] == slot and part.grams[part.edges[i] : part.edges[i + 1]].tolist() == grams
    assert len(toxicity.features("long" * 30)[1]) == 120


def test_highest_windows_with_little_held(monkeypatch):
    net = toxicity.Network(4)
    rng = np.random.default_rng(3)
    slots = toxicity.Slots.of([f"w{i}" for i in range(300)])
    lengths = np.array([0, 500, 3, 90, 0, 64, 1])
    flat = rng.integers(0, 300, lengths.sum())
    whole = toxicity.highest_windows(toxicity.Reader(net), slots, flat, lengths)
    monkeypatch.setattr(toxicity, "HELD", 70)
    some = toxicity.highest_windows(toxicity.Reader(net), slots, flat, lengths)
    assert [x.tolist() for x in whole] == [x.tolist() for x in some]


def test_an_insult_far_behind_is_learned_and_found():
    """The label of each bad text rests on a passage behind 25,000 characters of plain words."""
    rng = np.random.default_rng(8)
    plain = [f"word{i}" for i in range(400)]

    def text(n, *more):
        return " ".join([*rng.choice(plain, n), *more, *rng.choice(plain, 20)])

    insult = ["you", "utter", "grobnik"]
    pairs = [(text(4000, *insult), 1) for _ in range(25)] + [(text(40, *insult), 1) for _ in range(25)]
    pairs += [(text(int(rng.integers(20, 900))), 0) for _ in range(150)]
    net = toxicity.train(pairs)
    score = toxicity.Reader(net).score([text(5000, *insult), text(5000), text(30, *insult), text(30)])
    assert score[0] > 0.5 > score[1] and score[2] > 0.5 > score[3]


def test_training_is_the_same_in_any_order_of_reading(spark, tables):
    """Sampled rows: whole texts, repeated rows once, the same at any number of partitions."""
    docs, labels = tables
    some = shared.labelled(docs, labels, "toxic", 5)
    one = [(r.doc_id, r.text) for r in shared.sample(some, 60)]
    again = [(r.doc_id, r.text) for r in shared.sample(some.unionByName(some).repartition(9), 120)]
    assert one == again and 20 < len(one) < 120 and len(set(one)) == len(one)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(text[i] == t for i, t in one)


def test_columns_that_clash(spark, tables):
    docs, labels = tables
    few = docs.where("doc_id < 40").withColumn("toxicity_score", F.lit(5.0)).withColumn("toxicity_score_0", F.lit("x"))
    kept = toxicity.keep_clean(spark, few, labels)
    assert kept.columns == few.columns
    assert {(r.toxicity_score, r.toxicity_score_0) for r in kept.collect()} == {(5.0, "x")}


def test_quality_by_recomputation(spark, tables):
    """Scores, the exact cut and the decisions of every row, from the trained weights."""
    docs, labels = tables
    taken = shared.sample(shared.labelled(docs, labels, "quality", 5), quality.TRAIN_ROWS)
    weights, centre, quantile, slope = quality.train([(r.text, r.y) for r in taken])
    rows = docs.collect()
    strength = [float((quality.text_features([r.text])[0] - centre) @ weights) for r in rows]
    cut = sorted(strength)[max(1, math.ceil(len(rows) * quantile)) - 1]
    base = math.log(quality.THRESHOLD / (1 - quality.THRESHOLD))
    got = {r.doc_id: r for r in quality.quality(spark, docs, labels).collect()}
    for r, s in zip(rows, strength, strict=True):
        if abs(s - cut) > 1e-9:
            assert got[r.doc_id].predicted == int(s >= cut)
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-(slope * (s - cut) + base))), abs=1e-6)


def test_language_by_recomputation(spark, tables):
    """Document frequencies, TF-IDF, logits and the temperature of whole texts, by plain loops."""
    docs, _ = tables
    model = language.fit(docs)
    rows = [r for r in docs.collect() if r.lang is not None and crc32(str(r.doc_id).encode()) % 3 != 1]
    frequency = np.zeros(language.SLOTS)
    for r in rows:
        n = language.counts(r.text)
        frequency += (n > 0) if n is not None else 0
    known = sum(language.counts(r.text) is not None for r in rows)
    assert np.allclose(model.idf, np.log((1 + known) / (1 + frequency)) + 1)
    for r in docs.limit(40).collect():
        n = language.counts(r.text)
        at = np.flatnonzero(n)
        x = (1 + np.log(n[at])) * model.idf[at] if n is not None else None
        lang, score = model.predict(r.text)
        if x is None:
            assert lang == "und"
            continue
        x = x / np.sqrt((x * x).sum())
        z = (x @ model.weights[at] + model.bias) / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        assert lang == model.languages[int(p.argmax())] and score == pytest.approx(float(p.max()), abs=1e-4)


def test_toxic_rows_go_and_no_others(spark, tables):
    """The pipeline's first stage against the scores of the plain network, and against the labels."""
    import corpus_pipeline

    docs, labels = tables
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, DATA).collect()}
    net = toxicity.fit(docs, labels)
    score = dict(zip([r.doc_id for r in docs.collect()], toxicity.Reader(net).score([r.text for r in docs.collect()]), strict=True))
    near = {i for i, s in score.items() if abs(s - 0.5) < 1e-3}
    assert {i for i, s in score.items() if s < 0.5} - near == kept - near
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 1}
    clean = {r.doc_id for r in labels.collect() if r.toxic == 0}
    assert len(toxic & kept) < 0.1 * len(toxic) and len(clean - kept) < 0.02 * len(clean)


def test_pipeline(spark):
    """Each stage against what it must do to its own input."""
    import corpus_pipeline
    from test_llm_dedup import brute_links, norm

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    benchmark = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stage(function(spark, docs, folder), name)
        if name != "byte_bpe":
            assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        seen[name] = before, after
        assert after <= before.keys()
    before, after = seen["exact_dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(norm(before[i]), i)
    assert after == set(first.values())
    before, after = seen["jaccard_join"]
    assert after == {leader for _, leader, _ in brute_links(sorted(before.items()))}
    before, after = seen["decontamination"]
    assert after == {i for i, t in before.items() if not any(b in t for b in benchmark)}
    before, after = seen["byte_bpe"]
    assert after == before.keys()
    whole = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in whole.collect()} == after


def test_pipeline_stages_on_awkward_rows(spark, monkeypatch):
    """Columns that clash stay as they are, nulls and repeated rows have their stated results, and an
    empty table stays one."""
    import corpus_pipeline
    from llm_awkward import DATA as SMALL

    docs, nothing = frame(spark), empty(spark)
    net = toxicity.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: net)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, nothing, SMALL).count() == 0
        out = corpus_pipeline.stage(function(spark, docs, SMALL), name)
        if name == "byte_bpe":
            got = {r.doc_id: r.n_tokens for r in out.collect()}
            assert len(got) == out.count() == docs.count() and got[1] == 0
            continue
        assert out.columns == docs.columns
        assert {r.node for r in out.select("node", "file").collect()} == {"x"}
        if name == "exact_dedup":
            kept = [r.doc_id for r in out.collect()]
            # null and empty texts are one group, and so are the rows of one text
            assert 1 in kept and 2 not in kept and kept.count(7) == 1 and None not in kept
        docs = out
