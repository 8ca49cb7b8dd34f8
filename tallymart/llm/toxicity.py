"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A window of ``WINDOW`` words is one sequence, windows overlap by a quarter.  The input of a
word joins a vector of the word (hashed) and the mean of vectors of its character
trigrams (hashed).  Two gated recurrent units read the window from either side;
attention pools their states; a logistic unit scores the window.  A document scores as
its highest window.  Training treats a document as a bag of windows: the loss is taken
at its highest window, so one insult in a long text is enough to learn from.

All windows of every text are scored.  Per distinct word of a block the input and its
products with the gates' matrices are computed once, then gathered per position.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import fold, labelled, sample

#: Words of a window and the step between windows.
WINDOW, STEP = 32, 24
#: Bound on the training sample: documents, whole (training only).
TRAIN_ROWS = 4000
#: Words of the sample that are scored at a time while training.
HELD = 60_000
WORDS, GRAMS, INPUT, HIDDEN = 1 << 14, 1 << 12, 12, 8
EPOCHS, BATCH, RATE = 6, 32, 0.02
#: Documents by which a word's class odds are drawn to the overall ones, so that a word met
#: once tells little, and the decay of word and trigram vectors.
PRIOR, DECAY = 50.0, 0.02
#: Words whose gate inputs a task keeps at a time; it starts anew when there are more.
REMEMBERED = 60_000
SCHEMA = "doc_id long, score double"
_TOKEN = re.compile(r"[^\W\d_]+|\d+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def features(word: str) -> tuple[int, list[int]]:
    """Slots of the word and of its character trigrams."""
    w = f"<{word}>"
    grams = [crc32(w[i : i + 3].encode()) % GRAMS for i in range(len(w) - 2)]
    return crc32(word.encode()) % WORDS, grams


class Slots:
    """Slots of many words and their trigrams, in flat arrays."""

    def __init__(self, word: np.ndarray, grams: np.ndarray, edges: np.ndarray):
        self.word, self.grams, self.edges = word, grams, edges

    def __len__(self) -> int:
        return len(self.word)

    @classmethod
    def of(cls, words: Iterable[str]) -> Slots:
        word, grams, edges = array("i"), array("H"), array("q", [0])
        for w in words:
            slot, mine = features(w)
            word.append(slot)
            grams.extend(mine)
            edges.append(len(grams))
        return cls(*(np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, x.typecode) for x in (word, grams, edges)))

    def take(self, at: np.ndarray) -> Slots:
        sizes = self.edges[at + 1] - self.edges[at]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        grams = np.repeat(self.edges[at] - edges[:-1], sizes) + np.arange(edges[-1])
        return Slots(self.word[at], self.grams[grams], edges)


def window_places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and size of every window of texts of these lengths; see ``windows``."""
    over = np.maximum(lengths - WINDOW, 0)
    count = -(-over // STEP) + 1
    bag = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(len(bag)) - np.repeat(np.cumsum(count) - count, count)
    return bag, np.minimum(place * STEP, over[bag]), np.minimum(lengths, WINDOW)[bag]


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover n words; one, maybe empty, for a short text."""
    if n <= WINDOW:
        return [(0, n)]
    starts = list(range(0, n - WINDOW, STEP)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(x * np.float32(0.5)) + np.float32(1))


class Network:
    """Parameters by name; forward and backward over windows of equal padded length."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": draw(WORDS, INPUT, scale=0.05), "gram": draw(GRAMS, INPUT, scale=0.05)}
        for d in "fb":
            self.p |= {
                f"W{d}": draw(INPUT, 3 * HIDDEN),
                f"U{d}": draw(HIDDEN, 3 * HIDDEN),
                f"c{d}": np.zeros(3 * HIDDEN, np.float32),
            }
        self.p |= {
            "A": draw(2 * HIDDEN, HIDDEN),
            "a": draw(HIDDEN),
            "v": draw(2 * HIDDEN),
            "o": np.array([-1.0], np.float32),
        }

    def inputs(self, slots: Slots) -> np.ndarray:
        """A row per word."""
        sizes = np.diff(slots.edges)
        total = np.zeros((len(slots), INPUT), np.float32)
        if len(slots.grams):
            # each word has a trigram, as its ends are marked, but words of no text may have none
            some = np.flatnonzero(sizes)
            total[some] = np.add.reduceat(self.p["gram"][slots.grams], slots.edges[:-1][some], axis=0)
        self.looked = slots.word, slots.grams, np.repeat(np.arange(len(slots)), sizes), sizes
        return self.p["word"][slots.word] + total / np.maximum(sizes, 1)[:, None].astype(np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """x: (time, batch, 3 hidden) gate inputs.  Padding leaves the state as it is."""
        p, (n, m, _) = self.p, x.shape
        h = np.zeros((m, HIDDEN), np.float32)
        out = np.empty((n, m, HIDDEN), np.float32)
        held = []
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            u = h @ p[f"U{d}"]
            zr = _sigmoid(x[t, :, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            g = np.tanh(x[t, :, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            if keep:
                held.append((t, h, z, r, g, u[:, 2 * HIDDEN :]))
            z = z * mask[t][:, None]
            h = h + z * (g - h)
            out[t] = h
        return out, held

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]

    def forward(self, gates, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """ids, mask: (time, batch) rows of ``gates`` and 1 where there is a word."""
        p = self.p
        forth, kf = self._run(gates[0][ids], mask, "f", keep)
        back, kb = self._run(gates[1][ids], mask, "b", keep)
        s = np.concatenate([forth, back], axis=2)
        k = np.tanh(s @ p["A"])
        e = np.where(mask > 0, k @ p["a"], np.float32(-1e9))
        w = np.exp(e - e.max(axis=0)) * mask
        w /= np.maximum(w.sum(axis=0), np.float32(1e-9))
        pooled = (w[:, :, None] * s).sum(axis=0)
        logit = pooled @ p["v"] + p["o"]
        if keep:
            self.kept = s, k, w, pooled, kf, kb, ids, mask
        return logit

    def backward(self, dlogit: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        s, k, w, pooled, kf, kb, ids, mask = self.kept
        g = {"v": pooled.T @ dlogit, "o": np.array([dlogit.sum()])}
        dpooled = dlogit[:, None] * p["v"]
        ds = w[:, :, None] * dpooled
        dw = (s * dpooled).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=0))
        dk = de[:, :, None] * p["a"] * (1 - k * k)
        g["a"] = np.einsum("tb,tbh->h", de, k)
        g["A"] = np.einsum("tbs,tbh->sh", s, dk)
        ds = ds + dk @ p["A"].T
        dx = np.zeros_like(x)
        for d, kept, part in (("f", kf, ds[:, :, :HIDDEN]), ("b", kb, ds[:, :, HIDDEN:])):
            dgates = np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            dU, dh = np.zeros_like(p[f"U{d}"]), np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, h, z, r, c, un in reversed(kept):
                dh = dh + part[t]
                m = mask[t][:, None]
                dz = dh * (c - h) * m * z * (1 - z)
                dc = dh * z * m * (1 - c * c)
                dr = dc * un * r * (1 - r)
                du = np.concatenate([dz, dr, dc * r], axis=1)
                dgates[t] = np.concatenate([dz, dr, dc], axis=1)
                dU += h.T @ du
                dh = dh * (1 - z * m) + du @ p[f"U{d}"].T
            total = np.zeros((len(x), 3 * HIDDEN), np.float32)
            np.add.at(total, ids.ravel(), dgates.reshape(-1, 3 * HIDDEN))
            g[f"W{d}"], g[f"U{d}"], g[f"c{d}"] = x.T @ total, dU, total.sum(axis=0)
            dx += total @ p[f"W{d}"].T
        word, grams, at, sizes = self.looked
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], word, dx)
        np.add.at(g["gram"], grams, (dx / np.maximum(sizes, 1)[:, None])[at])
        return g


class Reader:
    """Scores texts with a trained network; remembers what it computed per distinct word."""

    def __init__(self, net: Network):
        p = self.p = net.p
        self.net = net
        # tanh(x / 2) gives the sigmoid, so the halves are taken once, here
        half = np.concatenate([np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)]).astype(np.float32)
        self.half = half
        self.U = {d: np.ascontiguousarray((p[f"U{d}"] * half).T) for d in "fb"}
        self.At = np.ascontiguousarray(p["A"].T)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.known = 0
        self.table = {d: np.zeros((3 * HIDDEN, 1024), np.float32) for d in "fb"}

    def look_up(self, words: list[str]) -> np.ndarray:
        rows = self.rows
        return np.fromiter((rows.setdefault(w, len(rows)) for w in words), np.int64, len(words))

    def learn(self) -> None:
        """Gate inputs of the words met since the last call."""
        new = list(self.rows)[self.known :]
        if not new:
            return
        gates = self.net.gates(self.net.inputs(Slots.of(new)))
        for d, g in zip("fb", gates, strict=True):
            if self.table[d].shape[1] < len(self.rows):
                grown = np.zeros((3 * HIDDEN, 2 * len(self.rows)), np.float32)
                grown[:, : self.known] = self.table[d][:, : self.known]
                self.table[d] = grown
            self.table[d][:, self.known : len(self.rows)] = (g * self.half).T
        self.known = len(self.rows)

    def _direction(self, ids: np.ndarray, size: np.ndarray, full: bool, d: str) -> np.ndarray:
        n, m = ids.shape
        h = np.zeros((HIDDEN, m), np.float32)
        out = np.empty((n, HIDDEN, m), np.float32)
        two = 2 * HIDDEN
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            x = np.take(self.table[d], ids[t], axis=1)
            u = self.U[d] @ h
            x[:two] += u[:two]
            zr = np.tanh(x[:two])
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            g = u[two:]
            g *= zr[HIDDEN:]
            g += x[two:]
            np.tanh(g, out=g)
            g -= h
            g *= zr[:HIDDEN]
            if not full:
                g *= t < size
            h = h + g
            out[t] = h
        return out

    def logits(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """ids: (time, batch) rows of the table; size: words of each window."""
        n, m = ids.shape
        full = bool(size.min() == n)
        s = np.concatenate([self._direction(ids, size, full, d) for d in "fb"], axis=1)
        k = np.tanh(np.matmul(self.At, s))
        e = np.einsum("thm,h->tm", k, self.p["a"])
        e -= e.max(axis=0)
        w = np.exp(e, out=e)
        if not full:
            w *= np.arange(n)[:, None] < size
        w /= np.maximum(w.sum(axis=0), np.float32(1e-9))
        return np.einsum("tm,thm,h->m", w, s, self.p["v"], optimize=True) + self.p["o"]

    def hold(self, slots: Slots) -> None:
        """Gate inputs of some words, in place of those known so far; their rows are their numbers."""
        gates = self.net.gates(self.net.inputs(slots))
        self.table = {d: np.ascontiguousarray((g * self.half).T) for d, g in zip("fb", gates, strict=True)}

    def all_windows(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, start, size and logit of every window of texts given as rows of words, end to end."""
        base = np.cumsum(lengths) - lengths
        flat = np.append(flat, 0)
        bag, start, size = window_places(lengths)
        begin = base[bag] + start
        logit = np.empty(len(begin), np.float32)
        by_size = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[by_size] == WINDOW, prepend=False))
        for part in np.split(by_size, cuts):
            for i in range(0, len(part), 768):
                mine = part[i : i + 768]
                t = np.arange(max(1, size[mine].max()))[:, None]
                where = begin[mine] + np.minimum(t, np.maximum(size[mine] - 1, 0))
                logit[mine] = self.logits(flat[where], size[mine])
        return bag, start, size, logit

    def score(self, texts: list[str | None], held_words: int = 60_000) -> np.ndarray:
        """Highest window score of each text; some ``held_words`` words are held at a time."""
        out, rows, held, first = np.zeros(len(texts)), [], 0, 0
        for i, text in enumerate(texts):
            rows.append(self.look_up(tokens(text)))
            held += len(rows[-1])
            if held >= held_words or i + 1 == len(texts):
                self.learn()
                lengths = np.array([len(r) for r in rows])
                bag, _, _, logit = self.all_windows(np.concatenate(rows), lengths)
                best = np.full(len(rows), -np.inf)
                np.maximum.at(best, bag, logit)
                out[first : i + 1] = 1 / (1 + np.exp(-best))
                rows, held, first = [], 0, i + 1
                if len(self.rows) > REMEMBERED:
                    self.forget()
        return out


def train(pairs: Iterable[tuple[str, int]]) -> Network:
    """Fit on (text, 0/1) pairs.  With one class only, or none, the bias alone is set.

    Of the texts only numbers are kept.  Each epoch scores all windows of the sample, some
    ``HELD`` words at a time, and trains on each text's highest one.
    """
    net = Network()
    vocabulary: dict[str, int] = {}
    rows, labels = [], []
    for text, label in pairs:
        found = (vocabulary.setdefault(w, len(vocabulary)) for w in tokens(text))
        rows.append(np.fromiter(found, np.int32))
        labels.append(label)
    y = np.array(labels, np.float32)
    base_rate = (y.sum() + 0.5) / (len(y) + 1)
    if len(set(labels)) < 2:
        net.p["v"][:] = 0
        net.p["o"][:] = np.log(base_rate / (1 - base_rate))
        return net
    slots = Slots.of(vocabulary or [""])
    del vocabulary
    lengths = np.array([len(r) for r in rows])
    base = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.concatenate(rows)
    del rows
    # the first input starts as the class log-odds of the word's slot, from all training rows
    seen = np.zeros((2, WORDS), np.float32)
    for i, label in enumerate(labels):
        seen[int(label), np.unique(slots.word[flat[base[i] : base[i + 1]]])] += 1
    rate = y.mean()
    odds = (seen[1] + PRIOR * rate) / (seen[0] + PRIOR * (1 - rate)) * (1 - rate) / rate
    net.p["word"][:, 0] = np.clip(np.log(odds), -3, 3)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    order, step = np.random.default_rng(5), 0
    for epoch in range(EPOCHS):
        begin, size = highest_windows(Reader(net), slots, flat, lengths)
        at = order.permutation(len(lengths))
        for i in range(0, len(at), BATCH):
            part = at[i : i + BATCH]
            mine = [flat[base[j] + begin[j] : base[j] + begin[j] + size[j]] for j in part]
            sizes = size[part]
            ids = np.zeros((max(1, sizes.max()), len(mine)), np.int64)
            mask = (np.arange(len(ids))[:, None] < sizes).astype(np.float32)
            ids.T[mask.T > 0] = np.concatenate(mine)
            used, ids = np.unique(ids, return_inverse=True)
            x = net.inputs(slots.take(used))
            logit = net.forward(net.gates(x), ids.reshape(mask.shape), mask, keep=True)
            grads = net.backward((_sigmoid(logit) - y[part]) / len(part), x)
            step += 1
            rate = RATE * 0.5 ** (epoch // 2)
            for k, grad in grads.items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                rate_now = rate * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                kept = 1 - rate * DECAY if k in ("word", "gram") else 1.0
                net.p[k] = (net.p[k] * kept - rate_now * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return net


def highest_windows(reader: Reader, slots: Slots, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the highest window of each text; ties go to the first."""
    begin, size = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        low = ends[first] - lengths[first]
        to = max(first + 1, int(np.searchsorted(ends, low + HELD, side="right")))
        words, local = np.unique(flat[low : ends[to - 1]], return_inverse=True)
        reader.hold(slots.take(words) if len(words) else slots.take(np.zeros(1, np.int64)))
        bag, start, width, logit = reader.all_windows(local, lengths[first:to])
        best = np.lexsort((-logit, bag))
        best = best[np.searchsorted(bag[best], np.arange(to - first))]
        begin[first:to], size[first:to] = start[best], width[best]
        first = to
    return begin, size


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on about ``TRAIN_ROWS`` labelled documents, whole ones, outside the held-out fold."""
    return train((r.text, r.y) for r in sample(labelled(docs, labels, "toxic", 5), TRAIN_ROWS))


def scored(spark: SparkSession, docs: DataFrame, net: Network, name: str = "toxicity_score") -> DataFrame:
    """``docs`` with the score in a further column ``name``; every window of every text is read.

    Null and empty texts score as an empty window does.  The columns of ``docs`` stay; one that
    is called ``name`` already is refused.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name}")
    shared = spark.sparkContext.broadcast(net.p)  # about 1 MB, whatever the input

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Network()
        model.p = shared.value
        reader = Reader(model)
        for texts in parts:
            yield pd.Series(reader.score(texts.tolist()), dtype="float64")

    return docs.withColumn(name, score("text"))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Repeated rows give repeated rows, an empty table none; a null id counts as not held out unless the crc32
    of the empty text says so (it does: remainder 0).
    """
    net = fit(docs, labels)
    out = scored(spark, docs.select("doc_id", "text"), net)
    return out.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents below the threshold, with their columns as they were, whatever their names.

    Null and empty texts are judged by the score of an empty window; repeated rows go or stay
    together; an empty table stays one, and without labels nothing is learned but their rate.
    """
    name = next(n for n in (f"toxicity_score_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    out = scored(spark, docs, fit(docs, labels), name)
    return out.where(F.col(name) < threshold).drop(name)
