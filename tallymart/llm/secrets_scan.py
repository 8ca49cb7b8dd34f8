"""Secret scan: base patterns, and a character convolutional network in numpy over every
other candidate with its surrounding context.

A candidate is a run of 16 or more of ``A-Za-z0-9+/_=-`` with a letter and a digit that no
base finding touches.  The network sees the characters before, in and after it: embedding,
one convolution, a maximum over the candidate and one over the context, a logistic unit.  A long
candidate is seen in overlapping windows, each with the candidate's context; the highest decides.
Base findings are the positive examples, each also in the context of
a negative one, so that the value is judged and not its keyword; long words, numbers and
addresses are negative.  Candidates are neither: nobody has labelled them.

A sample only gives the weights to begin with.  Then the examples of every row are dealt into groups by
their hash; in each of ``ROUNDS`` every group goes on learning from the same weights, and their mean over all
groups is what the next round begins with.  Scores are calibrated on the examples of all rows that
training has not seen, and the threshold is the highest that keeps ``RECALL`` of the secrets
among them; ``Network.precision`` says how many of those it lets through are secrets.  Where fewer than
``FEW`` secrets are held out, which tell no such share, those learned from count as well, and the threshold lies
halfway between the lowest secret and the highest other example if that is lower.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import sample, stage
from tallymart.operators.quantiles import order_statistics

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is always matched whole
KINDS = ("assign", "access", "hex", "model")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.ASCII)
_ORDINARY = re.compile(r"[\w.@:/-]{6,}")
_KEYWORDS = ("passw", "secret", "token", "api")

BEFORE, INSIDE, AFTER = 20, 44, 8
LENGTH = BEFORE + INSIDE + AFTER
CLASSES, EMBED, FILTERS, WIDTH = 72, 8, 24, 5
#: Characters between the windows of a long candidate.
STEP = INSIDE // 2
#: Bounds on the samples that training begins with, one of documents with findings and one of all: documents
#: (whole ones); and on examples: negatives of a kind per document, windows per long secret.
TRAIN_ROWS, NEGATIVES, WINDOWS = 4000, 3, 4
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Examples that learn together, and how often all rows are learned from.
GROUP, ROUNDS = 4096, 2
#: Weights are added up in whole numbers of this size, so that their order does not matter.
UNIT = 2.0**-28
#: One of so many values is held out, and bins to 1 of a raw score when it is calibrated.
HELD, BINS = 5, 64
RECALL = 0.98
FEW = 50
#: Windows that are scored at a time.
AT_ONCE = 8192

_CLASS = np.full(128, CLASSES - 1, np.int64)
for _n, _c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.:\"' "):
    _CLASS[ord(_c)] = min(_n + 1, CLASSES - 1)


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings, in order."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def untouched(places: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Those of some places that no span touches; the spans are in the order of their starts."""
    starts, ends = [], []
    for start, _, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for start, end in places:
        i = bisect_left(starts, end) - 1  # the last stretch that begins before the place ends
        if i < 0 or ends[i] <= start:
            out.append((start, end))
    return out


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs that may be secrets and touch no base finding."""
    return untouched([m.span() for m in CANDIDATE.finditer(text) if _MIXED.match(m[0])], spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def seen(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters before, in and after a candidate; 0 where there are none.  A row
    for each of its windows: one, if it is no longer than ``INSIDE``."""

    def classes(begin: int, to: int) -> np.ndarray:
        codes = np.frombuffer(text[begin:to].encode("utf-32-le", "surrogatepass"), np.uint32)
        return _CLASS[np.minimum(codes, 127)]

    over = max(0, end - start - INSIDE)
    begins = np.minimum(np.arange(0, over + STEP, STEP), over) if over else np.zeros(1, np.int64)
    rows = np.zeros((len(begins), LENGTH), np.uint8)
    before, inside, after = classes(max(0, start - BEFORE), start), classes(start, end), classes(end, end + AFTER)
    rows[:, BEFORE - len(before) : BEFORE] = before
    rows[:, BEFORE + INSIDE : BEFORE + INSIDE + len(after)] = after
    for row, begin in zip(rows, begins, strict=True):
        part = inside[begin : begin + INSIDE]
        row[BEFORE : BEFORE + len(part)] = part
    return rows


@dataclass
class Network:
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    precision: float = 0.0  # at the threshold, among examples that training has not seen

    @classmethod
    def new(cls, seed: int = 23) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            {
                "embed": rng.standard_normal((CLASSES, EMBED)) * 0.3,
                "filters": rng.standard_normal((WIDTH * EMBED, FILTERS)) * 0.2,
                "bias": np.zeros(FILTERS),
                "out": rng.standard_normal(2 * FILTERS) * 0.2,
                "zero": np.zeros(1),
            }
        )

    def logits(self, rows: np.ndarray) -> np.ndarray:
        p, n = self.p, len(rows)
        x = p["embed"][rows]
        places = LENGTH - WIDTH + 1
        wide = np.concatenate([x[:, i : i + places] for i in range(WIDTH)], axis=2)
        a = np.maximum(wide @ p["filters"] + p["bias"], 0)
        inside = np.zeros(places, bool)
        inside[BEFORE - WIDTH // 2 : BEFORE + INSIDE - WIDTH // 2] = True
        parts, where = [], []
        for mask in (inside, ~inside):
            at = np.flatnonzero(mask)
            best = at[a[:, at].argmax(axis=1)]
            where.append(best)
            parts.append(np.take_along_axis(a, best[:, None, :], axis=1)[:, 0])
        pooled = np.concatenate(parts, axis=1)
        self.kept = rows, wide, a, where, pooled, n
        return pooled @ p["out"] + p["zero"]

    def gradients(self, d: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        rows, wide, a, where, pooled, n = self.kept
        da = np.zeros_like(a)
        dp = d[:, None] * p["out"]
        for k, best in enumerate(where):
            part = dp[:, k * FILTERS : (k + 1) * FILTERS]
            np.put_along_axis(da, best[:, None, :], part[:, None, :], axis=1)
        da *= a > 0
        dwide = da @ p["filters"].T
        dx = np.zeros((n, LENGTH, EMBED))
        for i in range(WIDTH):
            dx[:, i : i + a.shape[1]] += dwide[:, :, i * EMBED : (i + 1) * EMBED]
        embed = np.zeros_like(p["embed"])
        np.add.at(embed, rows, dx)
        return {
            "embed": embed,
            "filters": np.einsum("npw,npf->wf", wide, da, optimize=True),
            "bias": da.sum(axis=(0, 1)),
            "out": pooled.T @ d,
            "zero": np.array([d.sum()]),
        }

    def raw(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        z = np.concatenate([self.logits(rows[i : i + 512]) for i in range(0, len(rows), 512)])
        self.kept = None  # what gradients need should not travel
        return z

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(rows) + self.shift, -40, 40)))


def examples(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows the network sees and their labels, from base findings and what is none."""
    positive, negative, contexts = [], [], []
    rng = np.random.default_rng(29)
    for text in texts:
        spans = base(text)
        for start, kind, end in spans:
            if kind == 0:
                start = ASSIGN.match(text, start).start(2)
            rows = seen(text, start, end)
            positive += list(rows[:: -(-len(rows) // WINDOWS)])
        unknown = [(s, 3, e) for s, e in candidates(text, spans)]
        plain = untouched([m.span() for m in _ORDINARY.finditer(text)], sorted([*spans, *unknown]))
        others = [plain[i] for i in rng.permutation(len(plain))[:NEGATIVES]]
        marked = [x for x in plain if re.search(r"[0-9@]", text[x[0] : x[1]])]
        others += marked[:NEGATIVES]
        for start, end in others:
            negative.append(seen(text, start, end)[0])
            contexts.append(negative[-1])
    for row in positive[:] if contexts else []:
        other = contexts[int(rng.integers(len(contexts)))].copy()
        other[BEFORE : BEFORE + INSIDE] = row[BEFORE : BEFORE + INSIDE]
        positive.append(other)
    rows = [*positive, *negative]
    labels = np.array([1.0] * len(positive) + [0.0] * len(negative))
    return np.array(rows, np.uint8).reshape(-1, LENGTH), labels


def held_out(rows: np.ndarray) -> np.ndarray:
    """Which examples are never learned from: those of some values, whatever their context."""
    inside = np.ascontiguousarray(rows[:, BEFORE : BEFORE + INSIDE])
    return np.array([zlib.crc32(row) % HELD == 0 for row in inside], bool)


def learn(net: Network, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int) -> None:
    """Adam on the examples in random order, from the network's weights on."""
    rng = np.random.default_rng(31)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    for _ in range(epochs):
        at = rng.permutation(len(rows))
        for i in range(0, len(at), BATCH):
            part = at[i : i + BATCH]
            p = 1 / (1 + np.exp(-np.clip(net.logits(rows[part]), -40, 40)))
            grads = net.gradients((p - y[part]) * weight[part] / len(part))
            step += 1
            for k, g in grads.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] = net.p[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.kept = None


def calibrate(net: Network, z: np.ndarray, t: np.ndarray, count: np.ndarray) -> None:
    """Platt scaling on raw scores of examples not learned from, each there ``count`` times."""
    net.slope, net.shift = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -40, 40)))
        net.slope -= 0.1 * float(np.average((p - t) * z, weights=count))
        net.shift -= 0.1 * float(np.average(p - t, weights=count))


def train(texts: Iterable[str]) -> Network:
    """Without a finding or without anything else in the sample the network adds nothing."""
    net = Network.new()
    rows, y = examples(texts)
    if len(y) == 0 or y.min() == y.max():
        return net
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    held = held_out(rows)
    learn(net, rows[~held], y[~held], weight[~held], EPOCHS)
    if not held.any():
        return net
    z, t = net.raw(rows[held]), y[held]
    calibrate(net, z, t, np.ones(len(z)))
    score = net.score(rows[held])
    secret = np.sort(score[t == 1])
    if len(secret):
        net.threshold = float(secret[int((1 - RECALL) * len(secret))])
        net.precision = float((score >= net.threshold)[t == 1].sum() / (score >= net.threshold).sum())
    return net


def with_findings(rows: DataFrame) -> DataFrame:
    """doc_id and text of all rows in which the base patterns find something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bool(base(text)) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(found, pa.bool_()))

    return rows.mapInArrow(run, "doc_id long, text string")


EXAMPLE = "window binary, secret boolean, held boolean"


def all_examples(rows: DataFrame) -> DataFrame:
    """The examples of every row, equal ones once: what the network sees, whether it is a secret, held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found, y = examples([text])
                if len(found):
                    columns = [[row.tobytes() for row in found], y == 1, held_out(found)]
                    types = [pa.binary(), pa.bool_(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["window", "secret", "held"]
                    )

    return rows.select("text").mapInArrow(run, EXAMPLE).distinct()


def _rows(window: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(window.to_pylist()), np.uint8).reshape(-1, LENGTH)


def averaged(net: Network, told: DataFrame, of: dict[bool, int]) -> Network:
    """A round: every group of examples learns from the weights of ``net`` on; the mean over all examples.

    ``of`` tells how many of them are secrets and how many are none.
    """
    names, n = sorted(net.p), sum(of.values())
    weight = {secret: 0.5 * n / of[secret] for secret in of}
    part = F.pmod(F.xxhash64("window", "secret"), F.lit(-(-n // GROUP)))
    shared = told.sparkSession.sparkContext.broadcast(net)

    def run(group: pa.Table) -> pa.Table:
        rows, y = _rows(group.column("window")), group.column("secret").to_numpy().astype(float)
        order = np.lexsort([*rows.T, y])  # the same at every parallelism
        mine = Network(dict(shared.value.p))
        learn(mine, rows[order], y[order], np.where(y[order] == 1, weight[True], weight[False]), 1)
        flat = np.concatenate([mine.p[k].ravel() for k in names])
        values = np.rint(flat * len(rows) / UNIT).astype(np.int64)
        return pa.table({"place": pa.array(np.arange(len(flat)), pa.int32()), "value": values})

    learned = told.groupBy(part.alias("part")).applyInArrow(run, "place int, value long")
    total = learned.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    shared.destroy()
    flat, p, at = np.array([r.value for r in total]) * UNIT / n, {}, 0
    for k in names:
        p[k] = flat[at : at + net.p[k].size].reshape(net.p[k].shape)
        at += net.p[k].size
    return Network(p)


def judged(net: Network, told: DataFrame) -> Network:
    """``net`` calibrated on the examples held out, with their threshold; without a secret it adds nothing."""
    few = told.where("held and secret").count() < FEW
    told = told.where("held or secret" if few else "held")
    shared = told.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = pa.array(shared.value.raw(_rows(batch.column("window"))), pa.float64())
            yield pa.RecordBatch.from_arrays([z, batch.column("secret")], ["z", "secret"])

    found = stage(told.mapInArrow(run, "z double, secret boolean"), "scores")
    # raw scores beyond 64 are as sure as can be: at most 16,000 bins
    sure = F.round(F.greatest(F.lit(-64.0), F.least(F.lit(64.0), "z")) * BINS).cast("int")
    bins = found.groupBy(sure.alias("bin"), "secret").count().orderBy("bin", "secret").collect()
    known = sum(r["count"] for r in bins if r.secret)
    if not known:
        return net
    z, t, count = (np.array(c, float) for c in zip(*[(r.bin / BINS, r.secret, r["count"]) for r in bins], strict=True))
    calibrate(net, z, t, count)
    if net.slope <= 0:
        return net
    place = (int((1 - RECALL) * known) + 0.5) / known
    cut = order_statistics(found.where("secret"), ["z"], [place])["z"].quantiles[place]
    if few:
        plain = found.where("not secret").agg(F.max("z")).first()[0]
        cut = min(cut, (cut + plain) / 2 if plain is not None else cut)
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * np.array([cut]) + net.shift, -40, 40)))[0])
    above = {r.secret: r["count"] for r in found.where(F.col("z") >= cut).groupBy("secret").count().collect()}
    net.precision = above[True] / sum(above.values())
    return net


def fit(docs: DataFrame) -> Network:
    """Learned, calibrated and cut off on the examples of all rows; a sample gives the weights to begin with."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = (r.text for r in sample(with_findings(rows), TRAIN_ROWS))
    others = (r.text for r in sample(rows, TRAIN_ROWS))
    net = train(chain(found, (t for t in others if not base(t))))
    told = stage(all_examples(rows), "examples")
    of = {r.secret: r["count"] for r in told.where("not held").groupBy("secret").count().collect()}
    if len(of) < 2:
        return Network.new()
    for _ in range(ROUNDS):
        net = averaged(net, told.where("not held"), of)
    return judged(net, told)


def secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, findings (array of kind, start, end, score), in order.

    Places are code points, the end is not in it.  Base findings score 1; a null or empty text has
    none; repeated rows stay; an empty table gives no rows; further columns are not read.  A text is
    read whole, in time that grows with its length and its findings, not with their product.
    """
    shared = spark.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        finding = pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
        )
        for batch in batches:
            found, rows, owner, held = [], [], [], 0

            def judge() -> None:
                """Scores the windows gathered so far; each candidate has that of its highest."""
                scores = net.score(np.concatenate(rows)) if rows else np.zeros(0)
                edges = np.cumsum([0, *map(len, rows)])
                for (i, start, end), a, b in zip(owner, edges, edges[1:], strict=False):
                    score = float(scores[a:b].max())
                    if score >= net.threshold:
                        found[i].append((start, 3, end, score))
                rows.clear()
                owner.clear()

            for i, text in enumerate(batch.column("text").to_pylist()):
                spans = base(text or "")
                found.append([(s, k, e, 1.0) for s, k, e in spans])
                for start, end in candidates(text or "", spans):
                    rows.append(seen(text, start, end))
                    owner.append((i, start, end))
                    held += len(rows[-1])
                    if held >= AT_ONCE:
                        judge()
                        held = 0
            judge()
            values = [
                [{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in sorted(x)] for x in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.list_(finding))], ["doc_id", "findings"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, findings array<struct<kind: string, start: int, end: int, score: double>>"
    )


def report(found: DataFrame) -> DataFrame:
    """Counts, digest of the base findings and all spans, from ``findings``."""

    def spans(where: str) -> str:
        kept = f"filter(findings, f -> {where})"
        return f"array_join(transform({kept}, f -> concat_ws(':', f.kind, f.start, f.end)), ',')"

    counts = [F.expr(f"bigint(size(filter(findings, f -> f.kind = '{k}')))").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(spans("f.kind != 'model'")), 256).alias("base_sha256"),
        F.expr(spans("true")).alias("spans"),
    )
