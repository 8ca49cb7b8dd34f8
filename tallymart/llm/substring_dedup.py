"""Substring dedup by relative Lempel-Ziv parsing of every document against all of them.

A duplicate is a window of ``WINDOW`` words that also starts earlier.  The reference index
holds every window that can be one: in each window the run of ``GRAM`` words with the least
hash is its anchor, equal windows have equal anchors, and only anchors met in two texts (or
twice in one) are indexed.  The index is dealt out by anchor; for each window it gives the
earliest occurrence.  A document is then factored greedily: a factor runs on while the
earliest occurrences of its windows run on in one reference document.  At a factor's end the
window across the boundary is looked up like any other, so a duplicate that straddles two
factors is found too.  Factors are at least a window long; the words they cover go.

Texts of equal word sequence are one text; all but the first are single factors.  Anchors of
more than ``HOT`` documents are resolved by aggregates that combine before they shuffle, the
others by one sorted pass over their part of the index, which holds one anchor at a time.
Equality of windows is that of two 64-bit hashes (anchor and window).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.filters import BITS, bitmap, held, slot
from tallymart.llm.shared import stage
from tallymart.llm.words import SECOND_BASE, Block, blocks, prefix, run_hash, shingles, sliding_min

WINDOW, GRAM, HOT = 20, 6, 10_000
LAST = 2**63 - 1
NOTHING = hashlib.sha256(b"").hexdigest()


def _whole(block: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's word sequence."""
    first = run_hash(prefix(h, SECOND_BASE), block.bounds[:-1], block.bounds[1:], SECOND_BASE)
    base = 0xC2B2AE3D27D4EB4F
    return first, run_hash(prefix(h, base), block.bounds[:-1], block.bounds[1:], base)


def _anchors(block: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, text and anchor of every window that lies in one text."""
    least = sliding_min(shingles(h, GRAM), WINDOW - GRAM + 1)
    text = np.repeat(np.arange(block.n), np.diff(block.bounds))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + WINDOW <= block.bounds[1:][text])
    return start, text[start], least[start]


def _occurrences(block: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and anchor for each place at which a run of words is the anchor of some window."""
    start, text, anchor = _anchors(block, h)
    runs, span = shingles(h, GRAM), WINDOW - GRAM + 1
    if not len(start):
        return text, anchor
    # a run is an anchor if it is the greatest anchor among the windows it lies in
    of_window = np.zeros(len(runs) + span - 1, np.uint64)
    of_window[start + span - 1] = anchor
    place = np.flatnonzero(~sliding_min(~of_window, span) == runs)
    owner = np.searchsorted(block.bounds, place, side="right") - 1
    return owner, runs[place]


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    offsets = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, h1, h2, sha (of the words), anchors, again (anchors that come back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                h = block.hashes()
                h1, h2 = _whole(block, h)
                text, anchor = _occurrences(block, h)
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                same = (anchor[1:] == anchor[:-1]) & (text[1:] == text[:-1])
                one = np.ones(len(text), bool)
                one[1:] = ~same
                back = np.flatnonzero(one[:-1] & same) if len(one) else np.zeros(0, np.int64)
                data = block.data.tobytes()
                edges = block.offsets.tolist()
                sha = [
                    hashlib.sha256(b" ".join(data[a:b].split())).hexdigest()
                    for a, b in zip(edges[:-1], edges[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.n),
                        pa.array(np.diff(block.bounds), pa.int64()),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.array(sha),
                        _lists(anchor[one].view(np.int64), text[one], block.n, pa.int64()),
                        _lists(anchor[back].view(np.int64), text[back], block.n, pa.int64()),
                    ],
                    ["doc_id", "n_words", "h1", "h2", "sha", "anchors", "again"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, h1 long, h2 long, sha string, anchors array<long>, again array<long>",
    )


def repeated_anchors(prints: DataFrame) -> DataFrame:
    """anchor, n (texts with it, copies not told apart) of anchors met in two texts or twice in one."""
    every = prints.select("h1", F.explode("anchors").alias("anchor"))
    back = prints.select(F.explode("again").alias("anchor"), F.lit(0).alias("n")).distinct()
    shared = (
        every.groupBy("anchor")
        .agg(F.min("h1").alias("least"), F.max("h1").alias("most"), F.count("*").alias("n"))
        .where("least < most")
        .select("anchor", "n")
    )
    return shared.unionByName(back).groupBy("anchor").agg(F.max("n").alias("n"))


def _only(prints: DataFrame, spark: SparkSession, bits: bytes) -> DataFrame:
    """doc_id, h1, anchor for anchors that may be in the bitmap."""
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            lists = batch.column("anchors")
            values = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            good = held(filled, values & (BITS - 1))
            at = pa.array(owner[good])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("h1").take(at), pa.array(values[good])],
                ["doc_id", "h1", "anchor"],
            )

    return prints.select("doc_id", "h1", "anchors").mapInArrow(run, "doc_id long, h1 long, anchor long")


def _maybe(docs: DataFrame, spark: SparkSession, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id may be among ``ids``: all that are, and some others."""
    shared = spark.sparkContext.broadcast(bitmap(ids.select(slot(F.col("doc_id")).alias("slot"))))

    @F.pandas_udf("boolean")
    def among(slots):
        import pandas as pd

        return pd.Series(held(np.frombuffer(shared.value, np.uint8), slots.to_numpy()))

    return docs.select("doc_id", "text").where(among(slot(F.col("doc_id"))))


def _windows(texts: DataFrame) -> DataFrame:
    """Of each text the windows with an indexed anchor, by anchor: positions and hashes.

    A window that comes back in its own text is listed once there; its later positions form
    a row without anchor whose hashes are the first position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own, lists = batch.column("doc_id"), batch.column("h1").to_numpy(), batch.column("found")
            for block in blocks(batch.column("text")):
                h = block.hashes()
                h1 = _whole(block, h)[0].view(np.int64)
                start, text, anchor = _anchors(block, h)
                whole = shingles(h, WINDOW, SECOND_BASE).view(np.int64)
                edges = np.searchsorted(text, np.arange(block.n + 1))
                rows: list[tuple] = []
                for i in range(block.n):
                    at = block.first + i
                    if h1[i] != own[at]:
                        continue  # another text with this id
                    found = lists[at].values
                    wanted = found.field("anchor").to_numpy()
                    hot = dict(zip(wanted.tolist(), found.field("hot").to_pylist(), strict=True))
                    mine = slice(edges[i], edges[i + 1])
                    chosen = np.isin(anchor[mine].view(np.int64), wanted)
                    s, a = start[mine][chosen], anchor[mine][chosen].view(np.int64)
                    w = whole[s]
                    place = (s - block.bounds[i]).astype(np.int32)
                    _, first, back = np.unique(w, return_index=True, return_inverse=True)
                    later = np.flatnonzero(first[back] != np.arange(len(w)))
                    if len(later):
                        rows.append((at, None, False, place[later], place[first[back[later]]].astype(np.int64)))
                    first = first[np.argsort(a[first], kind="stable")]
                    cuts = np.flatnonzero(np.diff(a[first])) + 1
                    for part in np.split(first, cuts) if len(first) else []:
                        key = int(a[part[0]])
                        rows.append((at, key, hot[key], place[part], w[part]))
                if rows:
                    take = pa.array([r[0] for r in rows])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(take),
                            batch.column("h1").take(take),
                            pa.array([r[1] for r in rows], pa.int64()),
                            pa.array([r[2] for r in rows]),
                            pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                            pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                        ],
                        ["doc_id", "h1", "anchor", "hot", "at", "w"],
                    )

    return texts.mapInArrow(
        run, "doc_id long, h1 long, anchor long, hot boolean, at array<int>, w array<long>"
    )


REPEATS = "doc_id long, h1 long, at array<int>, ref_doc array<long>, ref_at array<int>"


def _sorted_pass(index: DataFrame) -> DataFrame:
    """Windows that also start earlier, with their earliest start, for anchors that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first = None, {}
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "h1", "anchor", "at", "w")]
            for doc, h1, anchor, at, w in zip(*columns, strict=True):
                if anchor != current:
                    current, first = anchor, {}
                hit = []
                for place, key in zip(at, w, strict=True):
                    known = first.setdefault(key, (doc, h1, place))
                    # a repeated row of the same document starts no earlier
                    if known[0] != doc or known[1] != h1:
                        hit.append((place, known[0], known[2]))
                if hit:
                    rows.append((doc, h1, *zip(*hit, strict=True)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "h1", "at", "ref_doc", "ref_at"],
            )

    dealt = index.where("anchor is not null and not hot").repartition("anchor")
    return (
        dealt.sortWithinPartitions("anchor", _order(F.col("doc_id")), "h1")
        .select("doc_id", "h1", "anchor", "at", "w")
        .mapInArrow(run, REPEATS)
    )


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST))


def _hot_pass(index: DataFrame) -> DataFrame:
    """The same for hot anchors: earliest start by aggregate, then joined to every window."""
    each = index.where("anchor is not null and hot").select(
        "doc_id", "h1", "anchor", F.explode(F.arrays_zip("at", "w")).alias("x")
    )
    each = each.select("doc_id", "h1", "anchor", F.col("x.at").alias("place"), F.col("x.w").alias("w"))
    start = F.struct(_order(F.col("doc_id")).alias("o"), "h1", "doc_id", "place")
    first = each.groupBy("anchor", "w").agg(F.min(start).alias("first"), F.count("*").alias("n"))
    first = stage(first.where("n > 1").drop("n"), "hot_windows")
    later = each.join(first, ["anchor", "w"]).where(
        "not (doc_id <=> first.doc_id and h1 = first.h1)"
    )
    return later.select(
        "doc_id",
        "h1",
        F.array("place").alias("at"),
        F.array("first.doc_id").alias("ref_doc"),
        F.array("first.place").alias("ref_at"),
    )


def factors(at: np.ndarray, ref_doc: list, ref_at: np.ndarray) -> list[tuple[int, int, int | None, int]]:
    """Greedy parse of the repeated windows of one text: (start, words, reference, start there)."""
    out: list[list] = []
    for place, doc, there in zip(at.tolist(), ref_doc, ref_at.tolist(), strict=True):
        f = out[-1] if out else None
        last = f and f[0] + f[1] - WINDOW  # start of the factor's last window
        if f and place == last + 1 and doc == f[2] and there == f[3] + place - f[0]:
            f[1] += 1
        else:
            out.append([place, WINDOW, doc, there])
    return [tuple(f) for f in out]


CHANGED = (
    "doc_id long, h1 long, n_removed long, kept_sha256 string, kept string, "
    "factors array<struct<start: int, words: int, ref_doc: long, ref_start: int>>"
)


def _apply(texts: DataFrame, with_text: bool) -> DataFrame:
    """Factors, what they leave of each text, and its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, found = batch.column("doc_id").to_pylist(), batch.column("repeats")
            for block in blocks(batch.column("text")):
                h1 = _whole(block, block.hashes())[0].view(np.int64).tolist()
                data, edges = block.data.tobytes(), block.offsets.tolist()
                for i in range(block.n):
                    at, doc, there = [], [], []
                    for r in found[block.first + i].as_py():
                        if r["h1"] == h1[i]:
                            at += r["at"]
                            doc += r["ref_doc"]
                            there += r["ref_at"]
                    if not at:
                        continue
                    at, once = np.unique(np.array(at), return_index=True)
                    doc = [doc[k] for k in once]
                    parsed = factors(at, doc, np.array(there)[once])
                    words = data[edges[i] : edges[i + 1]].split()
                    keep = np.ones(len(words), bool)
                    for start, size, _, _ in parsed:
                        keep[start : start + size] = False
                    kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
                    rows.append(
                        (
                            ids[block.first + i],
                            h1[i],
                            int((~keep).sum()),
                            hashlib.sha256(kept).hexdigest(),
                            kept.decode() if with_text else None,
                            [dict(zip(("start", "words", "ref_doc", "ref_start"), f, strict=True)) for f in parsed],
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            factor = pa.struct(
                [("start", pa.int32()), ("words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]
            )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(factor)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "h1", "n_removed", "kept_sha256", "kept", "factors"],
            )

    return texts.mapInArrow(run, CHANGED)


def parse(spark: SparkSession, docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept, factors.

    ``kept`` is the text that stays where words were removed, if asked for; else it is null.
    Null texts have no words.  Earlier means a smaller doc_id, null ids last; rows of one id
    and one word sequence are one document and fare alike.  Texts of one id with different
    words are ordered by a hash of them.  An empty table gives no rows.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    narrow = prints.select("doc_id", "n_words", "h1", "h2", "sha")
    same = ["h1", "h2", "n_words"]
    copies = narrow.groupBy(*same).agg(
        F.min(_order(F.col("doc_id"))).alias("first"), F.count("*").alias("n")
    )
    copies = stage(copies.where("n > 1").drop("n"), "copies")
    is_copy = _order(F.col("doc_id")) > F.col("first")
    placed = narrow.join(copies, same, "left").withColumn("copy", F.coalesce(is_copy, F.lit(False)))
    placed = stage(placed, "placed")

    repeated = stage(repeated_anchors(prints), "anchors")
    bits = bitmap(repeated.select(F.col("anchor").bitwiseAND(BITS - 1).alias("slot")))
    found = (
        _only(prints, spark, bits)
        .join(repeated, "anchor")
        .groupBy("doc_id", "h1")
        .agg(F.collect_list(F.struct("anchor", (F.col("n") > HOT).alias("hot"))).alias("found"))
    )
    firsts = placed.where("not copy").select("doc_id", "h1").distinct()
    key = F.expr("f.doc_id <=> l.doc_id and f.h1 = l.h1")
    lists = firsts.alias("f").join(found.alias("l"), key).select("l.*")
    lists = stage(lists, "lists")
    texts = _maybe(docs, spark, lists).alias("d")
    texts = texts.join(lists.alias("l"), F.expr("d.doc_id <=> l.doc_id")).select(
        "d.doc_id", "l.h1", "d.text", "l.found"
    )
    index = stage(_windows(texts), "windows")
    inner = index.where("anchor is null").select(
        "doc_id",
        "h1",
        "at",
        F.expr("transform(at, x -> doc_id)").alias("ref_doc"),
        F.expr("transform(w, x -> int(x))").alias("ref_at"),
    )
    repeats = _sorted_pass(index).unionByName(_hot_pass(index)).unionByName(inner)
    repeats = repeats.groupBy("doc_id").agg(
        F.collect_list(F.struct("h1", "at", "ref_doc", "ref_at")).alias("repeats")
    )
    repeats = stage(repeats, "repeats")
    texts = _maybe(docs, spark, repeats).alias("d")
    texts = texts.join(repeats.alias("r"), F.expr("d.doc_id <=> r.doc_id")).select(
        "d.doc_id", "d.text", "r.repeats"
    )
    changed = stage(_apply(texts, with_text).dropDuplicates(["doc_id", "h1"]), "changed")
    gone = F.col("p.copy") & (F.col("p.n_words") >= WINDOW)
    everything = F.expr(
        "array(struct(0 as start, int(p.n_words) as words, nullif(p.first, {}) as ref_doc, 0 as ref_start))".format(LAST)
    )
    return (
        placed.alias("p")
        .join(changed.alias("c"), F.expr("p.doc_id <=> c.doc_id and p.h1 = c.h1 and not p.copy"), "left")
        .select(
            "p.doc_id",
            "p.n_words",
            F.when(gone, F.col("p.n_words")).otherwise(F.coalesce("c.n_removed", F.lit(0))).alias("n_removed"),
            F.when(gone, F.lit(NOTHING)).otherwise(F.coalesce("c.kept_sha256", "p.sha")).alias("kept_sha256"),
            F.when(gone, F.lit("")).otherwise(F.col("c.kept")).alias("kept"),
            F.when(gone, everything).otherwise(F.col("c.factors")).alias("factors"),
        )
    )


def substring_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return parse(spark, docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
