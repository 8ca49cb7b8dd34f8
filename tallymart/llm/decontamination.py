"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every
passage of every document by block-max WAND.

A passage is 2 S tokens, a new one begins every S tokens, S being ``PASSAGE`` or the
longest item, so each item's length of text lies whole in some passage.  Weights of an item
are BM25 impacts divided by their sum: a passage's score is the share of the item's weight
that its distinct tokens carry.  Passages that cannot reach the threshold are left by their
sum of term maxima, then per block of items by the sum of block maxima, for many passages
at a time; the others walk their posting lists with pivots and skip by block.  What is
retrieved counts only if trigrams of both the item's question and its answer occur in the
passage.  The answer is the last sentence of an item, or its last third if it has one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import stage
from tallymart.llm.words import TOKEN_BYTES, Block, blocks, shingles

PASSAGE, BLOCK_ITEMS = 64, 4
K1, B = 1.2, 0.75
#: Least score, and least share of an item's question and answer trigrams.
THRESHOLD, OVERLAP = 0.5, 0.5
#: Items of one index; a larger benchmark is queried index by index.  What a score rests on (number of
#: items, their mean length, document frequencies, length of a passage) is that of all of them.
INDEX_ITEMS = 10_000
_SENTENCE_END = re.compile(r"[.!?…。][\s\"')\]]*\s|\n")


def parts(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    text = text.strip()
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if ends:
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = max(1, len(words) * 2 // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def tokenised(column: pa.Array) -> Iterator[Block]:
    """Blocks of lower-cased texts cut into tokens of letters and digits."""
    return blocks(pc.utf8_lower(pc.fill_null(column, "")), solid_bytes=TOKEN_BYTES)


def hashed(texts: list[str]) -> list[np.ndarray]:
    out = []
    for block in tokenised(pa.array(texts, pa.string())):
        h = block.hashes()
        out += [h[a:b] for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True)]
    return out


def grams(h: np.ndarray) -> np.ndarray:
    """Distinct trigrams, or distinct tokens where there are fewer than three."""
    return np.unique(shingles(h, 3) if len(h) >= 3 else h)


@dataclass
class Index:
    """Posting lists by term; items are numbered in the order of their ids."""

    ids: list
    terms: np.ndarray  # sorted hashes
    postings: list[dict[int, tuple[list[int], list[float]]]]  # of each block: by term
    most: np.ndarray  # of each term
    edges: np.ndarray  # blocks of term i, and its most in each of them: edges[i]:edges[i + 1]
    block_of: np.ndarray
    block_most: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    step: int
    present: np.ndarray = field(default_factory=lambda: np.zeros(1 << 20, bool))


@dataclass
class Statistics:
    """What BM25 needs to know of all items, whichever of them an index holds."""

    items: int  # with a token
    words: int
    longest: int
    df: dict[int, int]  # items with a term

    @property
    def step(self) -> int:
        return max(PASSAGE, self.longest)


def statistics(tokens: list[np.ndarray]) -> Statistics:
    tokens = [h for h in tokens if len(h)]
    df = dict(zip(*(x.tolist() for x in np.unique(np.concatenate([np.unique(h) for h in tokens]), return_counts=True)), strict=True)) if tokens else {}
    return Statistics(len(tokens), sum(map(len, tokens)), max(map(len, tokens), default=0), df)


def build(items: list[tuple[object, str]], known: Statistics | None = None) -> Index | None:
    """None where no item has a token.  ``known`` is what all items say; by default these are all."""
    items = sorted((i for i in items if i[1]), key=lambda x: (str(type(x[0])), x[0]))
    tokens = hashed([t for _, t in items])
    rows = [(i, t, h) for (i, t), h in zip(items, tokens, strict=True) if len(h)]
    if not rows:
        return None
    known = known or statistics(tokens)
    mean = known.words / known.items
    by_term: dict[int, list[tuple[int, float]]] = {}
    for n, (_, _, h) in enumerate(rows):
        terms, tf = np.unique(h, return_counts=True)
        length = K1 * (1 - B + B * len(h) / mean)
        df = np.array([known.df[t] for t in terms.tolist()])
        impact = np.log(1 + (known.items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + length)
        impact /= impact.sum()
        for t, x in zip(terms.tolist(), impact.tolist(), strict=True):
            by_term.setdefault(t, []).append((n, x))
    order = sorted(by_term)
    postings: list[dict[int, tuple[list[int], list[float]]]] = [{} for _ in range(-(-len(rows) // BLOCK_ITEMS))]
    edges, block_of, block_most = [0], [], []
    for k, t in enumerate(order):
        for n, x in by_term[t]:
            b = n // BLOCK_ITEMS
            if k not in postings[b]:
                postings[b][k] = [], []
                block_of.append(b)
                block_most.append(0.0)
            items_of, impacts = postings[b][k]
            items_of.append(n)
            impacts.append(x)
            block_most[-1] = max(block_most[-1], x)
        edges.append(len(block_of))
    split = [parts(t) for _, t, _ in rows]
    most = np.array(block_most)
    index = Index(
        [i for i, _, _ in rows],
        np.array(order, np.uint64),
        postings,
        np.maximum.reduceat(most, edges[:-1]),
        np.array(edges),
        np.array(block_of),
        most,
        [grams(h) for h in hashed([q for q, _ in split])],
        [grams(h) for h in hashed([a for _, a in split])],
        known.step,
    )
    index.present[index.terms & np.uint64((1 << 20) - 1)] = True
    return index


def wand(postings: dict, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items of a block whose score for the distinct ``terms`` reaches the threshold.

    Lists are kept in the order of their current item; the first position at which their
    maxima add up to the threshold is the pivot, and no item before it can reach it.
    """
    lists = [[items, impacts, max(impacts), 0] for t in terms if t in postings for items, impacts in [postings[t]]]
    found = []
    while lists:
        lists.sort(key=lambda x: x[0][x[3]])
        bound, pivot = 0.0, None
        for x in lists:
            bound += x[2]
            if bound >= threshold - 1e-6:
                pivot = x[0][x[3]]
                break
        if pivot is None:
            break
        score = 0.0
        whole = lists[0][0][lists[0][3]] == pivot
        for x in lists:
            item = x[0][x[3]]
            if item > pivot:
                break
            if whole:
                score += x[1][x[3]]
                x[3] += 1
            else:
                while x[3] < len(x[0]) and x[0][x[3]] < pivot:
                    x[3] += 1
        if whole and score >= threshold:
            found.append((pivot, score))
        lists = [x for x in lists if x[3] < len(x[0])]
    return found


def matches(index: Index, block: Block, threshold: float = THRESHOLD) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share) of each verified item in a text."""
    h = block.hashes()
    low = index.present[h & np.uint64((1 << 20) - 1)]
    at = np.flatnonzero(low)
    term = np.searchsorted(index.terms, h[at])
    term[term == len(index.terms)] = 0
    real = index.terms[term] == h[at]
    at, term = at[real], term[real]
    if not len(at):
        return []
    text = np.searchsorted(block.bounds, at, side="right") - 1
    place = (at - block.bounds[text]) // index.step  # of the text's stretches of S tokens
    stretches = np.maximum(-(-np.diff(block.bounds) // index.step), 1)
    first = np.concatenate([[0], np.cumsum(stretches)])
    stretch = first[text] + place
    # a term counts in the passage [stretch, stretch + 1] where it comes first
    order = np.lexsort((at, term, text))
    before = np.full(len(at), -1)
    t, x = term[order], text[order]
    follows = np.flatnonzero((t[1:] == t[:-1]) & (x[1:] == x[:-1])) + 1
    before[order[follows]] = stretch[order[follows - 1]]
    own = before < stretch
    earlier = (before < stretch - 1) & (place > 0)
    passage = np.concatenate([stretch[own], stretch[earlier] - 1])
    terms = np.concatenate([term[own], term[earlier]])
    bound = np.bincount(passage, index.most[terms], minlength=first[-1])
    good = bound[passage] >= threshold - 1e-6
    passage, terms = passage[good], terms[good]
    order = np.argsort(passage, kind="stable")
    passage, terms = passage[order], terms[order]
    begin = np.flatnonzero(np.diff(passage, prepend=-1))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    edges = np.append(begin, len(passage))
    for i in range(0, len(begin), 512):
        a, b = edges[i], edges[min(i + 512, len(begin))]
        # per passage the sum of its terms' maxima in each block that has any of them
        mine, row = terms[a:b], np.repeat(np.arange(len(begin[i : i + 512])), np.diff([*begin[i : i + 512], b]))
        sizes = index.edges[mine + 1] - index.edges[mine]
        at = np.repeat(index.edges[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        n, width = len(begin[i : i + 512]), len(index.postings)
        place = np.repeat(row, sizes) * width + index.block_of[at]
        sums = np.bincount(place, index.block_most[at], minlength=n * width).reshape(n, width)
        hopeful = sums >= threshold - 1e-5
        for k in np.flatnonzero(hopeful.any(axis=1)):
            p = int(passage[begin[i + k]])
            mine = terms[edges[i + k] : edges[i + k + 1]].tolist()
            found = [x for b in np.flatnonzero(hopeful[k]) for x in wand(index.postings[b], mine, threshold)]
            if not found:
                continue
            doc = int(np.searchsorted(first, p, side="right")) - 1
            from_ = int(block.bounds[doc]) + (p - int(first[doc])) * index.step
            words = h[from_ : min(from_ + 2 * index.step, int(block.bounds[doc + 1]))]
            held = {3: np.unique(shingles(words, 3)), 1: np.unique(words)}
            for item, score in found:
                q, r = (share(g, held) for g in (index.questions[item], index.answers[item]))
                if q >= OVERLAP and r >= OVERLAP:
                    key = doc, item
                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, q, r))
    return [(doc, item, *x) for (doc, item), x in sorted(best.items())]


def share(wanted: np.ndarray, held: dict[int, np.ndarray]) -> float:
    """Part of the grams that is held; 1 where there are none."""
    if not len(wanted):
        return 1.0
    both = max(np.isin(wanted, held[3]).mean(), np.isin(wanted, held[1]).mean())
    return float(both)


def indexes(benchmark: DataFrame, item_id: str = "item_id") -> Iterator[Index]:
    """Indexes of about ``INDEX_ITEMS`` items each, over all items, with the statistics of all items.

    These are counted in the tasks; of the document frequencies each index gets those of its terms.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), "text").where(F.col("text").isNotNull())
    items = items.dropDuplicates()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """term, words and shard of each distinct term of each item; one row without a term has its length."""
        for batch in batches:
            for block in tokenised(batch.column("text")):
                h, n = block.hashes().view(np.int64), np.diff(block.bounds)
                text = np.repeat(np.arange(block.n), n)
                pairs = np.unique(np.stack([text, h]), axis=1) if len(h) else np.zeros((2, 0), np.int64)
                shard = batch.column("shard").slice(block.first, block.n).to_numpy()
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(pairs[1]), pa.nulls(len(some), pa.int64())]),
                        pa.array(np.concatenate([np.zeros(pairs.shape[1], np.int64), n[some]])),
                        pa.array(np.concatenate([shard[pairs[0]], shard[some]])),
                    ],
                    ["term", "words", "shard"],
                )

    shards = max(1, -(-items.count() // INDEX_ITEMS))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    rows = stage(items.mapInArrow(count, "term long, words long, shard int"), "terms")
    whole = rows.where(F.col("term").isNull()).agg(F.count("*"), F.sum("words"), F.max("words")).first()
    df = rows.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))
    for k in range(shards):
        terms = rows.where((F.col("shard") == k) & F.col("term").isNotNull()).select("term").distinct()
        known = terms.join(df, "term").collect()  # of at most INDEX_ITEMS items
        mine = items.where(F.col("shard") == k).collect()
        frequencies = {r.term % 2**64: r.df for r in known}
        index = build([(r.item_id, r.text) for r in mine], Statistics(*whole, frequencies) if whole[0] else None)
        if index:
            yield index


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share: one row for each benchmark item
    found in a row of ``docs``.

    Null or empty texts and items match nothing, nor does an empty benchmark.  Items of equal
    text are found together; repeated rows of ``docs`` are found each; ids may be null.  Texts of any
    length are read whole.  Scores do not depend on how many items one index holds.
    """
    fields = "doc_id long, item_id long, score double, question_share double, answer_share double"
    out = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)  # at most INDEX_ITEMS items

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, rows = batch.column("doc_id"), []
                for block in tokenised(batch.column("text")):
                    rows += [(block.first + d, index.ids[i], *x) for d, i, *x in matches(index, block)]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(columns[0], pa.int64())),
                        pa.array(columns[1], pa.int64()),
                        *(pa.array(c, pa.float64()) for c in columns[2:]),
                    ],
                    ["doc_id", "item_id", "score", "question_share", "answer_share"],
                )

        found = docs.select("doc_id", "text").mapInArrow(search, fields)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], fields)


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found, with their columns as they were.

    Null and empty texts stay, repeated rows go or stay together, an empty table stays one.
    """
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for block in tokenised(batch.column(at)):
                    keep[[block.first + x[0] for x in matches(index, block)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
