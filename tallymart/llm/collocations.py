"""Phrase collocations: tries of Apriori-safe candidates, counted level by level.

A phrase can be frequent only if its parts are.  The texts are read twice: once to count words, and
once to write them down as numbers of the frequent ones (by the exact word and language; the most
frequent have the least), with a 0 where a piece ends or a word is not frequent.  All further passes
read these numbers.

The candidates of two words are the pairs seen whose words both are frequent, those of three words the
triples seen whose pairs both may be.  Of these, those whose hash of 32 bits the tasks together
have not seen ``least`` times are left out: a phrase is in its hash's bucket with all its
occurrences, whoever shares it.  A bitmap of 4 MB, of more for more words, says so to the next pass (it may let others
through, never keeps one out).

Counting is the tries' work.  Candidates are dealt by their first word into shards of about ``SHARD`` (a word
that many begin with into several), a task builds the trie of each (word, word, word).  A few tries are
broadcast, ``AT_A_TIME`` to a pass.  With more than ``PASSES`` passes would have, each reading all numbers, one pass deals
the places that may begin a candidate to the tries instead, equal ones of a task once with their number; so
the work grows with the places, not with places times tries.  A task moves the states of all places whose word begins a
phrase of the trie on together, one level at a time, adds up the accepting ones with ``bincount``,
and the counts of all tasks are summed by candidate.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm import filters
from tallymart.llm.names import codes, joined
from tallymart.llm.shared import arrow_batches, stage
from tallymart.llm.tries import build
from tallymart.llm.words import BYTE_BASE, _BYTE_VALUES, Block, blocks, mix, prefix, run_hash

#: Candidates of a trie (some 15 MB of slots and words, a third of it while it travels), and tries of a
#: pass over the texts.
SHARD, AT_A_TIME = 1 << 19, 2
#: Passes over the numbers for which tries are broadcast; and tasks that share the places of a trie otherwise.
PASSES, SHARED = 3, 8
#: Bytes of text that a task reads at a time.
AT_ONCE = 1 << 20
#: Bytes of an Arrow batch, and places whose phrases a task holds before it sums them up.
BATCH, HELD = 1 << 22, 1 << 22
#: Candidates of a trie whose counts one task adds up.
SLICE = 1 << 13
#: Bits of a bitmap at most.
MOST_BITS = 1 << 28
#: Rows of a language that one task sorts; more are first cut down in parts.
RANKED = 1 << 16
NO_LANGUAGE = "und"
_CUTS = np.isin(np.arange(256), [*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D])
_INSIDE = ~_CUTS & ~np.isin(np.arange(256), [0x20, 0x09])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
U = np.uint64
COUNTED = "lang string, phrase string, f long"


def hashes(values: pa.Array) -> np.ndarray:
    """A hash of each string, by its bytes."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8)[: at[-1]] if data else np.zeros(0, np.uint8)
    return run_hash(prefix(_BYTE_VALUES[data], BYTE_BASE), at[:-1], at[1:], BYTE_BASE)


def phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases, from those of their language and words."""
    h = lang
    for w in words:
        h = mix(h * U(0x9E3779B97F4A7C15) + w)
    return mix(h)


def slots(hashed: np.ndarray, bits: int = filters.BITS) -> np.ndarray:
    """Places of hashes in a bitmap."""
    return (hashed % U(bits)).astype(np.int64)


def bits_for(words: int) -> int:
    """Bits of a bitmap for texts of so many words, so that it does not fill up as they grow: phrases that it
    lets through by mistake are candidates.  32 MB at most."""
    bits = filters.BITS
    while bits < MOST_BITS and bits * 4 < words:
        bits *= 2
    return bits


class Places:
    """Words of a block of texts: ``follows`` tells behind which of them the piece goes on."""

    def __init__(self, block: Block, langs: pa.Array):
        self.block = block
        piece = np.cumsum(_CUTS[block.data], dtype=np.int32)[block.starts]
        text = np.repeat(np.arange(block.n), np.diff(block.bounds))
        piece = piece + text * (len(block.data) + 1)
        found = pc.dictionary_encode(langs)
        self.langs = found.dictionary.cast(pa.large_string())
        self.lang = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        self.follows = np.append(piece[1:] == piece[:-1], np.zeros(min(len(text), 1), bool))

    def distinct(self) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Distinct (language, word): which language, the word; which of them each place has, and the number of places of each."""
        found = pc.dictionary_encode(joined(self.block.data, self.block.starts, self.block.ends))
        word = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both = pc.dictionary_encode(pa.array(self.lang * len(found.dictionary) + word))
        place = both.indices.to_numpy(zero_copy_only=False)
        lang, word = np.divmod(both.dictionary.to_numpy(), max(1, len(found.dictionary)))
        words = pc.take(found.dictionary.cast(pa.large_string()), pa.array(word))
        return lang, words, place, np.bincount(place, minlength=len(lang))


def places(batch: pa.RecordBatch) -> Iterator[Places]:
    """The texts of a batch, lower-cased from A to Z, in blocks."""
    text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    lang = batch.column("lang")
    for block in blocks(text, AT_ONCE, _INSIDE):
        block.data = _LOWER[block.data]
        yield Places(block, lang.slice(block.first, block.n))
    pa.default_memory_pool().release_unused()  # idle workers stay, what they held should not


def _batch(columns: list, count: np.ndarray) -> pa.RecordBatch:
    columns = [c.cast(pa.string()) for c in columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int64())], ["lang", "phrase", "f"])


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """lang, phrase, f of words seen ``least`` times or more, and with a null phrase those of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in places(batch):
                if len(p.lang):
                    lang, words, _, count = p.distinct()
                    yield _batch([pc.take(p.langs, pa.array(lang)), words], count)
                    total = np.bincount(p.lang, minlength=len(p.langs))
                    yield _batch([p.langs, pa.nulls(len(p.langs), pa.string())], total)

    found = texts.mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return found.where((F.col("f") >= least) | F.col("phrase").isNull())


class Vocabulary:
    """The frequent words of all languages: word i has number i + 1."""

    def __init__(self, lang: pa.Array, word: pa.Array):
        found = pc.dictionary_encode(lang.cast(pa.large_string()))
        self.langs, self.lang = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
        self.word = word.cast(pa.large_string())
        hashed = phrase_hashes(hashes(self.langs)[self.lang], [hashes(self.word)])
        self.order = np.argsort(hashed, kind="stable").astype(np.int32)
        self.hash = hashed[self.order]

    def numbers(self, langs: pa.Array, lang: np.ndarray, words: pa.Array) -> np.ndarray:
        """Number of each word of a language; 0 for those that are not there.  Hashes lead to them, bytes decide."""
        out = np.zeros(len(words), np.int32)
        hashed = phrase_hashes(hashes(langs)[lang], [hashes(words)])
        mine = pc.fill_null(pc.index_in(langs, value_set=self.langs), -1).to_numpy(zero_copy_only=False)[lang]
        at = np.searchsorted(self.hash, hashed)
        left = np.arange(len(out))
        while True:
            left = left[at[left] < len(self.hash)]
            left = left[self.hash[at[left]] == hashed[left]]
            if not len(left):
                return out
            known = self.order[at[left]]
            same = pc.equal(pc.take(self.word, pa.array(known)), pc.take(words, pa.array(left)))
            same = same.to_numpy(zero_copy_only=False) & (self.lang[known] == mine[left])
            out[left[same]] = known[same] + 1
            left = left[~same]
            at[left] += 1

    def phrases(self, columns: list[np.ndarray]) -> list[pa.Array]:
        """Language and phrase of rows of numbers, 0 behind their end."""
        lang = pc.take(self.langs, pa.array(self.lang[columns[0] - 1]))
        words = [pc.take(self.word, pa.array(c - 1, mask=c == 0)) for c in columns]
        return [lang, pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()), null_handling="skip")]


def vocabulary(words: DataFrame) -> Vocabulary:
    """Of a table of frequent words; the most frequent ones have the least numbers."""
    rows = words.orderBy(F.desc("f"), "lang", "phrase").select("lang", "phrase").toArrow().combine_chunks()
    return Vocabulary(*(pa.concat_arrays([pa.array([], pa.string()), *rows.column(c).chunks]) for c in ("lang", "phrase")))


def numbered(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """numbers: those of a text's words, of 4 bytes each; a 0 stands for whatever parts frequent words, and ends each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in places(batch):
                if not len(p.lang):
                    continue
                lang, words, place, _ = p.distinct()
                number = shared.value.numbers(p.langs, lang, words)[place]
                ends = ~p.follows
                at = np.arange(len(number)) + np.cumsum(ends) - ends
                flat = np.zeros(at[-1] + 2, np.int32)
                flat[at] = number
                keep = flat > 0
                keep[1:] |= flat[:-1] > 0
                edges = np.append(at, len(flat))[p.block.bounds]
                edges = np.unique(np.append(0, np.cumsum(keep))[edges])
                yield pa.RecordBatch.from_arrays([packed(flat[keep], edges)], ["numbers"])

    return texts.mapInArrow(run, "numbers binary")


def packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Parts of an array, one behind the other, as bytes."""
    buffers = [None, pa.py_buffer((edges * values.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, buffers).cast(pa.binary())


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The values of all rows of ``packed``, end to end."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].view(kind) if edges[-1] > edges[0] else np.zeros(0, kind)


def flat_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield unpacked(batch.column("numbers"), np.int32)


def hashed(flat: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of 32 bits of the k words from each place on."""
    words = [flat[at + j].astype(np.uint64) for j in range(k)]
    return phrase_hashes(np.zeros(len(at), np.uint64), words).astype(np.uint32)


def may_be(flat: np.ndarray, at: np.ndarray, bitmap: np.ndarray, k: int) -> np.ndarray:
    """Those of the places from which k words go on that may be frequent."""
    return at[filters.held(bitmap, slots(hashed(flat, at, k).astype(np.uint64), 8 * len(bitmap)))]


def going_on(flat: np.ndarray, often: list[np.ndarray]) -> np.ndarray:
    """Places of phrases that are one word longer than the longest bitmap's, whose parts may be frequent."""
    good = flat > 0
    at = np.flatnonzero(good[:-1] & good[1:])
    for k, bitmap in enumerate(often, 2):
        good = np.zeros(len(flat), bool)
        good[may_be(flat, at, bitmap, k)] = True
        at = np.flatnonzero(good[:-1] & good[1:])
    return at


def parts_of(spark: SparkSession) -> int:
    """Into how many parts hashes are dealt: some to a partition, so that partitions are alike."""
    return min(1 << 16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def seen_often(numbers: DataFrame, often: list[bytes], least: int, bits: int = filters.BITS) -> bytes:
    """Bitmap of ``bits`` of the hashes that phrases on such places have ``least`` times or more.

    A task sends its distinct hashes in parts, by their upper halves; of each it sends the lower half, and how
    many share an upper one.
    """
    spark, k = numbers.sparkSession, len(often) + 2
    shared = spark.sparkContext.broadcast(often)  # of a bounded size
    parts = parts_of(spark)
    begin = (np.arange(parts + 1) << 16) // parts  # upper halves of each part
    kind = np.min_scalar_type(least)

    def summed(found: list[np.ndarray]) -> pa.RecordBatch:
        values, count = np.unique(np.concatenate(found), return_counts=True)
        edges = np.searchsorted(values, begin.astype(np.uint64) << U(16))
        size = np.bincount(values >> 16, minlength=1 << 16).astype(np.uint32)
        columns = [packed(values.astype(np.uint16), edges), packed(size, begin)]
        columns += [packed(np.minimum(count, least).astype(kind), edges)]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(parts), pa.int32()), *columns], ["part", "lower", "size", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b, np.uint8) for b in shared.value]
        found, n = [], 0
        for flat in flat_numbers(batches):
            found.append(hashed(flat, going_on(flat, bitmaps), k))
            n += len(found[-1])
            if n >= HELD:
                yield summed(found)
                found, n = [], 0
        if n:
            yield summed(found)
        pa.default_memory_pool().release_unused()

    def merged(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lower, size, f = (
            unpacked(table.column(c).chunk(0), t) for c, t in (("lower", np.uint16), ("size", np.uint32), ("f", kind))
        )
        part = table.column("part")[0].as_py()
        upper = np.tile(np.arange(begin[part], begin[part + 1]), table.num_rows)
        values, place = np.unique(np.repeat(upper, size) << 16 | lower, return_inverse=True)
        values = values[np.bincount(place, f, len(values)) >= least]
        # the slot of the whole hash, as bits divide 2**32
        return pa.table({"slot": pa.array(slots(values.astype(np.uint64), bits), pa.int64())})

    seen = numbers.mapInArrow(run, "part int, lower binary, size binary, f binary").where(F.length("f") > 0)
    return filters.bitmap(seen.groupBy("part").applyInArrow(merged, "slot long"), bits)


def distinct_rows(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of numbers with each row once."""
    return counted_rows(columns)[0]


def counted_rows(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of numbers with each row once, and how often it was there."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if int(key.max(initial=0)) + 1 > (1 << 62) // width:
            key = codes(pa.array(key))
        key = key * width + c
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], count


PHRASE = ("a", "b", "c")


def candidates(numbers: DataFrame, often: list[bytes]) -> DataFrame:
    """a, b, c (0 where there are two words): the phrases that the last of the bitmaps and their parts allow."""
    spark, k = numbers.sparkSession, len(often) + 1
    shared = spark.sparkContext.broadcast(often)
    parts, names = parts_of(spark), PHRASE[: len(often) + 1]

    def batch(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = distinct_rows([np.concatenate(c) for c in zip(*found, strict=True)])
        words = [c.astype(np.uint64) for c in columns]
        part = phrase_hashes(np.zeros(len(columns[0]), np.uint64), words) % U(parts)
        order = np.argsort(part.astype(np.uint16), kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
        columns = [packed(c[order], edges) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(parts), pa.int32()), *columns], ["part", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b, np.uint8) for b in shared.value]
        found, n = [], 0
        for flat in flat_numbers(batches):
            at = may_be(flat, going_on(flat, bitmaps[:-1]), bitmaps[-1], k)
            found.append([flat[at + j] for j in range(k)])
            n += len(at)
            if n >= HELD // 2:
                yield batch(found)
                found, n = [], 0
        if n:
            yield batch(found)
        pa.default_memory_pool().release_unused()

    def merged(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = distinct_rows([unpacked(table.column(c).chunk(0), np.int32) for c in names])
        columns += [np.zeros(len(columns[0]), np.int32)] * (len(PHRASE) - k)
        return pa.table(dict(zip(PHRASE, map(pa.array, columns), strict=True)))

    seen = numbers.mapInArrow(run, "part int, " + ", ".join(f"{c} binary" for c in names)).where(F.length("a") > 0)
    return seen.groupBy("part").applyInArrow(merged, "a int, b int, c int")


class Counter:
    """The trie of some candidates, with what it takes to read numbers by it."""

    def __init__(self, rows: np.ndarray):
        self.depth = rows.shape[1]
        word, place, often = np.unique(rows, return_inverse=True, return_counts=True)
        often[word == 0] = len(rows) * rows.shape[1] + 1  # keeps symbol 0, which leads nowhere
        # common words have low symbols, so that tries are dense
        symbol = np.empty(len(word), np.int64)
        low = 0 if len(word) and word[0] == 0 else 1
        symbol[np.argsort(-often, kind="stable")] = np.arange(low, len(word) + low)
        self.word, self.symbol = word, symbol
        self.trie, slot = build(symbol[place].reshape(rows.shape))
        self.slot = slot.astype(np.int32)  # of each candidate

    def start(self, words: int) -> None:
        """Makes ready for counting texts of numbers up to ``words``: in the task that counts, as it need not travel."""
        self.symbol_of = np.zeros(words + 1, np.int32)  # 0 stands for other words
        self.symbol_of[self.word] = self.symbol
        self.first = np.maximum(self.trie.step(np.zeros(words + 1, np.int64), self.symbol_of), 0).astype(np.int32)
        self.total = np.zeros(len(self.trie.check), np.int64)

    def add(self, flat: np.ndarray) -> None:
        """Counts the accepting states of all places."""
        state = self.first[flat]
        at = np.flatnonzero(state)
        state = state[at]
        for level in range(1, self.depth):
            # behind the last number there is a 0, from which no state goes on
            state = self.trie.step(state, self.symbol_of[flat[at + level]])
            on = state > 0
            at, state = at[on], state[on]
            self.total += np.bincount(state, minlength=len(self.total))

    def add_rows(self, columns: list[np.ndarray], times: np.ndarray) -> None:
        """Counts the accepting states of places given as rows of words (0 behind their end), each so many times."""
        state = self.first[columns[0]]
        at = np.flatnonzero(state)
        state = state[at]
        for level in range(1, self.depth):
            state = self.trie.step(state, self.symbol_of[columns[level][at]])
            on = state > 0
            at, state = at[on], state[on]
            # sums of a row's numbers stay below 2**53
            self.total += np.bincount(state, times[at], minlength=len(self.total)).astype(np.int64)

    def counts(self, shard: int) -> pa.RecordBatch:
        """Of each slice with candidates that were seen their numbers, and how often, in bytes of some width."""
        seen = self.total[self.slot]
        at = np.flatnonzero(seen)
        slices = -(-len(seen) // SLICE)
        edges = np.searchsorted(at, np.arange(slices + 1) * SLICE)
        f = seen[at].astype(np.min_scalar_type(int(seen.max(initial=0))))
        columns = [pa.array(np.full(slices, c), pa.int32()) for c in (shard, f.itemsize)]
        columns += [pa.array(np.arange(slices), pa.int32()), packed((at % SLICE).astype(np.uint16), edges), packed(f, edges)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "width", "slice", "number", "f"])


Many = tuple[np.ndarray, np.ndarray]


def begun_often(phrases: DataFrame, shard: int) -> Many:
    """First words of more than a quarter of a shard, ascending, and into how many pieces their phrases are dealt: no
    more than four words a shard."""
    pieces = F.ceil(F.count("*") * 4 / shard).alias("pieces")
    rows = sorted(phrases.groupBy("a").agg(pieces).where("pieces > 1").collect())
    return np.array([r.a for r in rows], np.int32), np.array([r.pieces for r in rows], np.uint64)


def shards_of(a: np.ndarray, b: np.ndarray, many: Many, shards: int) -> np.ndarray:
    """Shards of phrases by their first word, and by the second too where many phrases begin with the first."""
    words, pieces = many
    of = np.ones(len(a), np.uint64)
    if len(words):
        at = np.minimum(np.searchsorted(words, a), len(words) - 1)
        of = np.where(words[at] == a, pieces[at], U(1))
    none = np.zeros(len(a), np.uint64)
    piece = phrase_hashes(none, [b.astype(np.uint64)]) % of
    return (phrase_hashes(none, [a.astype(np.uint64), piece]) % U(shards)).astype(np.int32)


def tries_of(phrases: DataFrame, shards: int, shard: int, many: Many | None = None) -> DataFrame:
    """shard, slice, rows, counter: a table of phrases, dealt into shards of about ``shard`` by their first words, in
    slices, as numbers end to end; the first row of a shard also has its packed trie."""
    many = begun_often(phrases, shard) if many is None else many

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = shards_of(batch.column("a").to_numpy(), batch.column("b").to_numpy(), many, shards)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of)], [*PHRASE, "shard"])

    def run(part: pa.Table) -> pa.Table:
        rows = np.stack([part.column(c).to_numpy() for c in PHRASE], axis=1)
        counter = zlib.compress(pickle.dumps(Counter(rows)), 1)
        slices = -(-len(rows) // SLICE)
        edges = np.minimum(np.arange(slices + 1) * SLICE, len(rows)) * len(PHRASE)
        columns = {"shard": pa.array([part.column("shard")[0].as_py()] * slices, pa.int32())}
        columns |= {"slice": pa.array(np.arange(slices), pa.int32()), "rows": packed(rows.ravel(), edges)}
        return pa.table(columns | {"counter": pa.array([counter] + [None] * (slices - 1), pa.binary())})

    rows = phrases.select(*PHRASE).mapInArrow(deal, "a int, b int, c int, shard int")
    return rows.groupBy("shard").applyInArrow(run, "shard int, slice int, rows binary, counter binary")


def _slice_counts(table: pa.Table) -> pa.Table:
    """a, b, c, f of the candidates of a slice: one row has them, the others what the tasks have seen."""
    table = table.select(["rows", "width", "number", "f"])
    rows = next(np.frombuffer(r, np.int32).reshape(-1, len(PHRASE)) for r in table.column("rows").to_pylist() if r)
    total = np.zeros(len(rows), np.int64)
    for width, number, f in zip(*(table.column(c) for c in ("width", "number", "f")), strict=True):
        if number.is_valid:
            total[np.frombuffer(number.as_buffer(), np.uint16)] += np.frombuffer(f.as_buffer(), f"u{width}").astype(np.int64)
    at = np.flatnonzero(total)
    columns = dict(zip(PHRASE, map(pa.array, np.ascontiguousarray(rows[at].T)), strict=True))
    return pa.table(columns | {"f": pa.array(total[at])})


def dealt(numbers: DataFrame, often: list[bytes], shards: int, many: Many) -> DataFrame:
    """shard, sub, a, b, c, times: the places that may begin a candidate, by the trie that its phrases are in, as
    arrays; equal places of a task once.  c is 0 where only two words go on."""
    shared, names = numbers.sparkSession.sparkContext.broadcast(often), PHRASE

    def batch(found: list[list[np.ndarray]], sub: int) -> pa.RecordBatch:
        columns, times = counted_rows([np.concatenate(c) for c in zip(*found, strict=True)])
        of = shards_of(columns[0], columns[1], many, shards)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(shards + 1))
        columns = [packed(c[order], edges) for c in (*columns, times.astype(np.uint32))]
        keys = [pa.array(np.arange(shards), pa.int32()), pa.array(np.full(shards, sub), pa.int32())]
        return pa.RecordBatch.from_arrays([*keys, *columns], ["shard", "sub", *names, "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, triples = (np.frombuffer(b, np.uint8) for b in shared.value)
        found, n, sub = [], 0, TaskContext.get().partitionId()
        for flat in flat_numbers(batches):
            at = may_be(flat, going_on(flat, []), pairs, 2)
            third = np.zeros(len(flat), np.int32)
            longer = may_be(flat, going_on(flat, [pairs]), triples, 3)
            third[longer] = flat[longer + 2]
            found.append([flat[at], flat[at + 1], third[at]])
            n += len(at)
            if n >= HELD // 2:
                yield batch(found, sub % SHARED)
                found, n, sub = [], 0, sub + 1
        if n:
            yield batch(found, sub % SHARED)
        pa.default_memory_pool().release_unused()

    kinds = ", ".join(f"{c} binary" for c in (*names, "times"))
    return numbers.mapInArrow(run, f"shard int, sub int, {kinds}").where(F.length("times") > 0)


SEEN = "shard int, width int, slice int, number binary, f binary"


def counts_of_dealt(places: DataFrame, tries: DataFrame, words: int) -> DataFrame:
    """What each of the tasks that share a trie has seen at its places; a trie comes to them before its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, counter = -1, None
        for batch in batches:
            packs = [batch.column(c) for c in (*PHRASE, "times")]
            for i in range(batch.num_rows):
                trie = batch.column("counter")[i]
                if trie.is_valid:
                    if counter is not None:
                        yield counter.counts(shard)
                    shard, counter = batch.column("shard")[i].as_py(), pickle.loads(zlib.decompress(trie.as_buffer()))
                    counter.start(words)
                else:
                    *columns, times = (np.frombuffer(p[i].as_buffer(), np.uint32) for p in packs)
                    counter.add_rows(columns, times)
        if counter is not None:
            yield counter.counts(shard)
        pa.default_memory_pool().release_unused()

    each = F.explode(F.sequence(F.lit(0), F.lit(SHARED - 1)))
    tries = tries.where(F.col("counter").isNotNull()).select("shard", each.alias("sub"), "counter")
    both = places.unionByName(tries, allowMissingColumns=True).repartition("shard", "sub")
    both = both.sortWithinPartitions("shard", "sub", F.col("counter").isNull())
    return both.mapInArrow(run, SEEN)


def trie_counts(
    numbers: DataFrame, phrases: DataFrame, words: int, often: list[bytes], shard: int = SHARD
) -> DataFrame:
    """a, b, c, f of those of ``phrases`` (a staged table) that are seen, by tries of about ``shard`` of them; places
    without a bit in the bitmaps of pairs and of triples have none."""
    spark = numbers.sparkSession
    shards, many = max(-(-phrases.count() // shard), 1), begun_often(phrases, shard)
    tries = stage(tries_of(phrases, shards, shard, many), "tries")
    sliced = tries.select("shard", "slice", "rows")

    def summed(seen: DataFrame, of: DataFrame) -> DataFrame:
        both = seen.where(F.length("f") > 0).unionByName(of, allowMissingColumns=True)
        both = both.groupBy("shard", "slice").applyInArrow(_slice_counts, "a int, b int, c int, f long")
        return stage(both, "counts")

    if shards > PASSES * AT_A_TIME:
        return summed(counts_of_dealt(dealt(numbers, often, shards, many), tries, words), sliced)
    parts: list[DataFrame] = []
    for first in range(0, shards, AT_A_TIME):
        few = F.col("shard").between(first, first + AT_A_TIME - 1)
        mine = tries.where(few).where(F.col("counter").isNotNull()).select("shard", "counter").collect()
        shared = spark.sparkContext.broadcast([(r.shard, bytes(r.counter)) for r in mine])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counters = [(i, pickle.loads(zlib.decompress(c))) for i, c in shared.value]
            for _, counter in counters:
                counter.start(words)
            for flat in flat_numbers(batches):
                for _, counter in counters:
                    counter.add(flat)
            for i, counter in counters:
                yield counter.counts(i)
            pa.default_memory_pool().release_unused()

        parts.append(summed(numbers.mapInArrow(run, SEEN), sliced.where(few)))
        shared.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def worded(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """lang, phrase, f of rows of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = shared.value.phrases([batch.column(c).to_numpy() for c in PHRASE])
            yield _batch(columns, batch.column("f").to_numpy())

    return rows.mapInArrow(run, COUNTED)


def looked_up(rows: DataFrame, counts: DataFrame, key: str, name: str, words: int) -> DataFrame:
    """``rows`` with the count of the phrase in column ``key``, as ``name``.

    Phrases with a thousandth of all words or more may be part of very many rows; there are at most
    3,000 of them (a thousand of each length), so they are broadcast.  Others are part
    of few rows: each of those takes ten occurrences.
    """
    often = F.col("f") * 1000 >= words
    counts = counts.select("lang", F.col("phrase").alias(key), "f")
    on = ["lang", key]
    hot = counts.where(often).withColumnRenamed("f", "hot")
    rows = rows.join(F.broadcast(hot), on, "left")
    rest = rows.where(F.col("hot").isNull()).drop("hot").join(counts.where(~often), on).withColumnRenamed("f", name)
    return rows.where(F.col("hot").isNotNull()).withColumnRenamed("hot", name).unionByName(rest)


def scored(counts: DataFrame, words: int) -> DataFrame:
    """lang, phrase, k (words), a, l, r, score of each phrase of two and three words: its worst cut."""
    split = F.split("phrase", " ")
    size = F.size(split)
    cut = F.explode(F.sequence(F.lit(1), size - 1))
    rows = counts.withColumnRenamed("f", "a").withColumn("k", size).where("k > 1").withColumn("cut", cut)
    rows = rows.withColumn("first", F.array_join(F.slice(split, F.lit(1), F.col("cut")), " "))
    rows = rows.withColumn("rest", F.array_join(F.slice(split, F.col("cut") + 1, F.col("k") - F.col("cut")), " "))
    rows = looked_up(rows, counts, "first", "l", words)
    rows = stage(looked_up(rows, counts, "rest", "r", words), "cuts")
    # 14 digits hold the counts of any corpus, 38 the products of two with a million
    exact = {c: F.col(c).cast("decimal(14,0)") for c in "alr"}
    above = F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"])
    rows = rows.withColumn("above", above).withColumn("below", exact["l"] * exact["r"])
    rows = rows.withColumn("score", F.expr("above div below"))
    worst = F.min(F.struct("score", "cut", "l", "r")).alias("worst")
    return rows.groupBy("lang", "phrase", "k", "a").agg(worst).select("lang", "phrase", "k", "a", "worst.*").drop("cut")


def not_inside(rows: DataFrame) -> DataFrame:
    """Rows but pairs that lie in a triple at least half as frequent."""
    split = F.split("phrase", " ")
    pairs = F.explode(F.array(*[F.array_join(F.slice(split, i, 2), " ") for i in (1, 2)]))
    longer = rows.where("k = 3").select("lang", pairs.alias("phrase"), F.col("a").alias("most"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = rows.where("k = 2").join(longer, ["lang", "phrase"], "left").where("most is null or 100 * most < 50 * a")
    return kept.drop("most").unionByName(rows.where("k = 3"))


def best(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each language, with their rank; no task sorts more than some
    ``RANKED`` rows of it: parts are cut down on their own first, again if there are many."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = -(-rows.count() // RANKED)
    while parts > 1:
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        rows = rows.withColumn("part", part).withColumn("place", place).where(F.col("place") <= limit)
        rows = stage(rows.drop("part", "place"), "ranked")
        parts = min(parts // 2, -(-parts * limit // RANKED))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return rows.withColumn("rank", place).where(F.col("rank") <= limit)


def collocations(
    spark: SparkSession, docs: DataFrame, least: int = 10, limit: int = 2000, shard: int = SHARD
) -> DataFrame:
    """Per language (null: ``und``) its best phrases of two and three words.

    Columns: lang, rank from 1, phrase, a (its count), l and r (those of the two parts of its worst cut),
    n (words of the language), score.  A null or empty text has no words; a language without
    frequent phrases has no rows, an empty table none at all.  Repeated rows count as often as they are there.
    Equal scores go by count, then by the phrase's bytes, so ranks are the same at
    every parallelism.  Only text and lang of ``docs`` are read.
    """
    with arrow_batches(spark, BATCH):
        rows, totals = _scored(spark, docs, least, shard)
    # one row a language: no more than 2,000 of a language's rows are left to meet it
    out = best(rows, limit).join(totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(spark: SparkSession, docs: DataFrame, least: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """The scored phrases, and the words of each language; all in staged frames."""
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    words = stage(word_counts(texts, least), "words")
    totals = words.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    words = words.where(F.col("phrase").isNotNull())
    known = vocabulary(words)
    size, shared = len(known.word), spark.sparkContext.broadcast(known)  # one vocabulary
    numbers = stage(numbered(texts, shared), "numbers", codec="zstd")
    everything = totals.agg(F.sum("n")).first()[0] or 0
    often: list[bytes] = []
    phrases = []
    for name in ("pairs", "triples"):
        often.append(seen_often(numbers, often, least, bits_for(everything)))
        phrases.append(stage(candidates(numbers, often), name))
    counted = trie_counts(numbers, phrases[0].unionByName(phrases[1]), size, often, shard).where(F.col("f") >= least)
    counted = stage(worded(counted, shared), "phrases")
    return stage(not_inside(scored(words.unionByName(counted), everything)), "scored"), totals
