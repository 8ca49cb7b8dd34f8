"""Byte-level BPE: overlapping chunks are pre-tokenised apart, stitched where their
boundaries agree, and the pieces between the cuts are encoded; decoding joins raw bytes.

A text of up to ``CHUNK`` characters is one chunk and never leaves its task.  A longer one
is cut into chunks that overlap by ``OVERLAP`` on either side.  The pattern looks ahead but
never back, so from a boundary that two neighbours share both go on alike: the first such
boundary in their overlap is the cut.  A boundary behind white space is none: how such a
run divides depends on what follows it, which the piece before the cut does not see.  A text with an overlap that has none (one run of
letters, say) is encoded whole.  Any text gives the ids that one pass over it would give.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import stage

CHUNK, OVERLAP = 1 << 15, 1 << 10
#: Pre-tokens whose ids a process remembers (some 10 MB), and as many that it knew before; of these it keeps
#: the ones it meets again.
REMEMBERED = 50_000
#: Bytes of a pre-token up to which its pairs are looked through for each merge.
SHORT = 24
#: Characters of text after which a task hands on what it has.
HANDED_ON = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file of a public tokenizer: a token in base 64 and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


#: Characters that only ``regex`` is asked about; the others' classes are spelled out for ``re``.
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_PART = re.compile(r"\\[pP]\{\w+\}|\\.|\[\^?|\(\?[:=!]|.", re.DOTALL)


@cache
def _spelled_out(escape: str) -> str:
    """The characters up to U+FFFF that an escape of ``regex`` matches, as ranges."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    spans = [m.span() for m in regex.finditer(f"(?:{escape})+", every)]
    return "".join(f"\\u{ord(every[a]):04x}-\\u{ord(every[b - 1]):04x}" for a, b in spans)


@cache
def spelled_out(pattern: str) -> re.Pattern | None:
    """A pattern for ``re``, twice as fast, that finds what ``regex`` does in texts without characters
    beyond U+FFFF; None where it holds more than plain classes, groups, choices and repeats."""
    out, inside = [], False
    for part in _PART.findall(pattern):
        if part[0] == "\\":
            if part[1] not in "sSpP":
                return None
            part = _spelled_out(part) if inside else f"[{_spelled_out(part)}]"
        elif part in "{}" or (inside and part[0] in "[&-~|") or (part == "?" and out[-1:] == ["("]):
            return None
        elif inside and part == "]" and out[-1][0] == "[":
            return None
        elif part[0] == "[" or part == "]":
            inside = part != "]"
        out.append(part)
    return re.compile("".join(out))


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.plain = spelled_out(pattern)
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.known: dict[str, str] = {}  # ids of pre-tokens
        self.before: dict[str, str] = {}
        self.other: dict[str, bytes] = {}  # what ids decode to, where it is not the pre-token

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the adjacent pair of lowest rank, leftmost first, merges."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        return self._merge_short(piece) if len(piece) <= SHORT else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        """Looks through all pairs for each merge."""
        rank_of, none = self.ranks.get, len(self.ranks) + 256
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank_of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = rank_of(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + parts[i], none)
        return [self.ranks[part] for part in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """Keeps the pairs in a heap, as a long piece has many."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))
        heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            if not alive[j]:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                rank = ranks.get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if i > 0:
                p = before[i]
                rank = ranks.get(piece[p:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def matcher(self, text: str) -> re.Pattern | regex.Pattern:
        return self.pattern if self.plain is None or _BEYOND.search(text) else self.plain

    def encode(self, text: str) -> str:
        """Decimal ids joined by one space."""
        return self.both(text)[0]

    def both(self, text: str) -> tuple[str, bytes]:
        """Decimal ids joined by one space, and the bytes that these ids stand for."""
        known, pieces = self.known, self.matcher(text).findall(text)
        out = list(map(known.get, pieces))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    out[i] = self.learn(pieces[i])
        joined = " ".join(out)
        if self.other:
            decoded = b"".join([self.other[p] if p in self.other else p.encode() for p in pieces])
            self.other = {p: raw for p, raw in self.other.items() if p in self.known or p in self.before}
            return joined, decoded
        return joined, "".join(pieces).encode()

    def learn(self, piece: str) -> str:
        """Ids of a pre-token that is not among those at hand; they are decoded here, once."""
        found = self.known.get(piece)
        if found is None:
            found = self.before.get(piece)
            if found is None:
                raw, ids = piece.encode(), self.merge(piece.encode())
                decoded = self.decode(ids)
                if decoded != raw:
                    self.other[piece] = decoded
                found = " ".join(map(str, ids))
            if len(piece) < 64:
                if len(self.known) >= REMEMBERED:
                    self.before = dict(self.known)
                    self.known.clear()
                self.known[piece] = found
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.matcher(text).finditer(text)]


#: The encoder of this Python process, by the digest of its ranks and pattern: what it remembers
#: serves all tasks that the process runs.
_encoders: dict[str, Encoder] = {}


def _encoder(digest: str, ranks: dict[bytes, int], pattern: str) -> Encoder:
    if digest not in _encoders:
        _encoders.clear()
        _encoders[digest] = Encoder(ranks, pattern)
    return _encoders[digest]


def _digest(ranks: dict[bytes, int], pattern: str) -> str:
    found = sha256(pattern.encode())
    for token, rank in sorted(ranks.items()):
        found.update(b"%d:%d:%b" % (rank, len(token), token))
    return found.hexdigest()


def _encoding(spark: SparkSession, ranks: dict[bytes, int], pattern: str, keys: list[str], hashed: bool = False):
    """A mapInPandas function: ``keys`` stay, text becomes n_tokens, ids and decoded, or their sha256."""
    shared = spark.sparkContext.broadcast((_digest(ranks, pattern), ranks, pattern))  # one vocabulary

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(*shared.value)
        for part in parts:
            texts, done = part["text"].tolist(), 0
            while done < len(texts):
                counts, ids, decoded, held, first = [], [], [], 0, done
                while done < len(texts) and held < HANDED_ON:
                    joined, raw = encoder.both(texts[done])
                    counts.append(joined.count(" ") + 1 if joined else 0)
                    ids.append(sha256(joined.encode()).hexdigest() if hashed else joined)
                    decoded.append(sha256(raw).hexdigest() if hashed else raw)
                    held += len(texts[done])
                    done += 1
                out = part[keys].iloc[first:done].copy()
                out["n_tokens"], out["ids"], out["decoded"] = counts, ids, decoded
                yield out

    return run


def encode(spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (decimal, one space between), decoded (binary).

    A null text is empty and has no ids.  Repeated rows give repeated rows; a doc_id may be null; an
    empty table gives none.  Further columns are not read.
    """
    short, long = _parts(docs)
    out = "doc_id long, n_tokens long, ids string, decoded binary"
    short = short.mapInPandas(_encoding(spark, ranks, pattern, ["doc_id"]), out)
    return short.unionByName(_encode_long(spark, long, ranks, pattern))


def digests(spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and the sha256 of ids and of decoded bytes of ``encode``.

    Texts of one chunk are hashed where they are encoded, so that neither leaves its task.
    """
    short, long = _parts(docs)
    out = "doc_id long, n_tokens long, ids string, decoded string"
    short = short.mapInPandas(_encoding(spark, ranks, pattern, ["doc_id"], hashed=True), out)
    long = _encode_long(spark, long, ranks, pattern).withColumns(
        {"ids": F.sha2("ids", 256), "decoded": F.sha2("decoded", 256)}
    )
    both = short.unionByName(long)
    return both.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


def _parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id and text of the texts of one chunk, and of longer ones."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.where(F.length("text") <= CHUNK), rows.where(F.length("text") > CHUNK)


def _encode_long(spark: SparkSession, rows: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    key = ["doc_id", "digest"]
    long = (
        rows.groupBy("doc_id", "text")
        .count()
        .withColumn("digest", F.sha2("text", 256))
        .withColumn("chars", F.length("text"))
    )
    long = stage(long, "long_texts")
    last = F.floor((F.col("chars") - 1) / CHUNK).cast("int")
    begin = F.greatest(F.col("k") * CHUNK - OVERLAP, F.lit(0))
    chunks = (
        long.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("begin", begin)
        .select(
            *key,
            "k",
            "begin",
            F.expr(f"substring(text, begin + 1, (k + 1) * {CHUNK} + {OVERLAP} - begin)").alias("text"),
        )
        .repartition(*key, "k")
    )
    starts = chunks.mapInPandas(
        _boundaries(spark, ranks, pattern),
        "doc_id long, digest string, k int, left array<int>, right array<int>",
    )
    order = Window.partitionBy(*key).orderBy("k")  # the chunks of one text
    common = F.array_min(F.array_intersect(F.lag("right").over(order), "left"))
    cuts = (
        starts.withColumn("cut", F.when(F.col("k") == 0, F.lit(0)).otherwise(common))
        .groupBy(*key)
        .agg(
            F.bool_or(F.col("cut").isNull()).alias("apart"),
            F.array_sort(F.collect_list("cut")).alias("cuts"),
        )
    )
    same = F.expr("long.doc_id <=> cuts.doc_id and long.digest = cuts.digest")
    pieces = (
        long.alias("long")
        .join(cuts.alias("cuts"), same)
        .select("long.*", F.expr("if(apart, array(0), cuts)").alias("cuts"))
        .select(*key, "count", "text", "chars", "cuts", F.posexplode("cuts").alias("k", "cut"))
        .withColumn("stop", F.expr("coalesce(try_element_at(cuts, k + 2), chars)"))
        .select(*key, "count", "k", F.expr("substring(text, cut + 1, stop - cut)").alias("text"))
        .repartition(*key, "k")
    )
    kept = [*key, "count", "k"]
    encoded = pieces.mapInPandas(
        _encoding(spark, ranks, pattern, kept),
        "doc_id long, digest string, count long, k int, n_tokens long, ids string, decoded binary",
    )
    return (
        encoded.groupBy(*key, "count")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.array_sort(F.collect_list(F.struct("k", "ids", "decoded"))).alias("parts"),
        )
        .select(
            "doc_id",
            "n_tokens",
            F.expr("array_join(transform(parts, p -> p.ids), ' ')").alias("ids"),
            F.expr("unhex(array_join(transform(parts, p -> hex(p.decoded)), ''))").alias("decoded"),
            F.expr("explode(sequence(1L, count))").alias("copy"),
        )
        .drop("copy")
    )


def _boundaries(spark: SparkSession, ranks: dict[bytes, int], pattern: str):
    """Starts of pre-tokens in the overlaps of a chunk with its neighbours, from the text's start."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder({}, pattern)
        for part in parts:
            left, right = [], []
            for k, begin, text in zip(part["k"], part["begin"], part["text"], strict=True):
                at = [begin + s for s in encoder.starts(text)]
                left.append([x for x in at if k and x < k * CHUNK + OVERLAP])
                near = (x for x in at if x >= (k + 1) * CHUNK - OVERLAP)
                right.append([x for x in near if not text[x - begin - 1].isspace()])
            out = part[["doc_id", "digest", "k"]].copy()
            out["left"], out["right"] = left, right
            yield out

    return run
