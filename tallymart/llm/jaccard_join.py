"""Similarity join of word n-gram sets by chosen paths.

Texts of equal n-gram sets are one node with a MinHash signature.  A run splits the nodes
recursively: each bucket samples ``BRANCHES`` coordinates, its nodes go to the bucket of the
token they hold there, until a bucket is small, or stays nearly whole when split.  The
nodes of such a leaf are compared all with all, in blocks of bounded size.  Runs are
repeated until a pair at the threshold is missed with a probability below ``MISS``, however
deep the buckets are split and with all runs sampling the same coordinates.

Signatures rule out most pairs of a leaf; what is left is decided by the sets themselves.
A pair that shares several leaves counts in the least of them.  Only counts of links and a
spanning forest of each block leave the tasks, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.filters import bitmap, held, slot
from tallymart.llm.rows import located, without
from tallymart.llm.shared import arrow_batches, stage
from tallymart.llm.words import SECOND_BASE, Block, U, blocks, mix, prefix, run_hash, shingles

WORDS, THRESHOLD = 5, 0.8
COORDINATES, BRANCHES, MISS = 32, 2, 1e-4
#: Nodes of a leaf that needs no further split; nodes on a side of a compared block.
LEAF, SIDE = 1024, 512
#: A bucket with this part of its parent's nodes is not split any more.
DENSE, LEVELS = 0.5, 6
#: Bytes of an Arrow batch: texts and sets are long rows, 10,000 of them at a time fill tasks and executors.
BATCH = 1 << 21
#: Part of ``MISS`` that a signature which misses the threshold may take.
SLACK = 0.1
_seeds = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, COORDINATES, dtype=np.uint64) * U(2) + U(1)


def agreements(threshold: float) -> np.ndarray:
    """Probabilities that a pair at the threshold agrees in 0, 1 ... of the coordinates."""
    n = COORDINATES
    return np.array([comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(n + 1)])


def least_agreement(threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Agreeing coordinates that a signature needs for its pair to be compared."""
    below = np.concatenate([[0.0], np.cumsum(agreements(threshold))])
    return max(1, int(np.searchsorted(below, SLACK * miss, side="right")) - 1)


def missed(runs: int, threshold: float = THRESHOLD, levels: int = LEVELS, miss: float = MISS) -> float:
    """Probability that no run, each as many levels deep, finds a pair at the threshold.

    All runs sample the same coordinates, so the average is taken over the number in which
    the pair agrees.  Given that, a bucket that holds both sends them on together in each of
    its branches with equal chance, apart from each other, and the rest of the levels follows
    below each; a bucket that is split no further has found them.
    """
    agree = np.arange(COORDINATES + 1) / COORDINATES
    found = np.ones(COORDINATES + 1)
    for _ in range(levels):
        found = 1 - (1 - agree * found) ** BRANCHES
    found[: least_agreement(threshold, miss)] = 0
    return float(agreements(threshold) @ (1 - found) ** runs)


def runs_needed(threshold: float = THRESHOLD, levels: int = LEVELS, miss: float = MISS) -> int:
    """Least number of runs after which a pair at the threshold is missed with less than ``miss``."""
    if missed(1 << 20, threshold, levels, miss) >= miss:
        raise ValueError(f"{COORDINATES} coordinates cannot find pairs at {threshold} with a miss below {miss}")
    runs = 1
    while missed(runs, threshold, levels, miss) >= miss:
        runs += 1
    return runs


def sets_of(block: Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all texts of a block, sorted by text, and where each text's begin.

    A text of fewer words, but some, has one n-gram: all of them.
    """
    h = block.hashes()
    grams = shingles(h, words)
    n = np.diff(block.bounds)
    text = np.repeat(np.arange(block.n), n)[: len(grams)]
    inside = np.arange(len(grams)) + words <= block.bounds[1:][text] if len(grams) else np.zeros(0, bool)
    few = np.flatnonzero((n > 0) & (n < words))
    whole = run_hash(prefix(h, SECOND_BASE), block.bounds[few], block.bounds[few + 1], SECOND_BASE)
    text, grams = np.concatenate([text[inside], few]), np.concatenate([grams[inside], whole])
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])
    text, grams = text[new], grams[new]
    return grams, np.searchsorted(text, np.arange(block.n + 1))


def node_of(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Hash of each set; 0 for an empty one."""
    out = run_hash(prefix(grams, SECOND_BASE), edges[:-1], edges[1:], SECOND_BASE)
    return np.where(np.diff(edges) > 0, out, U(0))


def signatures(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of each set that is not empty."""
    begin = edges[:-1][np.diff(edges) > 0]
    out = np.empty((len(begin), COORDINATES), np.uint32)
    for j, seed in enumerate(_seeds):
        values = (grams * seed) ^ (grams >> U(29))
        out[:, j] = (np.minimum.reduceat(values * seed, begin) >> U(32)).astype(np.uint32)
    return out


def described(rows: DataFrame, words: int) -> DataFrame:
    """doc_id, file, row, node, size, sig for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                grams, edges = sets_of(block, words)
                size = np.diff(edges)
                sig = np.zeros((block.n, COORDINATES), np.uint32)
                if len(grams):
                    sig[size > 0] = signatures(grams, edges)
                flat = pa.array(sig.view(np.int32).ravel())
                part = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "file", "row")),
                        pa.array(node_of(grams, edges).view(np.int64)),
                        pa.array(size, pa.int32()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(block.n + 1) * COORDINATES, pa.int32()), flat
                        ),
                    ],
                    ["doc_id", "file", "row", "node", "size", "sig"],
                )

    return rows.select("doc_id", "file", "row", "text").mapInArrow(
        run, "doc_id long, file string, row long, node long, size int, sig array<int>"
    )


def _sized(entries: DataFrame, level: int) -> DataFrame:
    """Entries (path, node, parent_size) with the size of their bucket, of two nodes at least."""
    entries = stage(entries, f"paths_{level}")
    sizes = entries.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
    return stage(entries.join(stage(sizes, f"sizes_{level}"), "path"), f"buckets_{level}")


def _children(parents: DataFrame, level: int) -> DataFrame:
    """Split each (path, node, sig, members) by the coordinates that its path samples."""
    branch = parents.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))))
    coordinate = F.pmod(F.xxhash64("path", "branch", F.lit(level)), F.lit(COORDINATES)).cast("int")
    return branch.select(
        F.xxhash64("path", "branch", F.element_at("sig", coordinate + 1)).alias("path"),
        "node",
        F.col("members").alias("parent_members"),
    )


def leaves(nodes: DataFrame, runs: int) -> DataFrame:
    """(path, node, members): the leaves of all runs that hold two nodes or more."""
    root = nodes.where("size > 0").withColumn("path", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs).cast("long"))))
    parents = root.select("path", "node", "sig", F.lit(2**62).alias("members"))
    done = None
    for level in range(1, LEVELS + 1):
        buckets = _sized(_children(parents, level), level)
        small = F.col("members") <= LEAF
        dense = F.col("members") >= DENSE * F.col("parent_members")
        stop = small | dense | F.lit(level == LEVELS)
        leaf = buckets.where(stop).select("path", "node", "members")
        done = leaf if done is None else done.unionByName(leaf)
        rest = buckets.where(~stop)
        if rest.isEmpty():
            break
        parents = rest.select("path", "node", "members").join(nodes.select("node", "sig"), "node")
    return done


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal key of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in key])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(values[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


KEY = ("path", "one", "two")


def _pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the two sides of a block, each in the order of nodes."""
    side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
    one, two = int(table.column("one")[0].as_py()), int(table.column("two")[0].as_py())
    a, b = (np.flatnonzero(side == s) for s in (one, two))
    return a[np.argsort(node[a])], b[np.argsort(node[b])], one == two


def _first_leaf(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray, path: int) -> np.ndarray:
    """Whether ``path`` is the least leaf that the rows of each pair (a, b) share."""
    out = np.ones(len(a), bool)
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        both = np.intersect1d(lists[i], lists[j], assume_unique=True)
        out[k] = both[0] == path
    return out


def _common(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray, path: int) -> np.ndarray:
    """Matrix: rows of a against b, True where they share no leaf less than ``path``."""
    out = np.ones((len(a), len(b)), bool)
    holders: dict[int, tuple[list[int], list[int]]] = {}
    for rows, part in ((a, 0), (b, 1)):
        for k, i in enumerate(rows):
            for leaf in lists[i][lists[i] < path].tolist():
                holders.setdefault(leaf, ([], []))[part].append(k)
    for x, y in holders.values():
        if x and y:
            out[np.ix_(x, y)] = False
    return out


def hopeful(leaf_rows: DataFrame, threshold: float) -> DataFrame:
    """Rows of each block that have a partner by their signatures."""
    least = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, KEY):
            a, b, own = _pairs(table)
            if not len(a) or not len(b):
                continue
            path = table.column("path")[0].as_py()
            sig = np.array(table.column("sig").combine_chunks().flatten()).reshape(-1, COORDINATES)
            size = table.column("size").to_numpy()
            same = np.zeros((len(a), len(b)), np.uint8)
            for j in range(COORDINATES):
                same += sig[a, j][:, None] == sig[b, j][None, :]
            good = same >= least
            ratio = np.minimum.outer(size[a], size[b]) >= threshold * np.maximum.outer(size[a], size[b])
            good &= ratio
            if own:
                good &= np.tri(len(a), k=-1, dtype=bool).T
            if not good.any():
                continue
            lists = _leaf_lists(table)
            good &= _common(lists, a, b, path)
            rows = np.unique(np.concatenate([a[good.any(axis=1)], b[good.any(axis=0)]]))
            if len(rows):
                picked = table.select(["path", "one", "two", "side", "node", "leaves"]).take(pa.array(rows))
                yield from picked.combine_chunks().to_batches()

    fields = "path long, one int, two int, side int, node long, leaves array<long>"
    return leaf_rows.mapInArrow(run, fields)


def _leaf_lists(table: pa.Table) -> list[np.ndarray]:
    column = table.column("leaves").combine_chunks()
    values, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [values[x:y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]


def linked(sets: DataFrame, threshold: float) -> DataFrame:
    """node, links, root: links of a node in a block and the node its block's forest hangs it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, KEY):
            a, b, own = _pairs(table)
            if not len(a) or not len(b):
                continue
            node = table.column("node").to_numpy()
            column = table.column("grams").combine_chunks()
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            grams = column.flatten().to_numpy()
            common = overlaps(grams, offsets, a, b)
            n = np.diff(offsets)
            either = n[a][:, None] + n[b][None, :] - common
            good = common >= threshold * either - 1e-9
            if own:
                good &= np.tri(len(a), k=-1, dtype=bool).T
            good &= _common(_leaf_lists(table), a, b, table.column("path")[0].as_py())
            x, y = np.nonzero(good)
            if not len(x):
                continue
            links = np.bincount(np.concatenate([a[x], b[y]]), minlength=len(node))
            root = _forest(a[x], b[y], node)
            rows = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows]), pa.array(links[rows]), pa.array(root[rows])], ["node", "links", "root"]
            )

    return sets.mapInArrow(run, "node long, links long, root long")


def overlaps(grams: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a with sets b, from products of 0/1 matrices."""
    values, code = np.unique(grams, return_inverse=True)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    often = np.bincount(code, minlength=len(values)) > 1
    number = np.cumsum(often) - 1
    chosen = often[code]
    code, owner = number[code[chosen]], owner[chosen]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(a), len(b)), np.float32)
    place = np.full((2, len(offsets) - 1), -1)
    place[0, a], place[1, b] = np.arange(len(a)), np.arange(len(b))
    for low in range(0, int(often.sum()), 4096):
        x, y = np.searchsorted(code, (low, low + 4096))
        sides = []
        for s, size in ((0, len(a)), (1, len(b))):
            m = np.zeros((size, 4096), np.float32)
            row = place[s, owner[x:y]]
            m[row[row >= 0], code[x:y][row >= 0] - low] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _forest(a: np.ndarray, b: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Least node that each row reaches over the links (a, b)."""
    root = node.copy()
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == root).all():
            return root
        root = new


def _gram_rows(texts: DataFrame, words: int) -> DataFrame:
    """(node, grams) of each text whose node is the wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("node").to_numpy()
            for block in blocks(batch.column("text")):
                grams, edges = sets_of(block, words)
                mine = wanted[block.first : block.first + block.n]
                keep = pa.array(node_of(grams, edges).view(np.int64) == mine)
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(grams.view(np.int64)))
                out = pa.RecordBatch.from_arrays([pa.array(mine), lists], ["node", "grams"])
                yield out.filter(keep)

    return texts.mapInArrow(run, "node long, grams array<long>")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    runs: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, file, row, class_id, n_links, first (struct of the row that
    leads the class).

    Two texts are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``threshold``; a class is all that links and equal sets connect, and bears its least
    doc_id.  ``n_links`` counts other sets, each once, so copies do not add to it.  Texts
    without words are copies of each other and link to nothing.  Null ids come last; rows of
    the same id are told apart by their place.  An empty table gives no rows.
    """
    with arrow_batches(spark, BATCH):
        return _near_duplicates(spark, docs, threshold, words, runs or runs_needed(threshold))


def _near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float, words: int, runs: int) -> DataFrame:
    """All Python functions run in staged frames; what is returned only joins them."""
    rows = located(docs)
    prints = stage(described(rows, words), "signatures")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    nodes = prints.groupBy("node").agg(
        F.min(place).alias("first"), F.max("size").alias("size"), F.max("sig").alias("sig")
    )
    nodes = stage(nodes, "nodes")
    ended = stage(leaves(nodes, runs), "leaves")
    of_node = ended.groupBy("node").agg(
        F.array_sort(F.collect_set("path")).alias("leaves"),
        F.collect_set(F.struct("path", "members")).alias("own"),
    )
    of_node = stage(of_node, "leaves_of_nodes").join(nodes.select("node", "size", "sig"), "node")
    blocks_of = F.ceil(F.col("own.members") / SIDE).cast("int")
    each = (
        of_node.withColumn("own", F.explode("own"))
        .withColumn("n", blocks_of)
        .withColumn("side", F.pmod(F.xxhash64("node", "own.path"), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, n - 1)")))
        .select(
            F.col("own.path").alias("path"),
            F.least("side", "other").alias("one"),
            F.greatest("side", "other").alias("two"),
            "side",
            "node",
            "size",
            "sig",
            "leaves",
        )
        .repartition(*KEY)
        .sortWithinPartitions(*KEY)
    )
    found = stage(hopeful(each, threshold), "hopeful")

    wanted = found.select("node").distinct().join(nodes.select("node", "first"), "node")
    wanted = stage(wanted.select("node", F.col("first.doc_id").alias("doc_id")), "wanted")
    shared = spark.sparkContext.broadcast(bitmap(wanted.select(slot(F.col("doc_id")).alias("slot"))))

    @F.pandas_udf("boolean")
    def among(slots):
        import pandas as pd

        return pd.Series(held(np.frombuffer(shared.value, np.uint8), slots.to_numpy()))

    texts = docs.select("doc_id", "text").where(among(slot(F.col("doc_id")))).alias("d")
    # a shuffle, also of few: without it a task runs both functions, in two Python workers that stay
    texts = texts.join(wanted.hint("merge").alias("w"), F.expr("d.doc_id <=> w.doc_id")).select("d.text", "w.node")
    grams = _gram_rows(texts, words).dropDuplicates(["node"])
    sets = found.join(grams, "node").repartition(*KEY).sortWithinPartitions(*KEY)
    links = stage(linked(sets, threshold), "links")
    reached = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    known = nodes.select("node", "first").join(reached, "node").join(counted, "node", "left")
    known = stage(known, "linked_nodes")
    leaders = known.groupBy("root").agg(F.min("first").alias("leader"))
    classes = nodes.select("node", "first").join(
        known.join(leaders, "root").select("node", "n_links", "leader"), "node", "left"
    )
    classes = stage(classes.withColumn("first", F.coalesce("leader", "first")), "classes")
    return prints.select("doc_id", "file", "row", "node").join(classes, "node").select(
        "doc_id",
        "file",
        "row",
        F.col("first.doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "first",
    )


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The leading row of each class, with its columns as they were."""

    def dropped(view: DataFrame) -> DataFrame:
        found = near_duplicates(spark, view)
        return found.where("not (file = first.file and row = first.row)").select("file", "row")

    return without(docs, dropped)
