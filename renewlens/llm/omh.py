"""Order MinHash near-duplicate classes (operator 6).

Each document is its sequence of 5-word shingles (words are runs of
``[^\\x20\\x09-\\x0D]``), each labelled with its occurrence number. Per sketch
the ``TUPLE`` labelled shingles of least hash are taken and kept *in text
order*; two documents meet in a sketch only if they agree on the shingles and
on their order, which tracks edit similarity rather than plain overlap. With
18 sketches of 3, a pair of similarity 0.8 is missed with probability
(1 - 0.8^3)^18 = 3e-6. Texts whose different shingles reach it (first
occurrences, in order) are near as well, however often a passage comes in one
of them: a text with repeats has as many keys of its first occurrences again,
which are those of the same text without repeats. Every met pair is verified by a banded alignment of the
two shingle sequences: m aligned shingles give similarity
m / (n1 + n2 - m), at most their Jaccard index, and no aligned shingle of a
pair that passes can be displaced by more than the band. Links become classes
by distributed connected components; equal texts are one node from the start.

In a bucket of many nodes all are compared with one of them; where that leaves
two components, the nodes of that family are compared exactly, block by block
of ``BLOCK`` texts inside tasks, through an inverted index of their shingles:
the work of one unsettled family grows with its square, in steps of bounded
memory, and only links leave a task. The links of each text are counted in the
same way over the components that a crowded bucket reaches.

Nodes are 64-bit text hashes: n texts hold about n^2 / 2^65 colliding pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb
from renewlens.llm.buckets import bucket_pairs, unsettled
from renewlens.llm.graph import connected_components
from renewlens.sources.store import stage

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 18
TUPLE = 3
#: Expected number of shingles a document offers to a sketch's minimum search.
_OFFER = 16
#: Texts in one block of an unsettled family.
BLOCK = 512
#: Shared items counted at once between two blocks.
_HITS = 1 << 20


def labelled_shingles(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, labelled shingles, offsets, whether each is
    its text's first of the kind) by ranges of rows."""
    raw, offsets = tb.utf8(column)
    for lo, hi in tb.doc_ranges(offsets):
        words, docs = tb.word_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        s, so = tb.shingles(words, docs, hi - lo, k)
        items, first = tb.occurrence_labelled(s, so)
        yield lo, hi, items, so, first


def order_min_hashes(items: np.ndarray, offsets: np.ndarray, sketches: int, size: int) -> np.ndarray:
    """Keys (documents x sketches): the ``size`` least items of each document
    under each sketch's hash, hashed in text order. Rows of documents without
    items are zero."""
    n_docs = len(offsets) - 1
    counts = np.diff(offsets)
    keys = np.zeros((n_docs, sketches), np.uint64)
    if not len(items):
        return keys
    docs = np.repeat(np.arange(n_docs), counts)
    share = np.minimum(1.0, _OFFER / np.maximum(counts, 1))
    limit = np.where(share >= 1, np.uint64(2**64 - 1), (share * 2.0**63).astype(np.uint64) * np.uint64(2))
    limits = limit[docs]
    want = np.minimum(counts, size)
    rng = np.random.default_rng(0x0D0C)
    for j in range(sketches):
        salt, odd = (np.uint64(x | 1) for x in rng.integers(0, 2**63, 2, dtype=np.int64).tolist())
        v = (items ^ salt) * odd
        at = np.flatnonzero(v <= limits)
        got = np.bincount(docs[at], minlength=n_docs)
        if (got < want).any():  # rare: a document whose least items lie above the limit
            full = got < want
            at = np.flatnonzero((v <= limits) | full[docs])
        order = at[np.lexsort((v[at], docs[at]))]
        d = docs[order]
        first = np.ones(len(d), dtype=bool)
        first[1:] = d[1:] != d[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(d)), 0))
        chosen = np.sort(order[np.arange(len(d)) - start < size])
        d = docs[chosen]
        first = np.ones(len(d), dtype=bool)
        first[1:] = d[1:] != d[:-1]
        begins = np.flatnonzero(first)
        rank = (np.arange(len(d)) - np.maximum.accumulate(np.where(first, np.arange(len(d)), 0))).astype(np.uint64)
        parts = tb.mix(items[chosen] + (rank + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        keys[d[begins], j] = tb.mix(np.add.reduceat(parts, begins) + np.uint64(j + 1) * np.uint64(0xBF58476D1CE4E5B9 >> 8))
    return keys


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two sequences of distinct items by banded alignment, or 0
    as soon as it can't reach the threshold."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    need = int(np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9))
    if min(n, m) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = max(n, m) - need
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < need:
        return 0.0
    j = j[np.argsort(i)]
    if (j[1:] > j[:-1]).all():
        length = len(j)
    else:  # matches are one to one, so the alignment is an increasing run
        tails: list[int] = []
        for x in j.tolist():
            p = bisect_left(tails, x)
            if p == len(tails):
                tails.append(x)
            else:
                tails[p] = x
        length = len(tails)
    s = length / (n + m - length)
    return s if s >= threshold - 1e-12 else 0.0


def similarity(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """``aligned`` of the labelled shingles, or where that is too low and
    shingles repeat, of the different ones."""
    s = aligned(a, b, threshold)
    if s or (first_a.all() and first_b.all()):
        return s
    return aligned(a[first_a], b[first_b], threshold)


def _may_reach(threshold: float) -> str:
    return " or ".join(
        f"least(x.{n}, y.{n}) >= {threshold}D * greatest(x.{n}, y.{n}) - 1e-9D" for n in ("n_shingles", "n_distinct")
    )


def sketch(docs: DataFrame, sketches: int = SKETCHES, size: int = TUPLE, k: int = SHINGLE) -> DataFrame:
    """(doc_id, node, n_shingles, n_distinct, keys) of the documents that have
    a text; one that repeats shingles has keys by all of them and by the first
    of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, items, offsets, first in labelled_shingles(batch.column("text"), k):
                keys = order_min_hashes(items, offsets, sketches, size)
                counts = np.diff(offsets)
                part = batch.slice(lo, hi - lo)
                distinct = np.concatenate([[0], np.cumsum(first)])
                distinct = distinct[offsets[1:]] - distinct[offsets[:-1]]
                again = np.flatnonzero(distinct < counts)
                width = np.where(counts > 0, sketches, 0)
                width[again] *= 2
                begins = np.cumsum(width) - width
                flat = np.empty(width.sum(), np.uint64)
                at = begins[counts > 0][:, None] + np.arange(sketches)
                flat[at] = keys[counts > 0]
                if len(again):
                    chosen = first & np.repeat(distinct < counts, counts)
                    ends = np.concatenate([[0], np.cumsum(distinct[again])])
                    flat[begins[again][:, None] + sketches + np.arange(sketches)] = order_min_hashes(items[chosen], ends, sketches, size)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()), pa.array(flat.view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("node"), pa.array(counts, pa.int64()), pa.array(distinct, pa.int64()), lists],
                    ["doc_id", "node", "n_shingles", "n_distinct", "keys"],
                )

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("node"), "text")
    return rows.mapInArrow(run, "doc_id long, node long, n_shingles long, n_distinct long, keys array<long>")


def verify_pairs(pairs: DataFrame, texts: DataFrame, reader: Callable, score: Callable) -> DataFrame:
    """Links (a, b, similarity) of the pairs that ``score`` gives over zero.
    ``reader`` turns a text column into items as ``labelled_shingles`` does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                both = []
                for name in ("ta", "tb"):
                    one: list[tuple[np.ndarray, np.ndarray]] = []
                    for _, _, items, offsets, first in reader(part.column(name)):
                        one += [(items[o:e], first[o:e]) for o, e in zip(offsets[:-1], offsets[1:], strict=True)]
                    both.append(one)
                sim = np.array([score(*x, *y) for x, y in zip(*both, strict=True)], float)
                ok = pa.array(sim > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(ok), part.column("b").filter(ok), pa.array(sim[sim > 0])], ["a", "b", "similarity"]
                )

    # a hot node keys many pairs: both joins are plain ones, which adaptive execution splits
    wide = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return wide.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, similarity double")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of item sets reach the Jaccard threshold: a matrix."""
    items = np.concatenate(b)
    owner = np.repeat(np.arange(len(b)), [len(x) for x in b])
    order = np.argsort(items, kind="stable")
    terms, begin = np.unique(items[order], return_index=True)
    owner, end = owner[order], np.append(begin[1:], len(items))
    sizes = np.array([len(x) for x in b])
    out = np.zeros((len(a), len(b)), dtype=bool)
    if not len(terms):
        return out
    counts = np.array([len(x) for x in a], np.int64)
    item = np.concatenate(a)
    at = np.minimum(np.searchsorted(terms, item), len(terms) - 1)
    lens = np.where(terms[at] == item, end[at] - begin[at], 0)
    last = np.cumsum(counts)
    # rows of a in runs of bounded size: each hit is a count for (row of a, row of b)
    hits = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], last])] + np.arange(len(a) + 1) * len(b)
    for lo, hi in tb.doc_ranges(hits, _HITS):
        s = slice(last[lo] - counts[lo], last[hi - 1])
        n = lens[s]
        where = np.arange(n.sum()) + np.repeat(begin[at[s]] - np.cumsum(n) + n, n)
        row = np.repeat(np.repeat(np.arange(hi - lo), counts[lo:hi]), n)
        shared = np.bincount(row * len(b) + owner[where], minlength=(hi - lo) * len(b)).reshape(hi - lo, len(b))
        enough = shared >= threshold / (1 + threshold) * (counts[lo:hi, None] + sizes) - 1e-9
        out[lo:hi] = enough & (counts[lo:hi, None] > 0)
    return out


def _near_in_blocks(table: pa.Table, reader: Callable, score: Callable, threshold: float, apart: bool) -> list[tuple[int, int, float]]:
    """(a, b, similarity) of the pairs of two blocks of a family (or within
    one), each once; with ``apart`` only those of different labels."""
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    seqs: list[tuple[np.ndarray, np.ndarray]] = []
    for _, _, items, offsets, first in reader(table["text"]):
        seqs += [(items[o:e], first[o:e]) for o, e in zip(offsets[:-1], offsets[1:], strict=True)]
    block, node, label = (table[c].to_numpy() for c in ("block", "node", "label"))
    x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    near = np.zeros((len(x), len(y)), dtype=bool)
    if len(x) and len(y):
        near |= _overlaps([seqs[i][0] for i in x], [seqs[j][0] for j in y], threshold)
        if not all(first.all() for _, first in seqs):
            near |= _overlaps([seqs[i][0][seqs[i][1]] for i in x], [seqs[j][0][seqs[j][1]] for j in y], threshold)
        if apart:
            near &= label[x][:, None] != label[y][None, :]
        if lo == hi:
            near &= node[x][:, None] < node[y][None, :]
    rows = []
    for i, j in zip(*np.nonzero(near), strict=True):
        p, q = x[i], y[j]
        if s := score(*seqs[p], *seqs[q]):
            rows.append((min(node[p], node[q]), max(node[p], node[q]), s))
    return rows


def blocked_families(members: DataFrame, rows: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Pairs of blocks (pivot, lo, hi) of the families of (pivot, node, label),
    or those of them in ``only``, with the columns of ``rows`` (node, others)."""
    sizes = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    blocked = members.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pair = ["pivot", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "label"]
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    if only is None:
        return blocked.join(rows, "node").withColumn("other", every).select(*pair, *[c for c in rows.columns if c != "node"])
    return blocked.withColumn("other", every).select(*pair).join(only, ["pivot", "lo", "hi"], "left_semi").join(rows, "node")


def _blocks(members: DataFrame, texts: DataFrame, only: DataFrame | None = None) -> GroupedData:
    """``blocked_families`` with texts, by pairs of blocks."""
    return blocked_families(members, texts, only).groupBy("pivot", "lo", "hi")


def compare_families(members: DataFrame, texts: DataFrame, reader: Callable, score: Callable, threshold: float, only: DataFrame | None = None) -> DataFrame:
    """Links (a, b, similarity) between nodes (pivot, node, label) of one pivot
    and different labels, by blocks (all pairs of blocks, or those in ``only``)."""

    def compare(table: pa.Table) -> pa.Table:
        rows = _near_in_blocks(table, reader, score, threshold, True)
        a, b, s = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return _blocks(members, texts, only).applyInArrow(compare, "a long, b long, similarity double")


def count_links(members: DataFrame, texts: DataFrame, reader: Callable, score: Callable, threshold: float) -> DataFrame:
    """(node, n_links): the links of each node (component, node) to all others
    of its component. Links lie within components, so none is left out or
    counted twice; only counts leave a task."""

    def count(table: pa.Table) -> pa.Table:
        rows = _near_in_blocks(table, reader, score, threshold, False)
        node, n = np.unique(np.array([r[:2] for r in rows], np.int64), return_counts=True)
        return pa.table({"node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64())})

    families = members.select(F.col("component").alias("pivot"), "node", F.col("component").alias("label"))
    return _blocks(families, texts).applyInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n_links"))


def near_duplicate_links(docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE,
                         sketches: int = SKETCHES, size: int = TUPLE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(nodes: node, doc_id, n_shingles, n_distinct; links: a, b, similarity;
    crowded: node, of crowded buckets; texts: node, text) where a node is a
    distinct text and links join different texts. Between crowded nodes there
    are links enough for the classes, not all."""
    sk = stage(sketch(docs, sketches, size, k), "omh-sketches")
    nodes = stage(sk.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("n_distinct").alias("n_distinct")), "omh-nodes")
    entries = sk.select(F.explode("keys").alias("key"), "node").distinct()
    pairs, crowded = bucket_pairs(entries, name="omh")
    x, y = nodes.alias("x"), nodes.alias("y")
    pairs = stage(
        pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
        .where(_may_reach(threshold)).select("a", "b"), "omh-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(crowded.select("node")).distinct()
    # one document of each wanted text: keyed by text and id, so copies of one text don't meet in one task
    where = nodes.join(wanted, "node").select("node", F.col("doc_id").alias("at"))
    src = docs.where("text is not null").select(F.xxhash64("text").alias("node"), F.col("doc_id").cast("long").alias("at"), "text")
    texts = src.join(where, (src["node"] == where["node"]) & src["at"].eqNullSafe(where["at"])).select(
        src["node"], "text").dropDuplicates(["node"])
    texts = stage(texts, "omh-texts")
    reader, score = partial(labelled_shingles, k=k), partial(similarity, threshold=threshold)
    links = stage(verify_pairs(pairs, texts, reader, score), "omh-links")
    open_nodes = stage(unsettled(crowded, connected_components(links, name="omh-star")), "omh-open")
    more = stage(compare_families(open_nodes, texts, reader, score, threshold).distinct(), "omh-rest")
    return nodes, links.unionByName(more).distinct(), crowded.select("node").distinct(), texts


def _node() -> Column:
    return F.when(F.col("text").isNotNull(), F.xxhash64("text"))


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its class),
    n_shingles, n_links (links of its text to different texts, all of them verified), kept
    (whether it is the one that stays).

    A null text is a class of its own (n_shingles and n_links 0). Texts
    without a word are near nothing but their exact copies. Of a class the
    document of least doc_id stays, a null one last, and of different texts
    under it (or without an id) the one of least hash. Rows that repeat a doc_id
    and text share a class and are kept alike. A class whose ids are all null has
    a null class_id. Other columns of ``docs`` are ignored; an empty table gives an
    empty table.
    """
    return _classes(docs, threshold, k, True).drop("node")


def _classes(docs: DataFrame, threshold: float, k: int, counted: bool) -> DataFrame:
    """``near_duplicate_classes`` with the node of each text; n_links is whole
    only if ``counted``."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    nodes, links, crowded, texts = near_duplicate_links(src, threshold, k)
    comp = connected_components(links, name="omh-all")
    degree = (
        links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
        .groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    )
    if counted:  # a component that a crowded bucket reaches has links that no bucket gave
        comp = stage(comp, "omh-components")
        reached = comp.join(crowded, "node", "left_semi").select("component").distinct()
        members = stage(comp.join(reached, "component", "left_semi"), "omh-members")
        reader, score = partial(labelled_shingles, k=k), partial(similarity, threshold=threshold)
        whole = stage(count_links(members, texts, reader, score, threshold), "omh-counts")
        degree = degree.join(members, "node", "left_anti").unionByName(whole)
    of = nodes.join(comp, "node", "left").join(degree, "node", "left").select(
        "node", "doc_id", "n_shingles", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    least = of.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("least"))
    of = stage(of.join(least, "component").select(
        "node", F.col("least.doc_id").alias("class_id"), (F.col("node") == F.col("least.node")).alias("first"), "n_shingles", "n_links"), "omh-classes")
    rows = src.select("doc_id", _node().alias("node"))
    return rows.join(of, "node", "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("node").isNull() | (F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"), "node",
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """``docs`` without all but one document (as ``near_duplicate_classes`` says) of each class,
    all columns as they came; of rows that repeat id and text one stays."""
    kept = _classes(docs, threshold, k, False).where("kept").select(F.col("doc_id").alias("__kept"), F.col("node").alias("__node")).distinct()
    key = F.xxhash64("text", "doc_id")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__kept")) & _node().eqNullSafe(F.col("__node"))
    return docs.join(kept, same, "left_semi").withColumn("__row", key).dropDuplicates(["__row"]).drop("__row")


def op6_order_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
