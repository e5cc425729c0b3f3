"""Fuzzy line deduplication by MinHash (operator 9).

All lines with a word are compared, equal ones as one node. A line's signature
holds the least hash of its 5-character shingles in each of 64 parts of hash
space (an empty part takes that of another part, tried in an order of its own),
which are MinHash values; 22 bands of five of them make candidates. Lines
whose shingle sets reach a Jaccard index of 0.8 are linked, exactly verified; a
link is missed with probability (1 - 0.8^5)^22 = 2e-4 at the threshold and
3e-6 at an index of 0.85. Lines that share a band by chance grow with the square
of the input; bands of five leave few of them. Sets that reach 0.8 are of similar size, so buckets
are split by size class (a power of two; sets little below the next one stand
in both), and pairs are held against their exact sizes and against sketches of
odd counts, an exact bound, which are made with the signatures: only texts of
pairs that pass are fetched. A crowded bucket is handled as in ``buckets``; what its
star leaves open is compared by sketches, and by texts where that tells too few
apart. Links become components by distributed
connected components, and one line of each stays: its first occurrence by
document id, text hash and position.

Signatures and verification are numpy inside tasks: the same in DataFrame
functions alone went far beyond the CPU limit (figures in the README).
Equal lines are known by 128 bits of hash. Links join 64-bit nodes; lines that
share one by chance keep to their exact copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb
from renewlens.llm.buckets import bucket_pairs, sieved, unsettled
from renewlens.llm.graph import connected_components
from renewlens.llm.omh import blocked_families, compare_families, verify_pairs
from renewlens.sources.store import StageScope, stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 22
ROWS = 5
#: Rows whose band keys are made at once.
_ROWS_AT_ONCE = 1024
#: Bands whose keys are counted in one shuffle.
_BANDS_AT_ONCE = 11
#: Pairs a line that sketches may leave of two blocks of a family.
_LEFT = 8
#: Pairs, and words of their sketches, held against each other at once.
_PAIRS, _WORDS = 1 << 20, 1 << 21
#: For each part the order in which an empty one tries the others.
_TRIES = np.argsort(np.random.default_rng(0x11E5).random((BANDS * ROWS, BANDS * ROWS)), axis=0)
_HAS_WORD = r"[^\x20\x09-\x0D]"
_CHUNK = 1 << 18
#: Bytes of lines within which a repeated line is signed once.
_STRETCH = 4 << 20


def char_shingles(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, hashed character shingles, offsets) by ranges
    of rows; a text of under ``k`` characters is one shingle."""
    column = column.fill_null("")
    ends = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    offsets = np.concatenate([[0], ends])
    for lo, hi in tb.doc_ranges(offsets, _CHUNK):
        text = "".join(column.slice(lo, hi - lo).to_pylist())
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        off = offsets[lo : hi + 1] - offsets[lo]
        lens = np.diff(off)
        padded = np.concatenate([cp, np.zeros(k - 1, np.uint64)])
        h = np.zeros(len(cp), np.uint64)
        for j in range(k):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += padded[j : j + len(cp)]
        whole = np.ones(len(cp), dtype=bool)  # shingles that end within their line
        for j in range(1, k):
            last = off[1:] - j
            whole[last[lens >= j]] = False
        short = np.flatnonzero((lens > 0) & (lens < k))
        if len(short):  # its characters, and its length in place of what follows
            at, size = off[:-1][short], lens[short]
            value = size.astype(np.uint64)
            for j in range(k - 1):
                has = size > j
                value[has] = tb.mix(value[has] * np.uint64(0x9E3779B97F4A7C15) + cp[at[has] + j] + np.uint64(1))
            h[at], whole[at] = value, True
        n = np.maximum(lens - (k - 1), np.minimum(lens, 1))
        yield lo, hi, tb.mix(h[whole]), np.concatenate([[0], np.cumsum(n)])


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The different shingles of each row, as ``omh.labelled_shingles``."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    for lo, hi, items, offsets in char_shingles(column):
        new = np.ones(len(items), dtype=bool)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            items[a:b].sort()
        new[1:] = items[1:] != items[:-1]
        new[offsets[:-1][np.diff(offsets) > 0]] = True
        ends = np.concatenate([[0], np.cumsum(new)])[offsets].astype(np.int64)
        flat = items[new]
        yield lo, hi, flat, ends, np.ones(len(flat), dtype=bool)


def jaccard(a: np.ndarray, _a: np.ndarray, b: np.ndarray, _b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Exact Jaccard index of two sorted sets, or 0 under the threshold."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)) - 1e-9:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    s = shared / (len(a) + len(b) - shared)
    return s if s >= threshold - 1e-12 else 0.0


def different(items: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(44 bits of hash of each row's different shingles in order, offsets)."""
    n = len(offsets) - 1
    own = np.repeat(np.arange(n, dtype=np.uint64), np.diff(offsets))
    both = np.sort(own << np.uint64(44) | items >> np.uint64(20))
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    sizes = np.bincount((both >> np.uint64(44)).astype(np.int64), minlength=n)
    return both & np.uint64((1 << 44) - 1), np.concatenate([[0], np.cumsum(sizes)])


def band_keys(items: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys (rows x bands), number of different shingles) of rows that all
    have shingles."""
    value, ends = different(items, offsets)
    return _banded(value, ends), np.diff(ends)


def _banded(value: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys (rows x bands) of rows of ``different`` shingles, some rows at a time."""
    keys = np.zeros((len(ends) - 1, BANDS), np.uint64)
    for lo in range(0, len(keys), _ROWS_AT_ONCE):
        cut = ends[lo : lo + _ROWS_AT_ONCE + 1]
        keys[lo : lo + _ROWS_AT_ONCE] = _band_keys(value[cut[0] : cut[-1]], cut - cut[0])
    return keys


def _band_keys(value: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n, parts = len(ends) - 1, BANDS * ROWS
    owner = np.repeat(np.arange(n), np.diff(ends))
    slot = owner * parts + (value * np.uint64(parts) >> np.uint64(44)).astype(np.int64)
    first = np.ones(len(slot), dtype=bool)
    first[1:] = slot[1:] != slot[:-1]
    empty = np.uint64(2**64 - 1)
    low = np.full(n * parts, empty)
    low[slot[first]] = value[first]
    low = low.reshape(n, parts)
    got_own = low.copy()
    row, at = np.nonzero(low == empty)
    for tries in _TRIES:
        if not len(row):
            break
        got = got_own[row, tries[at]]
        low[row, at] = got
        row, at = row[got == empty], at[got == empty]
    keys = np.zeros((n, BANDS), np.uint64)
    for r in range(ROWS):  # rows of a band lie far apart
        keys = tb.mix(keys + low[:, r * BANDS : (r + 1) * BANDS] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, BANDS + 1, dtype=np.uint64))
    return keys


def odd_sketches(items: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets) of the odd sketch of each row's different shingles: one
    bit for each part of hash space, set where that holds an odd number of
    them. A row of [2^c, 2^(c+1)) shingles has 2^(c+1) bits, 64 at least."""
    counts = np.diff(offsets)
    width = np.ones(len(counts), np.int64)
    for c in range(6, 63):
        if not (counts >> c).any():
            break
        width[counts >> c > 0] = 1 << (c - 5)
    begins = np.concatenate([[0], np.cumsum(width)])
    bits = (items & np.repeat(64 * width - 1, counts).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(64 * begins[:-1], counts) + bits, minlength=64 * begins[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8"), begins


def sketches(texts: DataFrame) -> DataFrame:
    """(node, size, odd) of (node, text): its different shingles and their odd sketch."""
    return signatures(texts.select("node", F.col("text").alias("line"))).select("node", "size", "odd")


def may_link(pairs: DataFrame, sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose odd sketches allow a Jaccard index of
    ``threshold``. Every bit in which two sketches differ stands for a shingle that
    one set alone holds, so no pair that reaches it is left out."""
    wide = pairs.join(sketched.toDF("a", "sa", "oa"), "a").join(sketched.toDF("b", "sb", "ob"), "b")
    # the longer sketch is folded to the length of the shorter one
    fold = "transform(sequence(1, size({s})), i -> aggregate(transform(sequence(0, size({l}) div size({s}) - 1), j -> {l}[int(i - 1 + j * size({s}))]), 0L, (x, y) -> x ^ y))"
    x, y = (f"if(size({a}) > size({b}), {fold.format(s=b, l=a)}, {a})" for a, b in (("oa", "ob"), ("ob", "oa")))
    apart = F.expr(f"aggregate(zip_with({x}, {y}, (x, y) -> bit_count(x ^ y)), 0, (n, d) -> n + d)")
    return wide.where(apart <= (1 - threshold) / (1 + threshold) * (F.col("sa") + F.col("sb")) + 1e-6).select("a", "b")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, pos, line, node) of the lines that take part."""
    split = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return split.where(F.col("line").rlike(_HAS_WORD)).withColumn("node", F.xxhash64("line"))


def signatures(lines: DataFrame) -> DataFrame:
    """(node, size, keys, odd) of (node, line): the number of its different
    shingles, the keys of its bands and its odd sketch; a node that comes again in the
    same stretch of the scan is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sign(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            _, once = np.unique(table.column("node").to_numpy(), return_index=True)
            table = table.take(pa.array(np.sort(once)))
            line = pa.concat_arrays(table.column("line").chunks)
            node = table.column("node").to_numpy()
            for lo, hi, items, offsets in char_shingles(line):
                value, ends = different(items, offsets)
                keys = _banded(value, ends)
                words, begins = odd_sketches(value, ends)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
                odd = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(words.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node[lo:hi]), pa.array(np.diff(ends), pa.int64()), lists, odd], ["node", "size", "keys", "odd"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= _STRETCH:
                yield from sign(held)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held and sum(b.num_rows for b in held):
            yield from sign(held)

    return lines.select("node", "line").mapInArrow(run, "node long, size long, keys array<long>, odd array<long>")


def _folded(words: np.ndarray, begin: np.ndarray, width: int, to: int) -> np.ndarray:
    """The sketches of ``width`` words from ``begin`` on, folded to ``to`` words."""
    got = words[begin[:, None] + np.arange(width)]
    return got if width == to else np.bitwise_xor.reduce(got.reshape(len(begin), width // to, to), axis=1)


def _sketches_allow(i: np.ndarray, j: np.ndarray, size: np.ndarray, words: np.ndarray, begins: np.ndarray, threshold: float) -> np.ndarray:
    """``may_link`` for the rows i and j of (size, sketch)."""
    width = np.diff(begins)
    out = np.zeros(len(i), dtype=bool)
    both = width[i] << 32 | width[j]
    for kind in np.unique(both).tolist():
        a, b = kind >> 32, kind & (1 << 32) - 1
        at, to = np.flatnonzero(both == kind), min(a, b)
        step = max(1, _WORDS // max(a, b))
        for lo in range(0, len(at), step):
            k = at[lo : lo + step]
            apart = np.bitwise_count(_folded(words, begins[i[k]], a, to) ^ _folded(words, begins[j[k]], b, to)).sum(axis=1, dtype=np.int64)
            out[k] = apart <= (1 - threshold) / (1 + threshold) * (size[i[k]] + size[j[k]]) + 1e-6
    return out


def family_pairs(members: DataFrame, sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, pivot, lo, hi): the pairs of nodes (pivot, node, label) of one pivot and
    different labels whose ``sketched`` sizes and odd sketches allow a Jaccard
    index of ``threshold``. Two blocks of which too many pairs are left are one
    row without a and b: they are to be compared by their texts."""

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        pivot, lo, hi, block, node, label, size = (table[c].to_numpy() for c in ("pivot", "lo", "hi", "block", "node", "label", "size"))
        odd = table["odd"].combine_chunks()
        odd = pa.concat_arrays(odd.chunks) if isinstance(odd, pa.ChunkedArray) else odd
        words, begins = odd.values.to_numpy().view(np.uint64), odd.offsets.to_numpy().astype(np.int64)
        new = np.ones(len(pivot), dtype=bool)
        new[1:] = (pivot[1:] != pivot[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        starts = np.append(np.flatnonzero(new), len(pivot))
        held: list[tuple[np.ndarray, np.ndarray, int]] = []
        pairs = 0

        def told() -> pa.RecordBatch:
            i, j = (np.concatenate([h[x] for h in held] or [np.empty(0, np.int64)]) for x in (0, 1))
            group = np.repeat(np.array([h[2] for h in held], np.int64), [len(h[0]) for h in held])
            may = _sketches_allow(i, j, size, words, begins, threshold)
            i, j, group = i[may], j[may], group[may]
            many = np.bincount(group, minlength=len(starts) - 1) > _LEFT * np.diff(starts)
            few = ~many[group]
            i, j, whole = i[few], j[few], starts[:-1][many]
            none = pa.nulls(len(whole), pa.int64())
            a, b = (pa.concat_arrays([pa.array(f(node[i], node[j]), pa.int64()), none]) for f in (np.minimum, np.maximum))
            at = np.concatenate([i, whole])
            return pa.RecordBatch.from_arrays([a, b, *(pa.array(x[at], pa.int64()) for x in (pivot, lo, hi))], ["a", "b", "pivot", "lo", "hi"])

        for g, (s, e) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            same = lo[s] == hi[s]
            x, y = (np.arange(s, e),) * 2 if same else (s + np.flatnonzero(block[s:e] == lo[s]), s + np.flatnonzero(block[s:e] == hi[s]))
            near = label[x][:, None] != label[y]
            near &= np.minimum(size[x][:, None], size[y]) >= threshold * np.maximum(size[x][:, None], size[y]) - 1e-9
            if same:
                near &= node[x][:, None] < node[y]
            i, j = np.nonzero(near)
            if len(i):
                held.append((x[i], y[j], g))
                pairs += len(i)
            if pairs >= _PAIRS:
                yield told()
                held, pairs = [], 0
        yield told()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            last = np.ones(table.num_rows, dtype=bool)
            for c in ("pivot", "lo", "hi"):
                last &= table[c].to_numpy() == table[c][-1].as_py()
            cut = int(np.argmax(last))  # the last group may go on in the next batch
            if cut:
                yield from found(table.slice(0, cut).combine_chunks())
            held = table.slice(cut)
        if held is not None:
            yield from found(held.combine_chunks())

    group = ["pivot", "lo", "hi"]
    rows = blocked_families(members, sketched).repartition(*group).sortWithinPartitions(*group)
    return rows.mapInArrow(run, "a long, b long, pivot long, lo long, hi long")


def _texts_of(lines: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """(node, text) of ``nodes``, and by chance of a few more."""
    near = sieved(lines.select("node", F.col("line").alias("text")), "node", stage(nodes, name), f"{name}-sieve").where("__maybe")
    return stage(near.select("node", "text").dropDuplicates(["node"]), f"{name}-texts")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def line_links(lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) between different lines of (node, line, any others)."""
    score = partial(jaccard, threshold=threshold)
    with StageScope(lines.sparkSession) as scope:
        keyed = stage(signatures(lines), "lines-keys")
        # most keys have one line: they are told from the rest by 32 bits of it
        few = F.hash("node")
        parts = []
        for at in range(1, BANDS + 1, _BANDS_AT_ONCE):
            some = keyed.select("node", F.explode(F.slice("keys", at, _BANDS_AT_ONCE)).alias("key"))
            parts.append(stage(some.groupBy("key").agg(F.min(few).alias("lo"), F.max(few).alias("hi")).where("lo != hi").select("key"), "lines-shared"))
        shared = reduce(DataFrame.unionByName, parts)
        entries = keyed.select("node", "size", F.explode("keys").alias("key"))
        likely = sieved(entries, "key", shared, "lines-keysieve").where("__maybe").select("key", "node", "size").join(shared, "key", "left_semi")
        # lines of similar size share a class: [2^c, 2^(c+1)), and its upper neighbours
        c = F.floor(F.log2("size"))
        classes = F.when(F.col("size") >= F.pow(F.lit(2.0), c + 1) * threshold - 1e-9, F.array(c, c + 1)).otherwise(F.array(c))
        members = stage(likely.select("key", "node", F.explode(classes).alias("c")).select(F.xxhash64("key", "c").alias("key"), "node").distinct(), "lines-entries")
        scope.free(*parts)
        # what is known of a line without its text
        some = sieved(keyed.select("node", "size", "odd"), "node", members.select("node"), "lines-marksieve").where("__maybe")
        marks = stage(some.select("node", "size", "odd").dropDuplicates(["node"]), "lines-marks")
        scope.free(keyed)
        with StageScope(lines.sparkSession) as inner:
            pairs, crowded = bucket_pairs(members, name="lines")
            sizes = marks.select("node", "size")
            sized = pairs.join(sizes.toDF("a", "sa"), "a").join(sizes.toDF("b", "sb"), "b")
            pairs = inner.keep(sized.where(F.least("sa", "sb") >= threshold * F.greatest("sa", "sb") - 1e-9).select("a", "b"), "lines-pairs")
            crowded = inner.keep(crowded, "lines-crowds")
        scope.free(members)
        # most candidates are far apart: no text is fetched for what the sketches tell
        likely = stage(may_link(pairs, marks, threshold), "lines-likely")
        texts = _texts_of(lines, _nodes(likely), "lines-ends")
        links = stage(verify_pairs(likely, texts, shingle_sets, score), "lines-links")
        scope.free(pairs, likely, texts)
        members = stage(unsettled(crowded, connected_components(links, name="lines-star")), "lines-open")
        scope.free(crowded)
        found = stage(family_pairs(members, marks, threshold), "lines-families")
        scope.free(marks)
        close = stage(found.where("a is not null").select("a", "b").distinct(), "lines-close")
        whole = found.where("a is null").select("pivot", "lo", "hi")
        rest = members.join(whole.select("pivot").distinct(), "pivot", "left_semi").select("node")
        texts = _texts_of(lines, _nodes(close).unionByName(rest).distinct(), "lines-rest")
        more = verify_pairs(close, texts, shingle_sets, score).unionByName(
            compare_families(members, texts, shingle_sets, score, threshold, whole))
        return scope.keep(links.unionByName(more).select("a", "b").distinct(), "lines-all")


def duplicate_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, pos, class_id) of all line occurrences that go: those
    of lines with copies or near copies, but for the first of each class. A
    document is its id and text."""
    place = F.struct("doc_id", "text_hash", "pos")
    with StageScope(docs.sparkSession) as scope:
        lines = lines_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        comp = connected_components(line_links(lines, threshold), name="lines-cc")
        at = lines.select("node", F.xxhash64("line", F.lit(9)).alias("check"), "doc_id", "text_hash", "pos")
        firsts = stage(at.groupBy("node", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "lines-firsts")
        # two different lines under one node: neither takes part in links
        twins = firsts.groupBy("node").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("node")
        comp = comp.join(twins, "node", "left_anti")
        best = stage(firsts.join(comp, "node").groupBy("component").agg(F.min("first").alias("best")), "lines-best")
        fuzzy = firsts.join(comp, "node").join(best, "component").select("node", "check", F.col("component").alias("class_id"), "best")
        exact = firsts.where("n > 1").join(comp, "node", "left_anti").select("node", "check", F.col("node").alias("class_id"), F.col("first").alias("best"))
        classes = stage(fuzzy.unionByName(exact), "lines-classes")
        gone = at.join(classes, ["node", "check"]).where(~place.eqNullSafe(F.col("best"))).select("doc_id", "text_hash", "pos", "class_id")
        return scope.keep(gone, "lines-gone")


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``text`` freed of duplicate lines, and n_lines (before,
    blank ones included) and n_removed; columns of these names are replaced.

    Lines are parts of the text between \\n. Of each class of equal or similar
    lines the first occurrence stays (least doc_id, null first; then text hash
    and position). A document is known by its id and text: different texts under
    one id, or without one, are documents of their own; equal rows count as one
    and are treated alike. Lines without a
    word stay as they are. A null text stays null, with
    0 lines; a text may become empty. An empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*own)
    with StageScope(docs.sparkSession) as scope:
        gone = duplicate_lines(docs, threshold)
        lists = gone.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.collect_set("pos").alias("__gone"))
        lists = scope.keep(lists.withColumn("__at", F.xxhash64("__doc", "__hash")), "lines-lists")
    keyed = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")}).withColumn("__at", F.xxhash64("__doc", "__hash"))
    marked = sieved(keyed, "__at", lists.select("__at"), "lines-docs")
    # documents that lose nothing are not shuffled
    same = marked.where("not __maybe").select(*own, F.array().cast("array<int>").alias("__gone"))
    alike = (F.col("m.__at") == F.col("l.__at")) & F.col("m.__doc").eqNullSafe(F.col("l.__doc")) & (F.col("m.__hash") == F.col("l.__hash"))
    some = marked.where("__maybe").alias("m").join(lists.alias("l"), alike, "left").select(
        *[F.col(f"m.{c}").alias(c) for c in own], F.coalesce("__gone", F.array().cast("array<int>")).alias("__gone"))
    both = same.unionByName(some)
    fresh = F.expr("transform(array(split(text, '\\n', -1)), p -> array_join(transform(array_except(sequence(0, size(p) - 1), __gone), i -> p[i]), '\\n'))[0]")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return both.withColumns({
        "n_lines": n.cast("long"), "n_removed": F.size("__gone").cast("long"),
        "text": F.when(F.size("__gone") == 0, F.col("text")).otherwise(fresh),
    }).select(*own, "n_lines", "n_removed")


def op9_fuzzy_lines(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_lines", "n_removed", "text")
