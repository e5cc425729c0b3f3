"""Removal of repeated byte strings by a hash-compared suffix sort (operator 13).

A byte goes when it lies in a string of ``length`` bytes that also starts
earlier (smaller document, or the same document further ahead). Only suffixes
that can be equal over ``length`` bytes have to be sorted together. Each window
of ``length`` bytes is put under its anchor, the first least hash among its
``GRAM``-byte parts: equal windows have the same anchor at the same offset.
Neighbouring windows with one anchor are a run, of 22 windows on average.

1. Runs are sorted by anchor and by the hash of their text. Of runs with equal
   text the earliest goes on, the others are removed whole; an anchor left with
   one run is done.
2. The texts of the other runs are cut out of the documents.
3. The suffixes of one anchor and offset are sorted by a mergesort that keeps
   only their first ``length`` bytes. Prefix polynomial hashes tell in one step
   whether two suffixes are equal so far, and by binary search how many bytes
   they share, so a comparison costs the logarithm of the length. Of equal
   suffixes the later one leaves the merge and its window is removed. Bytes are
   compared wherever a hash called two suffixes equal, and each two neighbours
   of the sorted rest are checked byte by byte: a hash collision cannot change
   the result, the suffixes concerned are sorted again by their bytes.

An anchor with more than ``CROWD`` different runs (a passage in very many
documents has some at its edges) is not sorted in one place: its windows are
taken one by one, by two hashes, in a plain aggregate that combines before it
shuffles.

Runs with equal anchor hashes and equal 64-bit text hashes in step 1, and
windows with equal 128-bit hashes in a crowd, count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb
from renewlens.llm.buckets import sieved
from renewlens.sources.store import stage

LENGTH = 100
GRAM = 32
#: Different runs of one anchor that are sorted in one task.
CROWD = 4096
#: Text that one sort holds, and that a scan looks at for runs to drop early.
SORT_BYTES = 4 << 20
SCAN_BYTES = 8 << 20
_STEP = 1 << 20
_AT = np.uint64((1 << 21) - 1)

_RUN = "key long, text long, doc_id long, hash long, place long"
_SPAN = "doc_id long, hash long, lo long, hi long"


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours, by block-wise running minima."""
    n = len(v)
    top = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, v.dtype)
    top[:n] = v
    blocks = top.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def runs(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor offset, key, text hash) of all runs."""
    out = [[] for _ in range(6)]
    n = len(raw)
    for lo in range(0, max(n - length + 1, 0), _STEP):
        part = raw[lo : lo + _STEP + length - 1].astype(np.uint64)
        grams = tb.mix(tb.rolling(part, gram)[: len(part) - gram + 1])
        low = sliding_min(grams & ~_AT | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & _AT
        doc = np.searchsorted(offsets, np.arange(lo, lo + len(low)), side="right") - 1
        whole = np.arange(lo, lo + len(low)) + length <= offsets[doc + 1]
        at = np.flatnonzero(whole)
        if not len(at):
            continue
        anchor, doc = low[at].astype(np.int64), doc[at]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(first)
        count = np.diff(np.append(head, len(at)))
        start, anchor = at[head], anchor[head]
        power, inverse = tb._powers_for(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * power[: len(part)], out=total[1:])
        text = (total[start + count + length - 1] - total[start]) * inverse[start]
        text = tb.mix(text ^ count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        for column, x in zip(out, (doc[head], start + lo - offsets[doc[head]], count, anchor - start, grams[anchor], text), strict=True):
            column.append(x)
    kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate([np.empty(0, k), *c]) for c, k in zip(out, kinds, strict=True))


def pack_place(start: np.ndarray, ahead: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Start, anchor offset and number of windows in one sortable number."""
    return start << 14 | ahead << 7 | count


def scan(docs: DataFrame, repeats: bool, length: int = LENGTH) -> DataFrame:
    """The runs of all texts, or, with ``repeats``, the spans of those whose
    text stands earlier in the same stretch of the scan; those are left out of
    the former, so a run that very many documents share is shuffled once per
    stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            raw, offsets = tb.utf8(table.column("text"))
            doc, start, count, ahead, key, text = runs(raw, offsets, length)
            ids = table.column("doc_id").combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            value, hashes = ids.fill_null(0).to_numpy(), table.column("hash").to_numpy()
            place = pack_place(start, ahead, count)
            order = np.lexsort((place, hashes[doc], value[doc], known[doc], text, key))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (text[order][1:] != text[order][:-1])
            pick = order[~new] if repeats else order[new]
            named = [ids.take(pa.array(doc[pick])), pa.array(hashes[doc[pick]])]
            if repeats:  # a row that comes twice is no repeat of itself
                head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))][~new]
                other = (known[doc[pick]] != known[doc[head]]) | (value[doc[pick]] != value[doc[head]]) | (hashes[doc[pick]] != hashes[doc[head]]) | (place[pick] != place[head])
                lo, hi = start[pick], start[pick] + count[pick] + length - 1
                return pa.RecordBatch.from_arrays([*named, pa.array(lo), pa.array(hi)], ["doc_id", "hash", "lo", "hi"]).filter(pa.array(other))
            return pa.RecordBatch.from_arrays([pa.array(key[pick].view(np.int64)), pa.array(text[pick].view(np.int64)), *named, pa.array(place[pick])],
                                              ["key", "text", "doc_id", "hash", "place"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SCAN_BYTES:
                yield found(held)
                held, size = [], 0
        if held:
            yield found(held)

    return docs.mapInArrow(run, _SPAN if repeats else _RUN)


def settle(sorted_runs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs sorted by key, text and place of occurrence, in a stream: ``lo`` and
    ``hi`` of a run whose text came before, null for the first of each text.
    Keys with a single text give only the former."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the first run of the last text, as a batch of one row
        kept = True  # whether it has been given out
        for batch in batches:
            if not batch.num_rows:
                continue
            if before is not None:
                batch = pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            key, text, place = (batch.column(c).to_numpy() for c in ("key", "text", "place"))
            ids, hashes = batch.column("doc_id"), batch.column("hash").to_numpy()
            known, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            n = len(key)
            new_key = np.ones(n, dtype=bool)
            new_key[1:] = key[1:] != key[:-1]
            new = new_key.copy()
            new[1:] |= text[1:] != text[:-1]
            head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            again = ~new & ((known != known[head]) | (value != value[head]) | (hashes != hashes[head]) | (place != place[head]))
            # a first run goes out when its key has another text; the last one may wait for the next batch
            at = np.flatnonzero(new)
            alone = np.ones(len(at), dtype=bool)
            alone[1:] &= key[at][1:] != key[at][:-1]
            alone[:-1] &= key[at][1:] != key[at][:-1]
            out = np.zeros(n, dtype=bool)
            out[at[~alone]] = True
            last = at[-1]
            if before is not None and kept:
                out[0] = False  # the row carried over
            before_kept = bool(out[last]) or (last == 0 and before is not None and kept)
            start, count = place >> 14, place & 127
            pick = np.flatnonzero(out | again)
            gone = again[pick]
            lo = pa.array(start[pick], mask=~gone)
            hi = pa.array((start + count + length - 1)[pick], mask=~gone)
            part = batch.take(pa.array(pick))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("key", "doc_id", "hash", "place")], lo, hi], ["key", "doc_id", "hash", "place", "lo", "hi"])
            before, kept = batch.slice(last, 1), before_kept

    return sorted_runs.mapInArrow(run, "key long, doc_id long, hash long, place long, lo long, hi long")


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number; raw ends in 8 extra bytes."""
    return np.lib.stride_tricks.as_strided(raw.view(np.uint8), (len(raw) - 7, 8), (1, 1)).copy().view("<u8").reshape(-1)


class Suffixes:
    """Suffixes of a text, compared over their first ``length`` bytes by prefix
    polynomial hashes."""

    def __init__(self, raw: np.ndarray, length: int):
        self.raw, self.length = np.concatenate([raw, np.zeros(length + 8, np.uint8)]), length
        wide = self.raw.astype(np.uint64) + np.uint64(1)
        power, self.inverse = tb._powers_for(len(wide))
        self.total = np.zeros(len(wide) + 1, np.uint64)
        np.cumsum(wide * power[: len(wide)], out=self.total[1:])
        n = len(raw)
        self.window = (self.total[length : n + length] - self.total[:n]) * self.inverse[:n]
        self.eight = _words(self.raw)

    def hashes(self, p: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.total[p + size] - self.total[p]) * self.inverse[p]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Bytes shared by suffixes that differ within ``length``, by binary search."""
        lo, hi = np.zeros(len(p), np.int64), np.full(len(p), self.length, np.int64)
        for _ in range(self.length.bit_length()):
            mid = (lo + hi) >> 1
            same = self.hashes(p, mid) == self.hashes(q, mid)
            lo = np.where(same, mid, lo)
            hi = np.where(same, hi, mid)
        return lo

    def compare(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at p is below, equal to or above that at q."""
        out = np.zeros(len(p), np.int8)
        differ = np.flatnonzero(self.window[p] != self.window[q])
        a, b = p[differ], q[differ]
        m = self.common(a, b)
        x, y = self.raw[a + m], self.raw[b + m]
        out[differ] = np.where(x < y, -1, 1)
        return out

    def same(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether ``length`` bytes are equal, by the bytes."""
        out = np.ones(len(p), dtype=bool)
        for j in [*range(0, self.length - 7, 8), self.length - 8]:
            out &= self.eight[p + j] == self.eight[q + j]
        return out

    def below(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the suffix at p is below that at q, by the bytes."""
        out, open_ = np.zeros(len(p), dtype=bool), np.arange(len(p))
        for j in [*range(0, self.length - 7, 8), self.length - 8]:
            x, y = self.eight[p[open_] + j].byteswap(), self.eight[q[open_] + j].byteswap()
            out[open_] = x < y
            open_ = open_[x == y]
            if not len(open_):
                break
        out[open_] = False
        return out


def repeated_suffixes(suffixes: Suffixes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether each suffix equals an earlier one of its group over ``length``
    bytes; ``group`` is sorted and the suffixes of a group come in the order in
    which they count as earlier. A mergesort over all groups at once."""
    gone = np.zeros(len(at), dtype=bool)
    suspect: list[np.ndarray] = []
    live = np.arange(len(at))  # suffixes of sorted runs, run after run
    run_of = np.arange(len(at))
    while len(live):
        heads = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]]))
        sizes = np.diff(np.append(heads, len(live)))
        g = group[live[heads]]
        number = np.arange(len(heads)) - np.maximum.accumulate(np.where(np.concatenate([[True], g[1:] != g[:-1]]), np.arange(len(heads)), 0))
        right = np.flatnonzero(number % 2 == 1)  # these merge into the run before
        if not len(right):
            break
        item_run = np.repeat(np.arange(len(heads)), sizes)
        is_right = (number % 2 == 1)[item_run]
        b = np.flatnonzero(is_right)
        left_run = item_run[b] - 1
        lo, hi = heads[left_run].copy(), heads[left_run] + sizes[left_run]
        equal = np.zeros(len(b), dtype=bool)
        todo = np.arange(len(b))
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            c = suffixes.compare(at[live[b[todo]]], at[live[mid]])
            lo[todo] = np.where(c > 0, mid + 1, lo[todo])
            hi[todo] = np.where(c > 0, hi[todo], mid)
            hit = c == 0
            equal[todo[hit]] = True
            lo[todo[hit]] = hi[todo[hit]] = mid[hit]
            todo = todo[lo[todo] < hi[todo]]
        twin = np.flatnonzero(equal)
        true = suffixes.same(at[live[b[twin]]], at[live[lo[twin]]])
        if not true.all():
            suspect.append(group[live[b[twin[~true]]]])
        gone[live[b[twin[true]]]] = True
        # a right item goes before the left item at lo; left items keep their place
        where = 2 * np.arange(len(live)) + 1
        where[b] = 2 * lo
        stay = np.ones(len(live), dtype=bool)
        stay[b[twin]] = False
        order = np.argsort(where, kind="stable")
        order = order[stay[order]]
        merged = item_run - is_right
        live, run_of = live[order], merged[order]
    # neighbours of what is left must rise strictly
    if len(live) > 1:
        p, q = live[:-1], live[1:]
        inner = group[p] == group[q]
        p, q = p[inner], q[inner]
        bad = ~suffixes.below(at[p], at[q])
        if bad.any():
            suspect.append(group[p[bad]])
    if suspect:  # hash collisions: these groups by their bytes
        for g in np.unique(np.concatenate(suspect)):
            seen = set()
            for i in np.flatnonzero(group == g):
                window = suffixes.raw[at[i] : at[i] + suffixes.length].tobytes()
                gone[i] = window in seen
                seen.add(window)
    return gone


def stretches(flag: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of set flags of one owner."""
    n = len(flag)
    begin = flag.copy()
    begin[1:] &= ~(flag[:-1] & (owner[1:] == owner[:-1]))
    end = flag.copy()
    end[:-1] &= ~(flag[1:] & (owner[1:] == owner[:-1])) if n else end[:-1]
    return np.flatnonzero(begin), np.flatnonzero(end)


def sort_runs(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans that go, of (key, doc_id, hash, place, cut) sorted by all but the
    last; the runs of a key come as one stretch of the stream."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        raw, offsets = _bytes(rows.column("cut"))
        key, place = rows.column("key").to_numpy(), rows.column("place").to_numpy()
        start, ahead, count = place >> 14, place >> 7 & 127, place & 127
        run = np.repeat(np.arange(len(key)), count)
        step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[:-1][run] + step
        _, number = np.unique(key, return_inverse=True)
        group = number[run] * 128 + (ahead[run] - step)  # the anchor's place in the window
        order = np.argsort(group, kind="stable")
        gone = np.zeros(len(run), dtype=bool)
        gone[order] = repeated_suffixes(Suffixes(raw, length), at[order], group[order])
        a, b = stretches(gone, run)
        ids = rows.column("doc_id").take(pa.array(run[a])).combine_chunks()
        hashes = rows.column("hash").take(pa.array(run[a])).combine_chunks()
        first = start[run[a]]
        return pa.RecordBatch.from_arrays([_one(ids, pa.int64()), _one(hashes, pa.int64()), pa.array(first + step[a]), pa.array(first + step[b] + length)], ["doc_id", "hash", "lo", "hi"])

    def distinct(table: pa.Table) -> pa.Table:
        """Without rows that repeat the one before (a document row that comes twice)."""
        same = np.ones(max(table.num_rows - 1, 0), dtype=bool)
        for c in ("key", "hash", "place", "doc_id"):
            x = table.column(c).fill_null(0).to_numpy()
            same &= x[1:] == x[:-1]
        known = table.column("doc_id").is_valid().to_numpy()
        same &= known[1:] == known[:-1]
        return table.filter(pa.array(np.concatenate([[True], ~same])[: table.num_rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < SORT_BYTES:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut_at = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if cut_at:
                yield spans(distinct(table.slice(0, cut_at)))
                table = table.slice(cut_at)
            held, size = table.combine_chunks().to_batches(), table.nbytes
        if held:
            yield spans(distinct(pa.Table.from_batches(held)))

    return cut.mapInArrow(run, _SPAN)


def _one(x: pa.ChunkedArray | pa.Array, kind: pa.DataType) -> pa.Array:
    if isinstance(x, pa.ChunkedArray):
        x = pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], kind)
    return x


def _bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls."""
    column = _one(column, pa.binary()).cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _with_lists(docs: DataFrame, lists: DataFrame, name: str, how: str) -> DataFrame:
    """docs (doc_id, hash, ...) with the columns of ``lists`` of the same
    document; documents that have none are not shuffled."""
    at = F.xxhash64("doc_id", "hash")
    lists = stage(lists.withColumn("__at", at), f"{name}-lists")
    marked = sieved(docs.withColumn("__at", at), "__at", lists.select("__at"), f"{name}-sieve")
    other = [c for c in lists.columns if c not in ("doc_id", "hash", "__at")]
    alike = (F.col("m.__at") == F.col("l.__at")) & F.col("m.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("m.hash") == F.col("l.hash"))
    some = marked.where("__maybe").alias("m").join(lists.alias("l"), alike, how)
    some = some.select(*[F.col(f"m.{c}").alias(c) for c in docs.columns], *[F.col(f"l.{c}").alias(c) for c in other])
    if how == "inner":
        return some
    rest = marked.where("not __maybe").select(*docs.columns, *[F.lit(None).cast(lists.schema[c].dataType).alias(c) for c in other])
    return rest.unionByName(some)


def repeated_spans(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """(doc_id, hash, spans): the maximal byte ranges that go, in order, of each
    document that loses any, of (doc_id, hash, text)."""
    if not 64 <= length <= 127:
        raise ValueError("length must be 64 to 127")
    ordered = ["key", "text", "doc_id", "hash", "place"]
    found = scan(docs, False, length).repartition("key").sortWithinPartitions(*ordered)
    found = stage(settle(found, length), "suffix-runs")
    several = found.where("lo is null").select("key", "doc_id", "hash", "place")
    crowds = stage(several.groupBy("key").count().where(F.col("count") > crowd).select("key"), "suffix-crowds")
    have_crowds = not crowds.isEmpty()
    few = several.join(crowds, "key", "left_anti") if have_crowds else several
    one = F.struct("key", "place")

    def cut(wanted: DataFrame, name: str) -> DataFrame:
        lists = wanted.groupBy("doc_id", "hash").agg(F.collect_list(one).alias("wanted"))
        rows = _with_lists(docs, lists, name, "inner").select("doc_id", "hash", F.encode("text", "UTF-8").alias("raw"), F.explode("wanted").alias("w"))
        size = F.expr(f"cast((w.place & 127) + {length - 1} AS int)")
        return rows.select("w.key", "doc_id", "hash", "w.place", F.substring("raw", F.expr("cast(shiftright(w.place, 14) AS int) + 1"), size).alias("cut"))

    texts = cut(few, "suffix-few").repartition("key").sortWithinPartitions("key", "doc_id", "hash", "place")
    spans = [found.where("lo is not null").select("doc_id", "hash", "lo", "hi"), scan(docs, True, length), sort_runs(texts, length)]
    if have_crowds:
        many = stage(cut(several.join(crowds, "key", "left_semi"), "suffix-crowd"), "suffix-crowd-texts")
        w = many.select("doc_id", "hash", F.expr("shiftright(place, 14)").alias("start"), F.col("cut"), F.expr("explode(sequence(0, cast(place & 127 AS int) - 1))").alias("i"))
        window = F.substring("cut", F.col("i") + 1, F.lit(length))
        w = stage(w.select("doc_id", "hash", (F.col("start") + F.col("i")).alias("lo"), F.xxhash64(window).alias("h1"), F.xxhash64(window, F.lit(1)).alias("h2")), "suffix-windows")
        place = F.struct("doc_id", "hash", "lo")
        firsts = w.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        later = w.join(firsts, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
        spans.append(later.select("doc_id", "hash", "lo", (F.col("lo") + length).alias("hi")))
    every = spans[0]
    for s in spans[1:]:
        every = every.unionByName(s)
    doc = Window.partitionBy("doc_id", "hash")
    before = doc.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("lo") > F.max("hi").over(before), F.lit(True)).cast("int")
    numbered = every.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(doc.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("doc_id", "hash", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy("doc_id", "hash").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes of the UTF-8 text) and
    ``spans`` (array of byte ranges [lo, hi) that went); columns of these names
    are replaced.

    A null text is empty. Documents are in the order of doc_id (null first),
    different texts of one doc_id in that of their hash; equal rows are one
    document and are treated alike. Texts of fewer than ``length`` bytes lose
    nothing. An empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in ("kept", "spans")]
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.struct(*own).alias("row"))
    packed = packed.withColumn("hash", F.xxhash64("text"))
    lists = repeated_spans(packed.select("doc_id", "hash", "text"), length)
    out = _with_lists(packed, lists, "suffix-spans", "left")
    edges = "concat(array(struct(0L AS lo, 0L AS hi)), spans, array(struct(cast(octet_length(text) AS long) AS lo, 0L AS hi)))"
    raw = "encode(text, 'UTF-8')"
    gaps = f"transform(slice({edges}, 2, size(spans) + 1), (x, i) -> hex(substring({raw}, cast({edges}[i].hi AS int) + 1, cast(x.lo - {edges}[i].hi AS int))))"
    kept = F.when(F.col("spans").isNull(), F.expr(raw)).otherwise(F.expr(f"unhex(array_join({gaps}, ''))"))
    return out.select("row.*", kept.alias("kept"), F.coalesce("spans", F.expr("cast(array() AS array<struct<lo: bigint, hi: bigint>>)")).alias("spans"))


def op13_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    gone = F.expr("aggregate(spans, 0L, (n, x) -> n + x.hi - x.lo)")
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n.alias("n_bytes"), gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
