"""Best-fit-decreasing packing into token-id matrices (operator 3).

Documents are tokenised, ended by an id, and cut losslessly into full windows
and a rest. The rests of a bounded block of documents are packed best fit
decreasing: longest first, each into the open sequence whose free room is the
least that holds it, found by a segment tree over the capacities in
O(log capacity). Blocks are parts of scan partitions, so nothing is shuffled
and a lost executor only repeats its own tasks; a block's memory is bounded by
``BLOCK_TOKENS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import tokens

CAPACITY = 1024
#: Ids held by one packing block.
BLOCK_TOKENS = 4_000_000
#: Sequences written in one matrix row group.
_ROWS = 256

SEQUENCES = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "segments array<struct<doc_id: long, start: long, length: long, doc_tokens: long, ids_crc32: long>>"
)
#: How ids are stored; "<u4" for vocabularies of over 65,536 ids.
ID_TYPE = "<u2"


class FreeRoom:
    """Open sequences by free room; a segment tree tells which rooms exist."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        i = self.base + room
        while i:
            self.tree[i] += n
            i >>= 1

    def put(self, sequence: int, room: int) -> None:
        if room:
            self.at[room].append(sequence)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(sequence, its room) of the least room of at least ``need``."""
        i, tree = self.base + need, self.tree
        if not tree[i]:
            while i > 1 and (i & 1 or not tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.base
        self._add(room, -1)
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of item numbers; every length is 1 to capacity."""
    rooms, out = FreeRoom(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[item])
        if found is None:
            found = len(out), capacity
            out.append([])
        out[found[0]].append(item)
        rooms.put(found[0], found[1] - lengths[item])
    return out


def pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the cuts of a document of n ids."""
    return [(s, min(capacity, n - s)) for s in range(0, n, capacity)]


def sequence_batch(rows: list[tuple[int, list[tuple]]], capacity: int, pad: int, id_type: str = ID_TYPE) -> pa.RecordBatch:
    """Sequences (id, [(doc_id, start, ids, doc_tokens), ...]) as a batch: one
    little-endian matrix row each, padded to the capacity, with the cumulative
    segment lengths and the offsets at which positions restart. A segment's
    crc32 is that of its ids as 32-bit numbers."""
    segs = [seg for _, part in rows for seg in part]
    per = np.array([len(part) for _, part in rows], np.int64)
    lens = np.array([len(seg[2]) for seg in segs], np.int64)
    first = np.concatenate([[0], np.cumsum(per)])
    ends = np.cumsum(lens)
    row_of = np.repeat(np.arange(len(rows)), per)
    row_begin = np.concatenate([[0], ends])[first[:-1]] if len(rows) else np.empty(0, np.int64)
    resets = ends - lens - row_begin[row_of] if len(rows) else np.empty(0, np.int64)
    matrix = np.full((len(rows), capacity), pad, id_type)
    for row, at, seg in zip(row_of.tolist(), resets.tolist(), segs, strict=True):
        matrix[row, at : at + len(seg[2])] = seg[2]
    width = matrix.dtype.itemsize * capacity
    ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(matrix)])
    total = np.bincount(row_of, lens, minlength=len(rows)).astype(np.int32)
    cu = np.insert(resets, first[1:], total)
    lists = pa.array(first, pa.int32())
    segments = pa.StructArray.from_arrays(
        [pa.array([seg[0] for seg in segs], pa.int64()), pa.array([seg[1] for seg in segs], pa.int64()), pa.array(lens),
         pa.array([seg[3] for seg in segs], pa.int64()), pa.array([zlib.crc32(seg[2].astype("<u4")) for seg in segs], pa.int64())],
        ["doc_id", "start", "length", "doc_tokens", "ids_crc32"])
    return pa.RecordBatch.from_arrays(
        [pa.array([sid for sid, _ in rows], pa.int64()), pa.array(total), ids,
         pa.ListArray.from_arrays(pa.array(first + np.arange(len(first)), pa.int32()), pa.array(cu, pa.int32())),
         pa.ListArray.from_arrays(lists, pa.array(resets, pa.int32())), pa.ListArray.from_arrays(lists, segments)],
        ["sequence_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "segments"])


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = tokens.BPE, end: int = 0, pad: int = 0,
         block_tokens: int = BLOCK_TOKENS, id_type: str = ID_TYPE) -> DataFrame:
    """Packed sequences of all ``docs`` (doc_id, text; other columns ignored).

    A null or empty text is its end id alone; repeated rows are packed as often
    as they come; a null doc_id stays null in its segments. An empty table
    gives an empty table. Sequence ids are unique, numbered by task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def emit(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lo in range(0, len(groups), _ROWS):
                part = groups[lo : lo + _ROWS]
                yield sequence_batch([(number + i, g) for i, g in enumerate(part)], capacity, pad, id_type)
                number += len(part)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            packed = best_fit_decreasing([len(h[2]) for h in held], capacity)
            yield from emit([[held[i] for i in g] for g in packed])
            held, size = [], 0

        for part, ids in tokens.documents(batches, vocabulary, end):
            full = []
            for doc_id, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                for start, length in pieces(len(x), capacity):
                    seg = (doc_id, start, x[start : start + length], len(x))
                    if length == capacity:
                        full.append([seg])
                    else:
                        held.append(seg)
                        size += length
            yield from emit(full)
            if size >= block_tokens:
                yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SEQUENCES)


def write(sequences: DataFrame, path: str) -> None:
    """Parquet parts of packed rows: ids matrix rows, cu_seqlens, resets."""
    sequences.write.mode("overwrite").parquet(path)


def op3_bfd_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
