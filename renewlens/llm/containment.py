"""Benchmark decontamination by size-partitioned MinHash containment search
(operator 10).

Test items are partitioned by their number of 5-word shingles. For a partition
of items of up to B shingles a document is a run of overlapping windows of
1.25 B shingles, one every B / 4, so that wherever an item stands some window
holds it whole, and the Jaccard index of a contained item and its window has a
lower bound however long the document is. The bound gives the number of hash
functions at which a contained item is missed with probability ``MISS``; an
item and a window with an equal minimum under one of them are a candidate, and
candidates are verified by the exact containment of the item's shingles in
those of the whole document.

An item can only meet a window in a shingle that is one of the item's minima,
so documents that hold none of these need no signature.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb
from renewlens.sources.store import stage

SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-6
#: Sizes of neighbouring partitions.
GROWTH = math.sqrt(2)
#: Item characters that one search holds; more items are searched in blocks.
BLOCK_CHARS = 32_000_000
_TABLE = 20


class Partition:
    """Items of similar size with their minima under ``m`` hash functions."""

    def __init__(self, top: int, items: dict[int, np.ndarray], threshold: float):
        self.step = max(1, math.ceil(top / 4))
        self.blocks = math.ceil(top / self.step) + 1  # steps per window
        low = max(1, math.floor(top / GROWTH))
        jaccard = threshold * low / (self.blocks * self.step + (1 - threshold) * top)
        self.m = max(1, math.ceil(math.log(MISS) / math.log1p(-min(jaccard, 0.999))))
        rng = np.random.default_rng(top)
        self.salt = rng.integers(0, 2**63, self.m).astype(np.uint64)
        self.odd = rng.integers(0, 2**63, self.m).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.minima: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(self.m)]
        least = []
        for q, s in items.items():
            for j in range(self.m):
                h = (s ^ self.salt[j]) * self.odd[j]
                at = int(np.argmin(h))
                self.minima[j][int(h[at])].append(q)
                least.append(s[at])
        self.shingles = np.unique(np.array(least, np.uint64))

    def candidates(self, doc: np.ndarray) -> set[int]:
        found: set[int] = set()
        begins = np.arange(0, len(doc), self.step)
        for j in range(self.m):
            low = np.minimum.reduceat((doc ^ self.salt[j]) * self.odd[j], begins)
            window = low.copy()
            for b in range(1, min(self.blocks, len(low))):
                window[:-b] = np.minimum(window[:-b], low[b:])
            for v in set(window.tolist()) & self.minima[j].keys():
                found.update(self.minima[j][v])
        return found


class Search:
    """The partitions of a block of items."""

    def __init__(self, texts: list[str | None], k: int = SHINGLE, threshold: float = THRESHOLD):
        self.k, self.threshold = k, threshold
        raw, offsets = tb.utf8(pa.array(texts, pa.large_string()))
        words, docs = tb.word_hashes(raw, offsets)
        s, so = tb.shingles(words, docs, len(texts), k)
        self.items = [np.unique(s[a:b]) for a, b in zip(so[:-1], so[1:], strict=True)]
        spans = np.diff(so)
        groups: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        for q, span in enumerate(spans.tolist()):
            if span:
                groups[math.ceil(GROWTH ** math.ceil(math.log(span, GROWTH) - 1e-9))][q] = self.items[q]
        self.partitions = [Partition(top, g, threshold) for top, g in sorted(groups.items())]
        self.every = np.unique(np.concatenate([p.shingles for p in self.partitions] or [np.empty(0, np.uint64)]))
        self.table = np.zeros(1 << _TABLE, dtype=bool)
        self.table[self.every >> np.uint64(64 - _TABLE)] = True

    def _hits(self, s: np.ndarray) -> np.ndarray:
        """Positions of shingles that are a minimum of some item."""
        hits = np.flatnonzero(self.table[s >> np.uint64(64 - _TABLE)])
        if not len(hits):
            return hits
        at = np.minimum(np.searchsorted(self.every, s[hits]), len(self.every) - 1)
        return hits[self.every[at] == s[hits]]

    def documents(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(row, [(item, shared, size), ...]) of the rows that contain items."""
        raw, offsets = tb.utf8(column)
        for lo, hi in tb.doc_ranges(offsets):
            words, docs = tb.word_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            s, so = tb.shingles(words, docs, hi - lo, self.k)
            for row in np.unique(np.searchsorted(so, self._hits(s), side="right") - 1).tolist():
                doc = s[so[row] : so[row + 1]]
                found: set[int] = set()
                for p in self.partitions:
                    if np.isin(p.shingles, doc).any():
                        found |= p.candidates(doc)
                kept = []
                for q in sorted(found):
                    shared = int(np.isin(self.items[q], doc).sum())
                    if shared >= self.threshold * len(self.items[q]) - 1e-9:
                        kept.append((q, shared, len(self.items[q])))
                if kept:
                    yield lo + row, kept


def _blocks(items: DataFrame, k: int, threshold: float) -> Iterator[tuple[Search, list, bool]]:
    """The items in blocks of bounded text, one after another, and whether
    others follow or came before: the driver holds one block at a time, as
    long as what is made with it is written before the next is asked for."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(chars / BLOCK_CHARS))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield Search([r["text"] for r in rows], k, threshold), [r["item_id"] for r in rows], n > 1


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, n_shared, n_item (distinct shingles) and containment of
    every item of which a document holds at least ``threshold``.

    Null texts and texts without a word hold and match nothing. A text of
    under five words is one shingle of all its words. Repeated documents and
    items give a row each; other columns are ignored; empty tables give an
    empty table.
    """
    out = None
    for search, ids, several in _blocks(items, k, threshold):

        def run(batches: Iterator[pa.RecordBatch], search: Search = search, ids: list = ids) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, ids[q], shared, n) for i, found in search.documents(batch.column("text")) for q, shared, n in found]
                at, item, shared, n = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at)), pa.array(item), pa.array(shared), pa.array(n), pa.array(shared / np.maximum(n, 1))],
                    ["doc_id", "item_id", "n_shared", "n_item", "containment"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, item_id long, n_shared long, n_item long, containment double")
        part = stage(part, "containment-block") if several else part
        out = part if out is None else out.unionByName(part)
    return out


def without_contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """``docs`` without the documents that contain an item, columns as they
    came; nothing is shuffled. Items in several blocks cost a pass over the
    documents each, the later ones over those that are left."""
    for search, _, several in _blocks(items, k, threshold):

        def run(batches: Iterator[pa.RecordBatch], search: Search = search) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[i for i, _ in search.documents(batch.column("text"))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        docs = stage(docs, "containment-left") if several else docs
    return docs


def op10_containment(spark, sf_dir: str) -> DataFrame:
    return contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
OP10_SQL = rf"""
WITH shingled AS (
  SELECT 'doc' AS side, doc_id AS id, {_WORDS} AS w FROM documents
  UNION ALL
  SELECT 'item', item_id, {_WORDS} FROM benchmark
), grams AS (
  SELECT DISTINCT side, id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' ')) END) AS g
  FROM shingled
), sizes AS (
  SELECT id, count(*) AS n FROM grams WHERE side = 'item' GROUP BY id
), shared AS (
  SELECT d.id AS doc_id, q.id AS item_id, count(*) AS n_shared
  FROM grams d JOIN grams q ON d.g = q.g AND d.side = 'doc' AND q.side = 'item'
  GROUP BY d.id, q.id
)
SELECT doc_id, item_id, n_shared, n AS n_item, n_shared::DOUBLE / n AS containment
FROM shared JOIN sizes ON sizes.id = item_id
WHERE n_shared >= {THRESHOLD} * n - 1e-9
"""
