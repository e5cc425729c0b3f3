"""Ranked lexical search by NRA (operator 12).

Documents become an inverted index in blocks of up to ``BLOCK_DOCS`` documents
that holds the terms of the query items only: a bitmap of fixed size with a
bit for every query term decides what is kept, so nothing that grows goes to
the tasks. Document counts, lengths and document frequencies are summed over
all blocks first, so a score is the same in whatever block a document lies.

Within a block every term's postings are read in falling order of impact. A
document's interval runs from the sum of what was read (lower) to that plus,
for each list it was not met in, the impact last read there (upper). Lists are
read on while they can matter: until no document outside the K best can reach
them, and then only those in which a document that is still in the running was
not met, until every such interval has closed. The block's K best per item
are merged by score and doc_id, so the result is the exact K best of all.

Query items come in blocks too; every document block meets every query block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb
from renewlens.sources.store import stage

K = 20
#: Documents and bytes of text of an index block.
BLOCK_DOCS = 8192
BLOCK_BYTES = 64 << 20
#: Bits of the bitmap of query terms (512 KB).
SIEVE_BITS = 1 << 22
#: Items of a query block.
BLOCK_ITEMS = 256
#: Postings of each list read in the first round; later rounds read twice as many.
FIRST_READ = 128

_TERM = np.ones(256, dtype=bool)
_TERM[:128] = [chr(c).isalnum() for c in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INDEX = "doc_ids array<long>, lengths array<long>, n_terms long, n_docs long, terms array<string>, starts array<int>, posts array<int>, tfs array<int>"


def terms_of(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, hashes) of the terms of lower-cased texts, a megabyte at a
    time; no term spans two texts, none is cut."""
    term = _TERM[raw]
    lo, n = int(offsets[0]), int(offsets[-1])
    while lo < n:
        hi = min(lo + tb.SEGMENT, n)
        if hi < n:  # cut at a separator or a document's end
            gap = np.flatnonzero(~term[lo:hi])
            k = int(np.searchsorted(offsets, hi, side="right")) - 1
            cut = max(lo + int(gap[-1]) + 1 if len(gap) else lo, int(offsets[k]))
            if cut <= lo:
                rest = np.flatnonzero(~term[hi:n])
                cut = min(hi + int(rest[0]) if len(rest) else n, int(offsets[min(k + 1, len(offsets) - 1)]))
            hi = cut
        inside = term[lo:hi]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        breaks = offsets[(offsets > lo) & (offsets < hi)] - lo
        first[breaks] |= inside[breaks]
        last[breaks - 1] |= inside[breaks - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = prefix_hashes(raw[lo:hi], starts, ends)
        yield starts + lo, ends + lo, h
        lo = hi


def prefix_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, by prefix polynomials."""
    power, inverse = tb._powers_for(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    return tb.mix((total[ends] - total[starts]) * inverse[starts] ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def term_counts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, docs: np.ndarray
                ) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(terms, term number, document, count) of term occurrences. Occurrences
    of one hash are compared with the first of them byte by byte."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    head = first[number]
    lens = ends - starts
    off = lens != lens[head]
    inner = ~off
    off[inner] = ~equal_ranges(raw, starts[inner], starts[head[inner]], lens[inner])
    terms = [raw[starts[i] : ends[i]].tobytes() for i in first]
    if off.any():  # two terms with one hash
        names = {t: i for i, t in enumerate(terms)}
        for i in np.flatnonzero(off):
            t = raw[starts[i] : ends[i]].tobytes()
            number[i] = names.setdefault(t, len(names))
        terms = list(names)
    key = number.astype(np.int64) * (int(docs[-1]) + 1 if len(docs) else 1) + docs
    key, tf = np.unique(key, return_counts=True)
    top = int(docs[-1]) + 1 if len(docs) else 1
    return terms, key // top, key % top, tf


def equal_ranges(raw: np.ndarray, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether the byte ranges at a and b of the same lengths are equal."""
    same = np.ones(len(a), dtype=bool)
    on, at = np.arange(len(a)), 0
    while len(on):
        on = on[lens[on] > at]
        differ = raw[a[on] + at] != raw[b[on] + at]
        same[on[differ]] = False
        on = on[~differ]
        at += 1
    return same


def query_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, times, hash): the terms of each different
    (item_id, text) row; one without a term gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tb.utf8(batch.column("text"))
            raw = _LOWER[raw]
            for starts, ends, h in terms_of(raw, offsets):
                row = np.searchsorted(offsets, starts, side="right") - 1
                found = [raw[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(row)), batch.column("item_id").take(pa.array(row)), pa.array(found, pa.string()), pa.array(h.view(np.int64))],
                    ["item", "item_id", "term", "hash"])

    rows = items.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    found = rows.mapInArrow(run, "item long, item_id long, term string, hash long")
    return found.groupBy("item", "item_id", "term", "hash").agg(F.count(F.lit(1)).alias("times"))


def bitmap(hashes: DataFrame, bits: int = SIEVE_BITS) -> np.ndarray:
    """Of a column ``hash`` of longs; as large for any input."""
    at = F.pmod("hash", F.lit(bits))
    rows = hashes.select(F.floor(at / 32768).cast("int").alias("row"), F.pmod(at, F.lit(32768)).alias("bit"))
    found = rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most bits / 32768 rows
    out = np.zeros((bits // 32768, 4096), np.uint8)
    for row, part in found:
        out[row] = np.frombuffer(part, np.uint8)
    return np.unpackbits(out.reshape(-1), bitorder="little").astype(bool)


def index(docs: DataFrame, wanted: np.ndarray, block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of an inverted index over the ``wanted`` term hashes."""
    sieve = np.packbits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.unpackbits(sieve).astype(bool)
        held: list[pa.RecordBatch] = []
        n = size = 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            raw, offsets = tb.utf8(table.column("text"))
            raw = _LOWER[raw]
            lengths = np.zeros(table.num_rows, np.int64)
            found = [[np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]]
            for starts, ends, h in terms_of(raw, offsets):
                lengths += np.bincount(np.searchsorted(offsets, starts, side="right") - 1, minlength=table.num_rows)
                hit = keep[h & np.uint64(len(keep) - 1)]
                found.append([starts[hit], ends[hit], h[hit]])
            starts, ends, h = (np.concatenate(x) for x in zip(*found, strict=True))
            doc = np.searchsorted(offsets, starts, side="right") - 1
            terms, number, post, tf = term_counts(raw, starts, ends, h, doc)
            used, post = np.unique(post, return_inverse=True)  # documents that hold a term
            begin = np.searchsorted(number, np.arange(len(terms) + 1))
            one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
            ids = pa.array(table.column("doc_id").take(pa.array(used)).to_pylist(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [one(ids, pa.int64()), one(lengths[used], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), pa.array([int((lengths > 0).sum())], pa.int64()),
                 one([t.decode() for t in terms], pa.string()), one(begin, pa.int32()), one(post, pa.int32()), one(tf, pa.int32())],
                [c.split()[0] for c in _INDEX.split(", ")])

        for batch in batches:
            lo = 0
            ends = tb.utf8(batch.column("text"))[1][1:]
            while lo < batch.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = int(np.searchsorted(ends, before + block_bytes - size, side="right"))
                hi = min(max(hi, lo + 1), lo + block_docs - n, batch.num_rows)
                held.append(batch.slice(lo, hi - lo))
                n, size, lo = n + hi - lo, size + int(ends[hi - 1]) - before, hi
                if n >= block_docs or size >= block_bytes:
                    yield block(held)
                    held, n, size = [], 0, 0
        if held:
            yield block(held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _INDEX)


def impacts(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 75 + (25 * lengths * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int = K, first: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray]:
    """(documents, exact scores) of at least the k best of 0..n-1, with all that
    tie with the k-th; ``lists`` are (documents, impacts) by falling impact.

    Only sequential reads. After each round a list's bound is the impact last
    read there, 0 once it is at its end.
    """
    exact = sum(int(x[0]) for _, x in lists if len(x)) < 1 << 53  # sums in doubles are exact
    kind = np.float64 if exact else np.int64
    lower = np.zeros(n, np.int64)
    unseen = np.ones((len(lists), n), kind)
    bound = np.array([x[0] if len(x) else 0 for _, x in lists], kind)
    at = [0] * len(lists)
    step, active = first, [t for t, (_, x) in enumerate(lists) if len(x)]
    while True:
        for t in active:
            docs, x = lists[t]
            end = min(at[t] + step, len(x))
            part = docs[at[t] : end]
            lower[part] += x[at[t] : end]
            unseen[t, part] = 0
            at[t] = end
            bound[t] = x[end - 1] if end < len(x) else 0
        step *= 2
        upper = lower + (bound @ unseen).astype(np.int64)
        least = int(np.partition(lower, n - k)[n - k]) if n > k else 0
        running = np.flatnonzero((upper >= least) & (upper > 0))
        open_ = running[upper[running] > lower[running]]
        if not len(open_):
            return running, lower[running]
        missing = unseen[:, open_].any(axis=1) if len(open_) < 4 * k else np.ones(len(lists), dtype=bool)
        active = [t for t in range(len(lists)) if at[t] < len(lists[t][1]) and missing[t]]


def search_blocks(pairs: DataFrame, k: int = K) -> DataFrame:
    """(item, item_id, doc_id, score): the k best of each index block for each
    item of a query block; rows hold a block of either kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r]  # noqa: B023, E731
                ids = get("doc_ids").as_py()
                if not ids:
                    continue
                lengths, starts, posts, tfs = (get(c).values.to_numpy().astype(np.int64) for c in ("lengths", "starts", "posts", "tfs"))
                where = {t: i for i, t in enumerate(get("terms").as_py())}
                plain = impacts(tfs, lengths[posts], get("all_docs").as_py(), get("all_terms").as_py())
                term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                order = np.lexsort((posts, -plain, term))
                posts, plain = posts[order], plain[order]
                rank = [i for _, i in sorted(((v is not None, v or 0), i) for i, v in enumerate(ids))]
                place = np.empty(len(ids), np.int64)
                place[rank] = np.arange(len(ids))
                rows = []
                for one in get("items").as_py():
                    lists = []
                    for t, w in zip(one["terms"], one["weights"], strict=True):
                        i = where.get(t)
                        if i is not None and w:
                            x = plain[starts[i] : starts[i + 1]] * w
                            lists.append((posts[starts[i] : starts[i + 1]], x))
                    if not lists:
                        continue
                    docs, scores = nra(lists, len(ids), k)
                    best = np.lexsort((place[docs], -scores))[:k]
                    rows += [(one["item"], one["item_id"], ids[docs[i]], int(scores[i])) for i in best if scores[i] > 0]
                cols = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item", "item_id", "doc_id", "score"])

    return pairs.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for
    each of ``items`` (item_id, text), by score and then doc_id (null first).

    Every row of docs is a document, equal rows too; null and empty texts have
    no term and are never found. Different texts of one item_id are items of
    their own, equal rows are one. Other columns are ignored. An item without a
    hit gives no row, an empty table on either side none at all.
    """
    asked = stage(query_terms(items), "search-items")
    blocks = stage(index(docs, bitmap(asked)), "search-index")
    held = blocks.select(F.explode(F.expr(
        "transform(terms, (t, i) -> struct(t AS term, cast(starts[i + 1] - starts[i] AS long) AS df))")).alias("x")).select("x.*")
    df = held.groupBy("term").agg(F.sum("df").alias("df"))
    total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("all_docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("all_terms")).first()
    weight = F.floor(1000 * F.log((2 * F.lit(total[0]) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    terms = asked.join(df, "term").withColumn("weight", weight * F.col("times"))
    one = terms.groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
    one = one.select("item", F.struct("item", "item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")).alias("one"))
    many = max(1, -(-asked.select("item").distinct().count() // BLOCK_ITEMS))
    queries = stage(one.groupBy(F.pmod("item", F.lit(many)).alias("q")).agg(F.collect_list("one").alias("items")).select("items"), "search-queries")
    pairs = blocks.select("doc_ids", "lengths", "terms", "starts", "posts", "tfs", F.lit(total[0]).alias("all_docs"), F.lit(total[1]).alias("all_terms")).crossJoin(queries)
    best = Window.partitionBy("item", "item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = search_blocks(pairs, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op12_nra_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH occurrences AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_FOLD_SQL}, '{_TERM_SQL}') AS terms FROM documents WHERE text IS NOT NULL
), lens AS (
  SELECT doc, doc_id, len(terms)::BIGINT AS n FROM occurrences WHERE len(terms) > 0
), tfs AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM occurrences) GROUP BY ALL
), stats AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lens
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, stats GROUP BY term, n_docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all({_FOLD_SQL}, '{_TERM_SQL}')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), scores AS (
  SELECT a.item_id, l.doc, l.doc_id,
    sum(a.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * l.n * s.n_docs) // s.n_terms))))::BIGINT AS score
  FROM asked a JOIN weights w USING (term) JOIN tfs t USING (term) JOIN lens l USING (doc), stats s GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM scores WHERE score > 0
) WHERE rank <= 20
"""
