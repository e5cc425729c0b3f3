"""Vectorised text primitives over Arrow string columns.

Words are the runs of ``[^\\x20\\x09-\\x0D]``; the UTF-8 bytes of a whole Arrow
batch are hashed at once with numpy, so there is no per-word Python. Memory is
bounded by ``SEGMENT`` bytes of text at a time plus eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        inverse = pow(int(_P), -1, 1 << 64)
        for base in (int(_P), inverse):
            p = np.full(SEGMENT + 1, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def doc_ranges(offsets: np.ndarray, max_bytes: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of documents of about ``max_bytes`` (one at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2^64."""
    if n <= SEGMENT:
        return _powers()
    out = []
    for base in (int(_P), pow(int(_P), -1, 1 << 64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def rolling(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of the k codes from each position on (fewer at the end)."""
    n = len(codes)
    power, inverse = _powers_for(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * power[:n], out=total[1:])
    ends = np.minimum(np.arange(n) + k, n)
    return (total[ends] - total[:n]) * inverse[:n]


def _segment_words(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one segment; ``breaks`` are
    positions where a word ends though no white space stands there."""
    space = _SPACE[raw]
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    last = word.copy()
    last[:-1] &= space[1:]
    if len(breaks):
        inner = breaks[(breaks > 0) & (breaks < len(raw))]
        first[inner] |= word[inner]
        last[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers_for(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    return starts, ends, mix(hashes ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, document number of every word), in text order."""
    hashes, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    lo, n = int(offsets[0]), int(offsets[-1])
    while lo < n:
        hi = min(lo + SEGMENT, n)
        if hi < n:  # cut behind white space or at a document's end
            near = np.flatnonzero(_SPACE[raw[lo:hi]])
            k = int(np.searchsorted(offsets, hi, side="right")) - 1
            cut = max(lo + int(near[-1]) + 1 if len(near) else lo, int(offsets[k]))
            if cut <= lo:  # a word longer than a segment: up to its end
                rest = np.flatnonzero(_SPACE[raw[hi:n]])
                cut = hi + int(rest[0]) if len(rest) else n
                cut = min(cut, int(offsets[min(k + 1, len(offsets) - 1)]))
            hi = cut
        a, b = np.searchsorted(offsets, [lo, hi])
        starts, _, h = _segment_words(raw[lo:hi], offsets[a : b + 1] - lo)
        hashes.append(h)
        docs.append(np.searchsorted(offsets, starts + lo, side="right") - 1)
        lo = hi
    return np.concatenate(hashes), np.concatenate(docs)


def shingles(words: np.ndarray, docs: np.ndarray, n_docs: int, k: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles and their offsets by document.

    A text of 1 to k-1 words is one shingle of all its words if ``short``,
    else none; a text without a word has none.
    """
    counts = np.bincount(docs, minlength=n_docs).astype(np.int64)
    if k > 1 and len(words):
        padded = np.concatenate([words, np.zeros(k - 1, np.uint64)])
        d = np.concatenate([docs, np.full(k - 1, -1, np.int64)])
        total = np.zeros(len(words), np.uint64)
        for j in range(k):
            factor = np.uint64(pow(int(_P), j + 1, 1 << 64))
            total += padded[j : j + len(words)] * factor * (d[j : j + len(words)] == docs)
        whole = d[k - 1 :] == docs
        if short:
            first = np.empty(len(docs), dtype=bool)
            first[0] = True
            first[1:] = docs[1:] != docs[:-1]
            whole |= first & (counts[docs] < k)
        total = mix(total)[whole]
    else:
        total = words
    per = np.maximum(counts - (k - 1), (counts > 0).astype(np.int64) if short else 0)
    return total, np.concatenate([[0], np.cumsum(per)])


def occurrence_labelled(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash combined with its running number among equal ones of its
    document, so that a document's labelled shingles are all different; and
    whether it is the first such."""
    if not len(hashes):
        return hashes, np.ones(0, dtype=bool)
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, docs))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    if new.all():
        return mix(hashes), new
    at = np.arange(len(h))
    run = at - np.maximum.accumulate(np.where(new, at, 0))
    label = np.empty(len(h), np.uint64)
    label[order] = run.astype(np.uint64)
    return mix(hashes + label * np.uint64(0xA0761D6478BD642F)), label == 0
