"""Operators 11, 12 and 13 against brute force and in their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from renewlens.llm import nra_search, suffix_dedup, turn_trie
from renewlens.llm.turn_trie import Node, RadixTree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- operator 11 ---------------------------------------------------------

def brute_trie(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members, kids = defaultdict(list), defaultdict(set)
    for c, s in convs.items():
        for i in range(len(s) + 1):
            members[tuple(s[:i])].append(c)
            if i:
                kids[tuple(s[: i - 1])].add(tuple(s[:i]))
    saved, leaves, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        ends = ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(turns) -> dict[int, list[tuple[str, str]]]:
    convs = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, s in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + s[h:]
    return out


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, words int").repartition(3)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    rows = []
    for c in range(60):
        first = rng.choice(["hello there", "hi", "hot first turn of many"])
        rows.append((c, 0, "user", first))
        for t in range(1, rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 2)))))
    for c in range(100, 130):  # one conversation, many times
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "again  same\t")]
    rows += [(200, None, None, None), (200, 3, "user", None), (200, 3, "user", None), (201, 1, None, "no role"), (None, 1, "user", "no conversation")]
    rows += [(300, t, "user", f"turn {t}") for t in range(700)]  # a very long conversation
    return rows


@pytest.mark.parametrize("parts", ["1", "7"])
def test_trie_equals_brute_force(spark, turns, parts):
    """In one range and in several, whose boundaries cut through nodes."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turn_trie.prefix_trie(turn_trie.rebuilt(turn_trie.turn_ids(turns_frame(spark, turns)))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(rebuilt(ordered(turns)))


def test_trie_of_plain_conversations_and_turnless(spark, turns):
    """The operator without the rebuilding; a conversation may have no turn."""
    convs = turn_trie.turn_ids(turns_frame(spark, turns)).unionByName(
        spark.sql("SELECT 999L AS conv_id, cast(array() AS array<struct<id: string, words: int>>) AS turns"))
    got = sorted((tuple(r) for r in turn_trie.prefix_trie(convs).collect()), key=str)
    assert got == brute_trie(ordered(turns) | {999: []})


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_trie.prefix_trie(turn_trie.rebuilt(turn_trie.turn_ids(empty))).count() == 0


def test_node_layouts_grow():
    node, sizes = Node(b""), []
    for byte in range(255, -1, -1):
        node.put(byte, Node(bytes([byte])))
        sizes.append(node.size)
    assert sorted(set(sizes)) == [4, 16, 48, 256]
    assert [k.path[0] for k in node.ordered()] == list(range(256))
    assert all(node.find(b).path == bytes([b]) for b in range(256))


def test_radix_tree_paths():
    tree = RadixTree()
    keys = [b"abcdef", b"abcxyz", b"ab", b"", b"abcd", b"q"]
    for i, k in enumerate(keys):
        tree.insert(k, i)
    found, todo = {}, [(tree.root, b"")]
    while todo:
        node, at = todo.pop()
        at += node.path
        if node.row >= 0:
            found[at] = node.row
        for byte in range(256):
            kid = node.find(byte)
            if kid is not None:
                todo.append((kid, at + bytes([byte])))
    assert found == {k: i for i, k in enumerate(keys)}


def test_digest_of_many_ends(spark):
    """Streamed chunks and one array give the same digest."""
    rows = spark.range(10_000).select(F.lit("k").alias("k"), (F.col("id") * 7 - 300).alias("conv_id"), F.lit(10_000).alias("n"))
    want = hashlib.sha256(",".join(str(i * 7 - 300) for i in range(10_000)).encode()).hexdigest()
    assert [r.ends for r in turn_trie.ends_digests(rows).collect()] == [want]
    assert [r.ends for r in turn_trie.ends_digests(rows, few=20_000).collect()] == [want]


# --- operator 12 ---------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute_search(docs, items, k=20):
    bags = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, size = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        asked = Counter(TERM.findall((text or "").translate(FOLD)))
        scored = []
        for i, b, length in bags:
            m = 75 + (25 * length * n) // size
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, c in asked.items() if t in b)
            if s > 0:
                scored.append((-s, i is not None, i or 0))
        for rank, (s, known, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i if known else None, -s))
    return sorted(out, key=str)


def search_rows(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, terms string").repartition(2)
    return sorted((tuple(r) for r in nra_search.search(d, q, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def library():
    rng = random.Random(11)
    words = ["The", "of", "Ärger", "naïve", "x9", "zwei", "漢字", "rare", "a", "b", "c", "dd"]
    docs = [(i, rng.choice(["; ", " ", "\n"]).join(rng.choice(words[: rng.randint(2, 12)]) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "... --- !"), (None, "rare rare words"), (None, "the"), (5, docs[5][1]), docs[6], docs[6]]
    docs += [(500 + i, "tie tie tie") for i in range(30)]  # more ties than places
    docs.append((600, "rare " + "filler " * 300_000))  # over a megabyte
    docs.append((601, "q" * 1_200_000))  # one term over a megabyte
    items = [(0, "the rare OF naïve"), (1, "tie"), (2, None), (3, "..."), (4, "unknown words"), (None, "x9 zwei zwei zwei"), (6, "漢字 ärger Ärger"), (0, "the rare OF naïve"), (0, "dd c")]
    return docs, items


def test_search_equals_brute_force(spark, library):
    assert search_rows(spark, *library) == brute_search(*library)
    assert search_rows(spark, *library, k=3) == brute_search(*library, k=3)


def test_search_in_small_blocks(spark, library, monkeypatch):
    """Several index blocks a task and several query blocks."""
    monkeypatch.setattr(nra_search.index, "__defaults__", (16, 1 << 16))
    monkeypatch.setattr(nra_search, "BLOCK_ITEMS", 2)
    assert search_rows(spark, *library) == brute_search(*library)


def test_search_of_nothing(spark, library):
    docs, items = library
    assert search_rows(spark, [], items) == []
    assert search_rows(spark, docs, []) == []


def test_nra_stops_early_and_is_exact():
    rng = np.random.default_rng(3)
    n, lists, total = 4000, [], np.zeros(4000, np.int64)
    for t in range(12):
        docs = rng.choice(n, rng.integers(50, 3000), replace=False)
        x = np.sort((rng.pareto(1.2, len(docs)) * 1000).astype(np.int64) + 1)[::-1]
        lists.append((docs, x))
        total[docs] += x
    docs, scores = nra_search.nra(lists, n, k=20, first=16)
    assert (total[docs] == scores).all()
    assert set(np.flatnonzero(total >= np.sort(total)[-20])) <= set(docs)

    class Reads(np.ndarray):
        most = 0

        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop:
                Reads.most = max(Reads.most, at.stop)
            return np.asarray(super().__getitem__(at))

    # one document leads by far in every list: the tails are never read
    docs = [np.arange(n) for _ in range(3)]
    x = np.concatenate([[10**9] * 20, np.arange(n - 20, 0, -1)])
    nra_search.nra([(d, x.view(Reads)) for d in docs], n, k=20, first=16)
    assert Reads.most < n / 4


def test_terms_with_one_hash_are_told_apart():
    raw = np.frombuffer(b"ab cd ab", np.uint8)
    starts, ends = np.array([0, 3, 6]), np.array([2, 5, 8])
    terms, number, doc, tf = nra_search.term_counts(raw, starts, ends, np.zeros(3, np.uint64), np.zeros(3, np.int64))
    assert {terms[t]: int(c) for t, c in zip(number, tf, strict=True)} == {b"ab": 2, b"cd": 1}


# --- operator 13 ---------------------------------------------------------

def brute_repeats(rows, length=100):
    """(id, bytes, removed, spans, digest) of the different rows."""
    seen, out = set(), []
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        b = t.encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ÄÖ漢") for _ in range(n))
    shared = [text(150) for _ in range(4)]
    rows = [(i, text(rng.randint(0, 60)) + rng.choice(shared) + text(rng.randint(0, 200)) + rng.choice(shared)[: rng.randint(50, 150)]) for i in range(60)]
    rows += [(100, "a" * 400), (101, "ab" * 130), (102, "a" * 99), (103, "a" * 100), (104, "line again and again\n" * 30), (105, None), (106, ""), (107, "x")]
    rows += [(200 + i, rows[3][1]) for i in range(12)]  # copies
    rows += [(300 + i, rows[4][1][:90] + str(i) + rows[4][1][90:]) for i in range(12)]  # near copies
    rows.append((400, text(40_000) + shared[0] + text(500)))
    rows += [rows[5], rows[5], (None, text(300)), (None, "z" * 250)]
    return rows


def suffix_rows(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, hash int, spans string").repartition(3)
    out = suffix_dedup.remove_repeats(df, **kw)
    assert out.columns == ["doc_id", "text", "hash", "kept", "spans"]
    got = out.collect()
    assert len(got) == len(rows)
    return sorted({(r.doc_id, len((r.text or "").encode()), sum(s.hi - s.lo for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got}, key=str)


def test_suffix_dedup_equals_brute_force(spark, passages):
    assert suffix_rows(spark, passages) == brute_repeats(passages)


def test_suffix_dedup_of_crowded_anchors(spark, passages, monkeypatch):
    """Anchors with more runs than one sort takes go window by window."""
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (100, 3))
    assert suffix_rows(spark, passages) == brute_repeats(passages)


def test_suffix_dedup_in_small_steps(spark, passages, monkeypatch):
    """Texts cut into several scan steps; several sorts and stretches a task."""
    monkeypatch.setattr(suffix_dedup, "_STEP", 1000)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 2000)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert suffix_rows(spark, passages) == brute_repeats(passages)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_suffix_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("broken", ["window", "total"])
def test_hash_collisions_change_nothing(broken):
    """With hashes that say equal too often, bytes decide."""
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 4000).astype(np.uint8)
    raw[2000:2600] = raw[100:700]
    at = np.arange(0, 3900)
    group = np.sort(rng.integers(0, 3, len(at)))
    s = suffix_dedup.Suffixes(raw, 100)
    if broken == "window":
        s.window = s.window % np.uint64(5)
    else:
        s.hashes = lambda p, size: size.astype(np.uint64)
    gone = suffix_dedup.repeated_suffixes(s, at, group)
    seen, want = set(), []
    for p, g in zip(at, group, strict=True):
        w = (int(g), raw[p : p + 100].tobytes())
        want.append(w in seen)
        seen.add(w)
    assert gone.tolist() == want


def test_sliding_min():
    v = np.random.default_rng(0).integers(0, 1000, 333).astype(np.uint64)
    for w in (1, 5, 69, 333):
        assert (suffix_dedup.sliding_min(v, w) == np.lib.stride_tricks.sliding_window_view(v, w).min(axis=1)).all()
