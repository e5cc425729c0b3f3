"""Operators 6 and 9 against brute force on the fixture corpus."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from renewlens.llm import buckets, fuzzy_lines, omh
from renewlens.llm.graph import connected_components
from renewlens.sources.store import stage
from tests.llm.conftest import prose


def _roots(n, links):
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in links:
        par[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def _sequence(text):
    w = text.encode().split()
    g = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))]
    seen: dict = {}
    return [(x, seen.setdefault(x, []).append(0) or len(seen[x])) for x in g]


def _ordered(a, b):
    """Longest common subsequence of the labelled shingles, as a similarity."""
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    m = int(t[-1, -1])
    return m / (len(a) + len(b) - m) if a and b else 0.0


def test_order_minhash_classes(docs, corpus):
    got = {r.doc_id: r for r in omh.near_duplicate_classes(docs).collect()}
    texts = [(i, t) for i, t in dict(corpus).items() if t is not None and len(t) < 20000]
    seqs = [_sequence(t) for _, t in texts]
    links = []
    for a, b in combinations(range(len(texts)), 2):
        if texts[a][1] == texts[b][1]:
            links.append((a, b))
        elif len(set(seqs[a]) & set(seqs[b])) > 20 and _ordered(seqs[a], seqs[b]) >= 0.8:
            links.append((a, b))
    roots = _roots(len(texts), links)
    least = {}
    for (i, _), r in zip(texts, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    assert {i: got[i].class_id for i, _ in texts} == {i: least[r] for (i, _), r in zip(texts, roots, strict=True)}
    assert got[300].class_id == 300 and got[301].class_id == 301  # null texts stand alone
    assert got[303].class_id == 302 and got[306].class_id == 305
    assert got[105].class_id == 3 and not got[105].kept


def test_keep_one(docs, corpus, empty):
    kept = omh.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(set(ids)) and 30 not in ids and 200 not in ids and {300, 301, 302} <= set(ids)
    assert omh.keep_one(empty).count() == 0 and omh.near_duplicate_classes(empty).count() == 0


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.permutation(40)[: rng.integers(20, 40)].astype(np.uint64)
        b = a.copy()
        for _ in range(rng.integers(0, 4)):
            i, j = rng.integers(0, len(b), 2)
            b[i], b[j] = b[j], b[i]
        s = _ordered(a.tolist(), b.tolist())
        assert abs(omh.aligned(a, b) - (s if s >= 0.8 else 0)) < 1e-12


def test_repeated_passages_are_near(spark):
    """Texts that differ in how often their body comes are one class."""
    bodies = [" ".join(prose(600 + i, 90)) for i in range(12)]
    rows = [(100 * n + i, " ".join([t] * n)) for i, t in enumerate(bodies) for n in (1, 2, 5, 8)]
    got = {r.doc_id: r.class_id for r in omh.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 100 + i % 100 for i, _ in rows}


def test_crowded_bucket_loses_no_link(spark):
    """One family in one bucket: stars and blocks find all its components."""
    base = prose(5, 80)
    texts = []
    for j in range(60):
        w = list(base)
        for e in range(j % 5):
            w[(7 * j + 13 * e) % 80] = f"x{j}_{e}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in omh.near_duplicate_classes(docs).collect()}
    seqs = [_sequence(t) for t in texts]
    roots = _roots(60, [(a, b) for a, b in combinations(range(60), 2) if _ordered(seqs[a], seqs[b]) >= 0.8])
    assert [got[i] for i in range(60)] == roots


def test_links_are_counted_whole(spark):
    """Families below and above the size of a crowded bucket, against brute force."""
    rows = []
    for f, n in enumerate((5, 9, 40)):
        base = prose(70 + f, 80)
        for j in range(n):
            w = list(base)
            for e in range(j % 3):
                w[(11 * j + 17 * e) % 80] = f"x{j}_{e}"
            rows.append((100 * f + j, " ".join(w)))
    seqs = {i: _sequence(t) for i, t in rows}
    # equal texts are one node: a row's links go to different texts
    text = dict(rows)
    want = {i: len({t for j, t in rows if t != text[i] and j // 100 == i // 100 and _ordered(seqs[i], seqs[j]) >= 0.8}) for i, _ in rows}
    got = {r.doc_id: r.n_links for r in omh.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and max(want.values()) > 10


def test_fuzzy_lines(docs, corpus):
    rows = sorted(set(corpus), key=lambda r: r[0])
    word = re.compile(r"[^\x20\x09-\x0D]")
    first: dict = {}
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if word.search(line):
                first.setdefault(line, (i, p))
    lines = list(first)
    sets = [{x[k : k + 5] for k in range(max(len(x) - 4, 1))} for x in lines]
    roots = _roots(len(lines), [(a, b) for a, b in combinations(range(len(lines)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    best: dict = {}
    for line, r in zip(lines, roots, strict=True):
        best[r] = min(best.get(r, first[line]), first[line])
    keep = {line: best[r] for line, r in zip(lines, roots, strict=True)}
    want = {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if keep.get(x, (i, p)) == (i, p)) for i, t in rows}
    out = fuzzy_lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    got = out.collect()
    assert len(got) == docs.count() and {r.doc_id: r.text for r in got} == want
    assert next(r.n_removed for r in got if r.doc_id == 308) == 39


def test_short_lines_take_part(spark):
    """Lines of any length that hold a word, against brute force."""
    word = re.compile(r"[^\x20\x09-\x0D]")
    menu = ["Home", "Menu", "x", "漢字の文章です。", "About the authors", "About the authors.", "  ", "", "12345678", "123456789"]
    rows = [(i, "\n".join([*menu[: 3 + i], " ".join(prose(i, 12)), menu[i % 4]])) for i in range(8)]
    first: dict = {}
    for i, t in rows:
        for p, line in enumerate(t.split("\n")):
            if word.search(line):
                first.setdefault(line, (i, p))
    lines = list(first)
    sets = [{x[k : k + 5] for k in range(max(len(x) - 4, 1))} for x in lines]
    roots = _roots(len(lines), [(a, b) for a, b in combinations(range(len(lines)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    best: dict = {}
    for line, r in zip(lines, roots, strict=True):
        best[r] = min(best.get(r, first[line]), first[line])
    keep = {line: best[r] for line, r in zip(lines, roots, strict=True)}
    want = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if keep.get(x, (i, p)) == (i, p)) for i, t in rows}
    got = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_removed == r.n_lines - len(r.text.split("\n")) for r in got) and sum(r.n_removed for r in got) > 30


def test_fuzzy_lines_empty(empty):
    assert fuzzy_lines.dedup_lines(empty).count() == 0


def test_sketches_leave_no_link_out(spark):
    """Pairs at the threshold pass, also between sketches of two lengths; far ones are told without their texts."""
    rng = random.Random(8)
    texts, near, far = [], [], []
    for size in (3, 9, 40, 60, 64, 70, 127, 130, 300, 520, 1400):
        for _ in range(12):
            x = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(size))
            cuts = [x[: size - size // 9] + "Z" * min(size // 9, 1), x + x[: size // 5][::-1], x[:-1] + "0", x[: size // 2] + x[: size // 2 - 1 : -1]]
            texts += [x, *cuts]
    sets = [{x[k : k + 5] for k in range(max(len(x) - 4, 1))} for x in texts]
    for i in range(0, len(texts), 5):
        for a, b in combinations(range(i, i + 5), 2):
            index = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if index >= 0.8:
                near.append((a, b))
            elif index < 0.6 and min(len(sets[a]), len(sets[b])) > 100:
                far.append((a, b))
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sketched = stage(fuzzy_lines.sketches(rows), "t")
    assert {r.node: r["size"] for r in sketched.collect()} == {i: len(x) for i, x in enumerate(sets)}
    wide = {r.node: len(r.odd) for r in sketched.collect()}
    assert sum(wide[a] != wide[b] for a, b in near) > 5 and len(far) > 100
    got = {tuple(r) for r in fuzzy_lines.may_link(spark.createDataFrame(near + far, "a long, b long"), sketched).collect()}
    assert set(near) <= got and len(got & set(far)) < len(far) / 20


def test_lines_alike_by_chance_rarely_meet():
    """Half-alike lines (an index near 0.3) are few among the pairs with a band in common."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(60)]
    x = [[rng.choice(words) for _ in range(24)] for _ in range(1500)]
    y = [line[:12] + [rng.choice(words) for _ in range(12)] for line in x]
    sets = [[{t[k : k + 5] for k in range(len(t) - 4)} for t in map(" ".join, z)] for z in (x, y)]
    assert 0.25 < np.mean([len(a & b) / len(a | b) for a, b in zip(*sets, strict=True)]) < 0.5
    kx, ky = (np.concatenate([fuzzy_lines.band_keys(i, o)[0] for _, _, i, o in fuzzy_lines.char_shingles(pa.array([" ".join(t) for t in z]))]) for z in (x, y))
    assert (kx == ky).any(axis=1).mean() < 0.25


def test_families_are_told_by_sketches(spark, monkeypatch):
    """Every near pair of different labels within a pivot is left, or its blocks are, also
    over batches, blocks and runs of pairs."""
    rng = random.Random(9)
    texts, members = [], []
    for f in range(7):
        base = "".join(rng.choice("abcdefghij  ") for _ in range(rng.choice((30, 70, 400))))
        for j in range(3 + 6 * f):
            at = rng.randrange(len(base))
            texts.append(base[:at] + "Z" * rng.choice((1, 1, len(base) // 3)) + base[at + 1 :])
            members += [(f % 5, len(texts) - 1, j % 4)] + [(90 + f, len(texts) - 1, j)] * (f % 2)
    sets = [{x[k : k + 5] for k in range(max(len(x) - 4, 1))} for x in texts]
    want = {(a, b) for (p, a, x), (q, b, y) in combinations(members, 2) if p == q and x != y and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sketched = stage(fuzzy_lines.sketches(rows), "t")
    table = spark.createDataFrame(members, "pivot long, node long, label long").repartition(3)
    score = fuzzy_lines.jaccard
    for left, pairs, words, block in ((1 << 20, 1 << 20, 1 << 21, 512), (1 << 20, 50, 64, 4), (1, 1 << 20, 1 << 21, 16), (0, 30, 1 << 21, 512)):
        monkeypatch.setattr(fuzzy_lines, "_LEFT", left)
        monkeypatch.setattr(fuzzy_lines, "_PAIRS", pairs)
        monkeypatch.setattr(fuzzy_lines, "_WORDS", words)
        monkeypatch.setattr(omh, "BLOCK", block)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
        try:
            found = stage(fuzzy_lines.family_pairs(table, sketched), "t")
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        close, whole = found.where("a is not null").select("a", "b"), found.where("a is null").select("pivot", "lo", "hi")
        got = {(r.a, r.b) for r in close.collect()}
        assert all(a < b for a, b in got) and whole.count() == whole.distinct().count()
        more = {(r.a, r.b) for r in omh.compare_families(table, rows, fuzzy_lines.shingle_sets, score, 0.8, whole).collect()}
        assert len(want) > 100 and want <= got | more and more <= want
        assert not whole.isEmpty() if left < 2 else not more
        assert left or not got


def test_texts_are_fetched_for_likely_pairs_only(spark, monkeypatch):
    """Lines that share a long passage meet in bands, but sketches tell them apart."""
    passage = " ".join(prose(5, 30))
    rows = [(i, f"{passage} " + " ".join(prose(500 + i, 60))) for i in range(40)] + [(100 + i, " ".join(prose(70, 40)) + f" {i}") for i in range(3)]
    lines = fuzzy_lines.lines_of(spark.createDataFrame(rows, "doc_id long, text string"))
    fetched = []
    real = fuzzy_lines._texts_of
    monkeypatch.setattr(fuzzy_lines, "_texts_of", lambda *a: fetched.append(real(*a)) or (fetched.append(fetched.pop().localCheckpoint()) or fetched[-1]))
    links = {(r.a, r.b) for r in fuzzy_lines.line_links(lines).collect()}
    near = {r.node for r in lines.where("doc_id >= 100").collect()}
    assert {x for p in links for x in p} == near
    assert {r.node for t in fetched for r in t.collect()} == near


def test_overlaps_of_any_block_size(monkeypatch):
    """Counted in runs of rows or all at once, against sets."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in [0, *rng.integers(1, 60, 40)]]
    a, b = sets[:25], sets[15:]
    want = [[len(x) > 0 and len(np.intersect1d(x, y)) >= 0.6 * len(np.union1d(x, y)) for y in b] for x in a]
    for hits in (1, 300, 1 << 20):
        monkeypatch.setattr(omh, "_HITS", hits)
        assert omh._overlaps(a, b, 0.6).tolist() == want


def test_char_shingles_count_code_points():
    (_, _, items, offsets), = fuzzy_lines.char_shingles(pa.array(["añb漢c😀d", "abc", "", None]))
    assert np.diff(offsets).tolist() == [3, 1, 0, 0] and len(items) == 4


def test_shingle_of_a_tiny_line_is_its_own():
    (_, _, items, _), = fuzzy_lines.char_shingles(pa.array(["ab", "cde", "abc", "def", "ab"]))
    assert items[0] == items[4] and len(set(items.tolist())) == 4


def test_lines_at_the_threshold_meet():
    """Single-character edits at an index of 0.8: all but a few in 10,000 share a band."""
    rng = random.Random(3)

    def keys(lines):
        return np.concatenate([fuzzy_lines.band_keys(i, o)[0] for _, _, i, o in fuzzy_lines.char_shingles(pa.array(lines))])

    for size, at in ((8, 8), (12, 12), (49, 20), (55, 20)):
        x = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(size)) for _ in range(4000)]
        y = [t[:at] + "0" + t[at + 1 :] for t in x]
        assert (keys(x) != keys(y)).all(axis=1).sum() <= 3, size


def test_documents_are_their_id_and_text(spark):
    """Null and repeated ids with different texts pool neither lines nor kept rows."""
    one, two = " ".join(prose(1, 12)), " ".join(prose(2, 12))
    own = [" ".join(prose(40 + i, 12)) for i in range(4)]
    rows = [(None, f"{one}\n{own[0]}"), (None, f"{one}\n{own[1]}"), (None, f"{own[2]}\n{two}"), (7, f"{two}\n{own[3]}"), (7, f"{own[3]}\n{one}")]
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    lines = [x for r in out for x in (r.text or "").split("\n") if x]
    assert len(out) == 5 and sorted(lines) == sorted([one, two, *own])
    base = prose(9, 80)
    near = [" ".join([*base[:at], "edit", *base[at + 1 :]]) for at in (0, 40, 79)]
    rest = [" ".join(prose(300 + i, 80)) for i in range(2)]
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (None, rest[0]), (None, None), (4, rest[1]), (4, rest[1] + " more"), (4, near[2][::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in omh.keep_one(docs).collect()]
    assert len(kept) == len(set(kept)) == 5 and {(None, rest[0]), (None, None), (4, near[2][::-1])} <= set(kept)
    assert sum(t in near for _, t in kept) == 1 and sum(t in (rest[1], rest[1] + " more") for _, t in kept) == 1


def test_sieve_never_misses(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    got = buckets.sieved(rows, "k", rows.where("k % 50 = 0"), "t").where("__maybe")
    assert got.where("k % 50 = 0").count() == 100 and got.count() < 150


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100 + i, 100) for i in range(1, 40)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert stage(spark.range(1).select(F.lit(1).alias("x")), "t").count() == 1
