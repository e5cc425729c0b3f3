"""Operators 3, 4 and 8: exact round trips and laws."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from renewlens.llm import bfd_pack, bm25_pack, range_shards, tokens


def _tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_those_of_tokenizers():
    texts = ["a", "", "  x\n\n y", "don't 12345 <|endoftext|> naïve 漢字   😀", "\t\r\n" * 5, "word " * 500]
    texts += ["a" + "".join(map(chr, range(i, i + 40))) + " 1" for i in (*range(0x80, 0x3000, 40), *range(0xA000, 0xD700, 400), *range(0xF900, 0xFFD0, 40))]
    texts += ["hello <|endoftext|> x", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|>\n"]
    fast, plain = tokens.encoder(special=True), _tokenizer()
    assert [list(x) for x in fast(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    plain.encode_special_tokens = True
    assert [list(x) for x in tokens.encoder()(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]


def test_packed_ids_hold_special_tokens(spark):
    docs = spark.createDataFrame([(1, "hello <|endoftext|> x")], "doc_id long, text string")
    (row,) = bfd_pack.pack(docs).collect()
    assert np.frombuffer(row.ids, "<u2")[: row.n_tokens].tolist() == [31373, 220, 50256, 2124, 0]


def _check(sequences, corpus, waste):
    t = _tokenizer()
    ids = [np.array(t.encode(x or "", add_special_tokens=False).ids + [0]) for _, x in corpus]
    seen, used = defaultdict(list), 0
    rows = sequences.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        row = np.frombuffer(r.ids, "<u2")
        assert len(row) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and not row[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1] and len(r.segments) == len(r.position_resets)
        used += r.n_tokens
        for s, o in zip(r.segments, r.position_resets, strict=True):
            part = row[o : o + s.length]
            assert zlib.crc32(part.astype("<u4").tobytes()) == s.ids_crc32
            seen[s.doc_id].append((s.start, part.tolist(), s.doc_tokens))
    want = defaultdict(list)
    for (i, _), x in zip(corpus, ids, strict=True):
        want[i].append(x.tolist())
    for i, parts in seen.items():
        copies = len(want[i])
        parts.sort(key=lambda p: p[0])
        assert all(p[2] == len(want[i][0]) for p in parts)
        if copies == 1:
            assert sum((p[1] for p in parts), []) == want[i][0]
        else:
            assert sum(len(p[1]) for p in parts) == sum(map(len, want[i]))
    assert set(seen) == set(want) and used == sum(map(len, ids))
    assert 1024 * len(rows) - used <= waste


def test_best_fit_decreasing_packs_every_id(docs, corpus, empty):
    _check(bfd_pack.pack(docs), corpus, 1024 * 4)
    assert bfd_pack.pack(empty).count() == 0


def test_best_fit_decreasing_fits_best():
    rng = np.random.default_rng(2)
    for _ in range(50):
        lengths = rng.integers(1, 101, 80).tolist()
        rooms, want = [], []
        for i in sorted(range(80), key=lambda i: (-lengths[i], i)):
            fit = [r for r in range(len(rooms)) if rooms[r] >= lengths[i]]
            if fit:
                r = min(fit, key=lambda r: rooms[r])
            else:
                r = len(rooms)
                rooms.append(100)
                want.append([])
            rooms[r] -= lengths[i]
            want[r].append(i)
        got = bfd_pack.best_fit_decreasing(lengths, 100)
        assert sorted(i for s in got for i in s) == list(range(80)) and all(sum(lengths[i] for i in s) <= 100 for s in got)
        assert len(got) == len(want) and sorted(sum(lengths[i] for i in s) for s in got) == sorted(100 - r for r in rooms)


def test_retrieval_packing_packs_every_id(docs, corpus, empty):
    _check(bm25_pack.retrieval_pack(docs), corpus, 1024)
    assert bm25_pack.retrieval_pack(empty).count() == 0
    pieces = bm25_pack.piece_digest(bm25_pack.retrieval_pack(docs))
    by = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("o"), F.max(F.col("offset") + F.col("length")).alias("z"))
    assert by.where("o != 0 or n != z or n > 1024").count() == 0


def test_neighbours_come_by_bm25_score():
    rng = np.random.default_rng(3)
    rests = [rng.integers(0, 60, n).astype(np.uint16) for n in rng.integers(20, 60, 40)]
    df = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=60)
    weight, mean = bm25_pack.idf(df, 40), float(np.mean([len(r) for r in rests]))
    vectors = [bm25_pack.weights(r, weight, mean) for r in rests]
    index = bm25_pack.Index(vectors, np.arange(40))
    for q in range(40):
        terms = set(vectors[q][0].tolist())
        want = [sum(w for t, w in zip(v[0].tolist(), v[1].tolist(), strict=True) if t in terms) for v in vectors]
        assert np.allclose(index.scores(vectors[q][0]), want, rtol=1e-4)
    windows = bm25_pack.fill_windows(rests, vectors, 100)
    assert all(sum(b - a for _, a, b in w) == 100 for w in windows[:-1])
    seed = windows[0][0][0]
    s = index.scores(vectors[seed][0])
    s[seed] = -1
    assert windows[0][1][0] == int(np.argmax(s))


def _brute(rests, k1=bm25_pack.K1, b=bm25_pack.B):
    """All BM25 scores (seed, rest) in doubles."""
    n, mean = len(rests), np.mean([len(r) for r in rests])
    size = max(int(r.max()) for r in rests) + 1
    tf = np.stack([np.bincount(r, minlength=size) for r in rests]).astype(float)
    df = (tf > 0).sum(0)
    idf = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))
    w = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * tf.sum(1, keepdims=True) / mean))
    out = (tf > 0).astype(float) @ w.T
    np.fill_diagonal(out, -1)
    return out, df, float(mean)


def _random_rests(n, vocabulary, seed):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, vocabulary + 1)
    return [rng.choice(vocabulary, m, p=p / p.sum()).astype("<u2") for m in rng.integers(1, 300, n)]


def test_neighbours_of_all_seeds_through_the_whole_index(spark, monkeypatch):
    """Recall of the ten best against all rests, over several blocks and shards."""
    rests = _random_rests(900, 700, 4)
    rests[5:9] = [rests[4]] * 4  # equal rests tie
    want, df, mean = _brute(rests)
    monkeypatch.setattr(bm25_pack, "SEED_BLOCK", 40)
    monkeypatch.setattr(bm25_pack, "INDEX_SHARD", 250)
    index = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rests)], "row long, ids binary").repartition(5)
    seeds = index.where("row % 7 = 0")
    got = {r.seed: r for r in bm25_pack.neighbours(seeds, index, df, 900, mean, k=10).collect()}
    hits = total = 0
    for i in range(0, 900, 7):
        best = np.sort(want[i])[::-1][:10]
        best = best[best > 0]
        found = got[i].hits if i in got else []
        assert len(found) == len(best) and i not in {h.rest for h in found}
        assert np.allclose([-h.neg for h in found], best, rtol=1e-4)
        assert all(abs(want[i][h.rest] + h.neg) < 1e-3 and h.length == len(rests[h.rest]) for h in found)
        hits += sum(want[i][h.rest] >= best[-1] - 1e-4 for h in found)
        total += len(best)
    assert total > 1000 and hits / total >= 0.99


def test_index_and_seeds_are_stored_once(spark, monkeypatch):
    """However many blocks and shards meet; a tie between shards falls to the lower row."""
    rests = _random_rests(500, 300, 7)
    rests[400:430] = [rests[3]] * 30
    _, df, mean = _brute(rests)
    monkeypatch.setattr(bm25_pack, "SEED_BLOCK", 30)
    monkeypatch.setattr(bm25_pack, "INDEX_SHARD", 40)
    tables = {}
    real = bm25_pack.stage
    monkeypatch.setattr(bm25_pack, "stage", lambda t, name: tables.setdefault(name, real(t, name).localCheckpoint()))
    index = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rests)], "row long, ids binary").orderBy(F.hash("row")).repartition(3)
    got = {r.seed: [h.rest for h in r.hits] for r in bm25_pack.neighbours(index.where("row % 5 = 0"), index, df, 500, mean, k=10).collect()}
    seeds, shards = (np.concatenate([np.frombuffer(r[0], "<i8") for r in tables[n].select(c).collect()]) for n, c in (("bm25-seeds", "q_row"), ("bm25-index", "x_row")))
    assert sorted(seeds) == [*range(0, 500, 5)] and sorted(shards) == [*range(500)]
    assert tables["bm25-seeds"].count() > 3 and tables["bm25-index"].count() > 12
    assert got[425] == [3, *range(400, 409)] and got[400] == [3, *range(401, 410)]


def test_tiles_in_chunks_and_batches(monkeypatch):
    rests = _random_rests(700, 500, 5)
    want, df, mean = _brute(rests)
    monkeypatch.setattr(bm25_pack, "_CHUNK", 256)
    monkeypatch.setattr(bm25_pack, "_BATCH", 9)
    terms, tf = zip(*(np.unique(r, return_counts=True) for r in rests), strict=True)
    tile = bm25_pack.Tile(df, 700, mean, 6)
    assert 0 < tile.width < (df > 0).sum()
    score, place = tile.best(list(terms[:50]), list(terms), list(tf), np.array([len(r) for r in rests]))
    np.fill_diagonal(want, 0)
    for i in range(50):
        own = place[i] != i
        np.testing.assert_allclose(score[i][own][:5], np.sort(want[i])[::-1][:5], rtol=1e-4)


def test_neighbours_are_taken_once_and_fit(spark):
    rng = np.random.default_rng(6)
    lists, room = [], {}
    for s in range(60):
        room[s] = int(rng.integers(0, 400))
        rests = rng.choice(80, 12, replace=False)
        hits = sorted((-float(rng.random()), int(r) + 1000, int(r) * 5 + 1) for r in rests)
        lists.append((s, 1024 - room[s], hits))
    df = spark.createDataFrame(lists, "seed long, seed_length long, hits array<struct<neg: float, rest: long, length: long>>")
    one, two = ([(r.strand, r.pos, r.rest) for r in bm25_pack.take_neighbours(df, 1024, n).collect()] for n in (1, 2))
    for got in (one, two):
        assert len({r for *_, r in got}) == len(got)
        for s in room:
            assert sum((r - 1000) * 5 + 1 for t, _, r in got if t == s) <= room[s]
    assert set(one) < set(two)
    best = {}  # of those it fits, a rest goes to the seed it scores best with
    for s, _, hits in lists:
        for neg, r, length in hits:
            if length <= room[s]:
                best[r] = min(best.get(r, (0.0, 0)), (neg, s))
    assert all(best[r][1] == s for s, _, r in one)


def test_shards(docs, corpus, empty, spark):
    rows = range_shards.shard(docs, shards=8).collect()
    assert len(rows) == len(corpus)
    per = defaultdict(list)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        per[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in per.values()) and set(per) <= set(range(8))
    assert range_shards.shard(empty).count() == 0
    hot = [(i, "hot text " * 20 if i % 3 else f"text {i} " * 25) for i in range(3000)]
    got = range_shards.shard(spark.createDataFrame(hot, "doc_id long, text string"), shards=10)
    sizes = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 10 and max(sizes) < 1.06 * min(sizes)


def test_shards_part_rows_that_are_alike(spark):
    """A third of all rows equal in text and id, others null in both; columns
    with the names of the results."""
    rows = [(7 if i % 3 == 0 else i, "same" if i % 3 == 0 else f"text {i}", 1, "x", 2) for i in range(6000)]
    rows += [(None, None, 1, "x", 2)] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, size int, shard string, slot int").repartition(7)
    keyed = df.select("doc_id", "text", F.lit(20).alias("__size"), F.xxhash64("text").alias("__k1"), F.xxhash64("doc_id").alias("__k2"))
    parted = range_shards._parted(keyed, 20 * 9000)
    assert parted.groupBy("__k1", "__k2").count().agg(F.max("count")).first()[0] <= 9000 / range_shards.RANGES
    got = range_shards.shard(df, shards=10)
    assert sorted(got.columns) == sorted(df.columns)
    per = got.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("z"), F.countDistinct("slot").alias("d")).collect()
    assert len(per) == 10 and sum(r.n for r in per) == 9000 and all(r.a == 0 and r.z == r.n - 1 == r.d - 1 for r in per)
    assert max(r.b for r in per) < 1.06 * min(r.b for r in per)
    assert sorted((r.doc_id or -1, r.text or "") for r in got.collect()) == sorted((r[0] or -1, r[1] or "") for r in rows)


def test_small_groups_of_equal_texts_stay_together(spark):
    rows = [(i, f"group {i % 900} " * 10) for i in range(4000)]
    got = range_shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=10)
    assert got.groupBy("text").agg(F.countDistinct("shard").alias("s")).where("s > 1").count() == 0
