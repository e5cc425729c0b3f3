"""Language identification by nearest centroid (operator 2).

A text's vector holds the TF-IDF weights of its hashed byte trigrams (letters
lower-cased, everything else one space), normalised. Per language several
centroids are clustered from a bounded sample of labelled texts (the ``SAMPLE``
different texts of least hash per language); document frequencies cover all
labelled texts. The nearest centroid by cosine gives the language; a text
clearly farther from it than almost all of the centroid's own members is
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renewlens.llm import textbatch as tb

DIMS = 4096
#: Different labelled texts per language that centroids are clustered from.
SAMPLE = 300
CENTROIDS = 4
#: A centroid keeps at least this share of its language's sample.
LEAST = 0.05
#: Quantile of the members' cosines that a centroid reaches, and the share of it
#: that a text must reach.
QUANTILE = 0.02
REACH = 0.8
_CHUNK = 128

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def counts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row + 1, counts of hashed trigrams) by ranges of rows."""
    raw, offsets = tb.utf8(pc.utf8_lower(column.cast(pa.large_string())))
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + tb.SEGMENT, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + _CHUNK)
        part = raw[offsets[lo] : offsets[hi]]
        off = offsets[lo : hi + 1] - offsets[lo]
        letter = _LETTER[part]
        # one space before each run of letters, also across the ends of texts
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        inner = off[1:-1]
        inner = inner[inner < len(part)]
        begins[inner] = letter[inner]
        at = np.flatnonzero(letter)
        docs = np.searchsorted(off, at, side="right") - 1
        first = begins[at]
        where = np.arange(len(at)) + np.cumsum(first)
        size = int(where[-1]) + 2 if len(at) else 0
        flat = np.full(size, 0x20, np.uint32)
        flat[where] = part[at]
        owner = np.zeros(size, np.int64)
        owner[where] = docs
        if size:
            owner[np.flatnonzero(flat == 0x20)[:-1]] = docs[first]
            owner[-1] = docs[-1]
        code = flat[:-2] << np.uint32(16) | flat[1:-1] << np.uint32(8) | flat[2:] if size > 2 else np.empty(0, np.uint32)
        dim = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        mid = flat[1:-1] != 0x20  # trigrams around a letter lie in one text
        c = np.bincount(owner[1:-1][mid] * DIMS + dim[mid], minlength=(hi - lo) * DIMS).reshape(hi - lo, DIMS)
        yield lo, hi, c
        lo = hi


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a row without trigrams is zero."""
    v = np.log1p(c.astype(np.float32)) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def cluster(v: np.ndarray, k: int = CENTROIDS, rounds: int = 12, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from k-means++ seeds: centroids, and for each the low
    quantile of its members' cosines. A centroid with too few members goes,
    smallest first, and its members join the others, so that a stray text never
    is a centroid by itself (unless the language has no other)."""
    rng = np.random.default_rng(1)
    seeds = [int(np.argmax(v @ v.mean(axis=0)))]
    while len(seeds) < min(k, len(v)):
        far = np.maximum(1 - (v @ v[seeds].T).max(axis=1), 0.0).astype(float) ** 2
        if far.max() < 1e-6:
            break
        seeds.append(int(rng.choice(len(v), p=far / far.sum())))
    c = v[seeds]
    while True:
        for _ in range(rounds):
            own = np.argmax(v @ c.T, axis=1)
            c = np.stack([v[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
            c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-12)
        cos = v @ c.T
        own = np.argmax(cos, axis=1)
        members = np.bincount(own, minlength=len(c))
        small = int(np.argmin(members))
        if len(c) == 1 or members[small] >= max(2, least * len(v)):
            break
        c = np.delete(c, small, axis=0)
    reach = np.array([np.quantile(cos[own == j, j], QUANTILE) for j in range(len(c))])
    return c.astype(np.float32), reach


class Model:
    """Languages, their centroids, the distances they reach, and the idf."""

    def __init__(self, langs: list[str], centroids: np.ndarray, reach: np.ndarray, idf: np.ndarray):
        self.langs, self.centroids, self.reach, self.idf = langs, centroids, reach, idf


def fit(labelled: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """A model of rows (doc_id, text, lang), all non-null."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for lo, hi, c in counts(batch.column("text")):
                df += (c > 0).sum(axis=0)
                n += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[n], df]))], ["dim", "df"])

    rows = labelled.select("text").mapInArrow(frequencies, "dim long, df long").groupBy("dim").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(DIMS + 1)
    for r in rows:
        df[r["dim"]] = r["df"]  # dim -1 is the number of texts
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 0.01).astype(np.float32)

    # copies are one text, whatever their ids: at most ``sample`` rows a language reach its group
    hashed = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    least = W.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    chosen = hashed.select("lang", "h").dropDuplicates().withColumn("r", F.row_number().over(least)).where(F.col("r") <= sample).select("lang", "h")
    texts = hashed.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text"))

    def clustered(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("text")
        v = np.concatenate([vectors(c, idf) for _, _, c in counts(pa.array(pdf["text"], pa.large_string()))])
        v = v[v.any(axis=1)]
        if not len(v):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        c, reach = cluster(v, k)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [x.tobytes() for x in c], "reach": reach})

    found = texts.select("text", "lang").groupBy("lang").applyInPandas(clustered, "lang string, centroid binary, reach double").collect()
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in found], np.float32).reshape(len(found), DIMS)
    return Model([r["lang"] for r in found], centroids, np.array([r["reach"] for r in found]), idf)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id with lang_pred, score (cosine, 0 to 1) and rejected.

    A null text or one without a letter is ``und`` with score 0, as is every
    text if nothing was learned. A text too far from all centroids keeps its
    nearest language in lang_pred but is marked rejected. Only the text is
    read; repeated rows are judged alike; an empty table gives an empty one.
    """
    langs = np.array([*model.langs, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, c in counts(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                best, score = np.full(hi - lo, -1), np.zeros(hi - lo)
                far = np.ones(hi - lo, dtype=bool)
                if len(model.langs):
                    cos = vectors(c, model.idf) @ model.centroids.T
                    best, score = cos.argmax(axis=1), cos.max(axis=1).astype(float)
                    far = score < REACH * model.reach[best]
                for i in np.flatnonzero(c[:, _ASCII].sum(axis=1) == 0).tolist():
                    text = part.column("text")[i].as_py()
                    if not text or not any(map(str.isalpha, text)):
                        best[i], score[i], far[i] = -1, 0.0, True
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(far)],
                    ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


#: Dimensions of the trigrams that begin an ASCII word: a text without any of
#: them may have no letter at all and is looked at character by character.
_ASCII = np.unique([
    ((0x200000 | a << 8 | b) * 2654435761 & 0xFFFFFFFF) >> 20 for a in range(97, 123) for b in (0x20, *range(97, 123))
])


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
