"""Tokeniser-fertility quality rules (operator 5).

Public vocabularies measure each text: characters per token and the entropy of
its token distribution under a byte-level BPE, and the share of byte-fallback
pieces under a sentence-piece vocabulary. A document is kept if the measures
lie inside the rejection bands of its language (or, without one, its main
script): median -+ ``WIDTH`` robust deviations, taken over all documents that
pass the base rules. Entropy grows with length, so bands are per language and
length class (power of two of the token count); a class of under
``LEAST`` documents uses its whole language's band, and a language of under
``LEAST`` documents that of all documents.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewlens.llm import tokens
from renewlens.llm.buckets import sieved
from renewlens.sources.store import StageScope, stage

MIN_WORDS = 50
#: Robust deviations from the middle to the edge of each measure's band.
WIDTH = {"chars_per_token": 12.0, "entropy": 5.0, "byte_share": 8.0}
LEAST = 30
#: Least robust deviation of each measure.
FLOOR = {"chars_per_token": 0.04, "entropy": 0.15, "byte_share": 0.004}
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

_MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
    + [T.StructField(n, T.DoubleType()) for n in FLOOR]
    + [T.StructField("script", T.StringType())]
)
_M = "__fertility"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text.
    Words are runs of characters other than space and \\x09-\\x0D."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split on just these
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    repeated = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            end = 0  # first word not yet counted
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated


@lru_cache(maxsize=65536)
def _script(ch: str) -> str | None:
    return unicodedata.name(ch, "?").split(" ")[0].split("-")[0] if ch.isalpha() else None


def main_script(text: str) -> str:
    """The script most letters of the text are in (ties: the first by name)."""
    scripts: Counter[str] = Counter()
    for ch, n in Counter(text).items():
        if s := _script(ch):
            scripts[s] += n
    return min(scripts, key=lambda s: (-scripts[s], s)) if scripts else "NONE"


def entropy(ids: list[int]) -> float:
    """Shannon entropy in bits of a token distribution."""
    if not ids:
        return 0.0
    n = np.unique(np.array(ids, np.uint32), return_counts=True)[1] / len(ids)
    return float(-(n * np.log2(n)).sum())


def measured(docs: DataFrame, bpe: str = tokens.BPE, pieces: str = tokens.PIECES) -> DataFrame:
    """``docs`` with a struct column of the measures behind its columns."""
    schema = T.StructType([*docs.schema.fields, T.StructField(_M, _MEASURES)])
    has_lang = "lang" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, fallback = tokens.encoder(bpe), tokens.encoder(pieces)
        raw = np.array(sorted(tokens.byte_pieces(pieces)), np.int64)
        is_raw = np.zeros(int(raw.max(initial=0)) + 1, dtype=bool)
        is_raw[raw] = True
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = [x or "" for x in part.column("text").to_pylist()]
                langs = part.column("lang").to_pylist() if has_lang else [None] * len(texts)
                rows = []
                for text, lang, ids, ps in zip(texts, langs, encode(texts), fallback(texts), strict=True):
                    p = np.array(ps, np.int64)
                    share = float(is_raw[p[p < len(is_raw)]].sum() / len(p)) if len(p) else 0.0
                    m = (*base_counts(text), len(ids), len(text) / len(ids) if ids else 0.0, entropy(ids), share,
                         main_script(text) if lang is None else None)
                    rows.append(dict(zip(_MEASURES.names, m, strict=True)))
                kinds = [(f.name, pa.int64() if f.dataType == T.LongType() else pa.float64() if f.dataType == T.DoubleType() else pa.string()) for f in _MEASURES]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, pa.struct(kinds))], [*part.schema.names, _M])

    return docs.mapInArrow(run, schema)


#: Band levels, narrowest first: the keys a document's band is looked up by.
LEVELS = (("grp", "len_class"), ("grp",), ("everything",))


def _bin(c: str):
    return F.round(F.col(c), 4 if c == "byte_share" else 3)


def _bands(good: DataFrame, level: int) -> DataFrame:
    """Median and robust deviation of each measure by the level's keys. Binned
    measures bound the buffers of the exact medians. The result has a row per
    language and length class; it is written, so its size is known to the
    planner before anything is joined to it."""
    keys = LEVELS[level]
    mid = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.median(_bin(c)).alias(f"mid_{c}") for c in FLOOR])
    mid = stage(mid, f"fertility-mid-{level}")
    off = good.join(mid, list(keys)).select(*keys, *[F.abs(_bin(c) - F.col(f"mid_{c}")).alias(c) for c in FLOOR])
    dev = off.groupBy(*keys).agg(*[F.greatest(1.4826 * F.median(_bin(c)), F.lit(f)).alias(f"dev_{c}") for c, f in FLOOR.items()])
    out = mid if keys == LEVELS[-1] else mid.where(F.col("n") >= LEAST)
    names = [f"{x}_{c}" for x in ("mid", "dev") for c in FLOOR]
    return stage(out.join(dev, list(keys)).select(*keys, *[F.col(x).alias(f"{x}_{level}") for x in names]), f"fertility-bands-{level}")


def judged(rows: DataFrame, width: dict[str, float] = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """Measured rows (flat measure columns, ``grp``) with base_failed, the
    distance z_* of each measure from its band's middle, and kept."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.withColumns({
        "base_failed": base,
        "len_class": F.floor(F.log2(F.greatest("n_tokens", F.lit(1)).cast("double"))).cast("int"),
        "everything": F.lit(1),
    })
    good = out.where("not base_failed").dropDuplicates(["key"])
    for level, keys in enumerate(LEVELS):
        out = out.join(_bands(good, level), list(keys), "left")
    for c in FLOOR:
        mid, dev = (F.coalesce(*[F.col(f"{x}_{c}_{level}") for level in range(len(LEVELS))]) for x in ("mid", "dev"))
        out = out.withColumn(f"z_{c}", F.round((F.col(c) - mid) / dev, 6))
    inside = (
        (F.abs("z_chars_per_token") <= width["chars_per_token"]) & (F.col("z_entropy") >= -width["entropy"])
        & (F.col("z_byte_share") <= width["byte_share"])
    )
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def _flat(m: DataFrame) -> DataFrame:
    lang = F.concat(F.lit("lang:"), F.col("lang")) if "lang" in m.columns else F.lit(None).cast("string")
    return m.select("doc_id", F.xxhash64("text").alias("key"), F.coalesce(lang, F.concat(F.lit("script:"), F.col(f"{_M}.script"))).alias("grp"), f"{_M}.*")


def quality(docs: DataFrame, width: dict[str, float] = WIDTH) -> DataFrame:
    """One row per document: doc_id, the base counts, the measures, base_failed
    and kept.

    A null text counts as empty and fails the base rules; so does any text of
    under 50 words. A null lang falls to the text's script. Repeated rows are
    judged alike. Other columns are ignored; an empty table gives an empty one.
    """
    src = docs.select("doc_id", "text", *[c for c in ("lang",) if c in docs.columns])
    rows = stage(_flat(measured(src)), "fertility")
    return judged(rows, width).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "grp", "n_tokens", *FLOOR, *[f"z_{c}" for c in FLOOR])


def keep_good(docs: DataFrame, width: dict[str, float] = WIDTH) -> DataFrame:
    """The kept rows of ``docs``, with its own columns; of rows that repeat id and
    text all stay if one is kept.

    Only measures are stored. ``docs`` is read again, and rows that look like none of
    those to drop are not shuffled."""
    with StageScope(docs.sparkSession) as scope:
        src = docs.select("doc_id", "text", *[c for c in ("lang",) if c in docs.columns])
        verdict = judged(stage(_flat(measured(src)), "fertility"), width).groupBy("doc_id", "key").agg(F.max("kept").alias("kept"))
        drop = verdict.where("not kept").select(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), F.xxhash64("doc_id", "key").alias("__at"))
        drop = scope.keep(drop, "fertility-drop")
    key = F.xxhash64("text")
    marked = sieved(docs.withColumn("__at", F.xxhash64("doc_id", key)), "__at", drop.select("__at"), "fertility-sieve")
    same = (marked["__at"] == drop["__at"]) & marked["doc_id"].eqNullSafe(drop["__d"]) & (F.xxhash64(marked["text"]) == drop["__k"])
    return marked.where("not __maybe").select(*docs.columns).unionByName(
        marked.where("__maybe").join(drop, same, "left_anti").select(*docs.columns))


def op5_tokenizer_fertility(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
