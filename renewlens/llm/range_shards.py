"""Sharding by sampled splitters (operator 8).

Records are ordered by a key: the hash of their text, so equal texts are
neighbours, then a hash of the id. A size-weighted sample of keys (a bounded
number, whatever the input) gives quantile boundaries; records are
range-partitioned by them, and a range holding more than its share is cut into
equal slices of key space until it does not. Exact byte and row counts of the
ranges, carried on over the ranges, place every record in the whole order, and
shard k takes the k-th equal part of all bytes.

A group of equal texts no larger than ``WHOLE`` of a shard stays in one shard;
a larger group is cut record by record, so that sizes stay near equal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renewlens.sources.store import stage

SHARDS = 40
#: Ranges cut by the sampled splitters, and sampled keys per range.
RANGES = 320
KEYS_PER_RANGE = 64
#: Bytes beyond which a range is cut again, if its share of the input is more.
RANGE_BYTES = 1 << 30
#: Share of a shard up to which a group of equal texts stays whole.
WHOLE = 0.05
#: Size of a record besides its text.
OVERHEAD = 16


def _parted(keyed: DataFrame, total: int) -> DataFrame:
    """``keyed`` with rows that no key can part made partable: where the rows of
    one (k1, k2) hold more than a range, k2 becomes a hash of the row's place.
    Such a table is written once first, so that a place never changes; there are
    fewer than RANGES such keys, and without any nothing is written."""
    hot = keyed.groupBy("__k1", "__k2").agg(F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n"))
    hot = stage(hot.where((F.col("b") > total / RANGES) & (F.col("n") > 1)).select("__k1", "__k2", F.lit(True).alias("__hot")), "shard-alike")
    if hot.isEmpty():
        return keyed
    marked = keyed.join(F.broadcast(hot), ["__k1", "__k2"], "left")
    place = F.xxhash64("__k2", F.monotonically_increasing_id())
    return stage(marked.withColumn("__k2", F.when(F.col("__hot"), place).otherwise(F.col("__k2"))).drop("__hot"), "shard-keyed")


def _splitters(keyed: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantile boundaries (k1, k2) of a size-weighted sample of keys, at most
    about twice ``ranges`` * KEYS_PER_RANGE whatever the rows of a key. The draw
    is by hash, so it repeats; a boundary is put before a whole key unless that
    key fills ranges by itself."""
    want = ranges * KEYS_PER_RANGE
    chance = F.col("__size") * F.lit(want / max(total, 1))
    u = F.pmod(F.xxhash64("__k1", "__k2", F.lit(8)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    keys = keyed.groupBy("__k1", "__k2").agg(F.sum("__size").alias("__size"))
    rows = keys.where(u < chance).select("__k1", "__k2", F.greatest(chance, F.lit(1.0)).alias("w")).collect()
    if not rows:
        return np.empty((0, 2), np.int64)
    k = np.array([(r[0], r[1]) for r in rows], np.int64)
    w = np.array([r[2] for r in rows])
    order = np.lexsort((k[:, 1], k[:, 0]))
    k, w = k[order], np.cumsum(w[order])
    cuts = k[np.minimum(np.searchsorted(w, w[-1] * np.arange(1, ranges) / ranges), len(k) - 1)]
    hot = np.zeros(len(cuts), dtype=bool)
    same = cuts[1:, 0] == cuts[:-1, 0]
    hot[1:] |= same
    hot[:-1] |= same
    cuts[~hot, 1] = np.iinfo(np.int64).min
    return np.unique(cuts, axis=0)


def _ranged(keyed: DataFrame, cuts: np.ndarray) -> DataFrame:
    """With the number of the range each key lies in."""
    k1, k2 = cuts[:, 0].copy(), cuts[:, 1].copy()

    @F.pandas_udf("int")
    def place(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = a.to_numpy(), b.to_numpy()
        lo, hi = np.searchsorted(k1, x, "left"), np.searchsorted(k1, x, "right")
        at = lo.copy()
        for i in np.flatnonzero(hi > lo):  # keys equal to a boundary's first part
            at[i] = lo[i] + np.searchsorted(k2[lo[i] : hi[i]], y[i], "right")
        return pd.Series(at.astype(np.int32))

    return keyed.withColumn("__range", place("__k1", "__k2") if len(cuts) else F.lit(0))


def _subdivided(ranged: DataFrame, cuts: np.ndarray, total: int, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Overfull ranges cut into equal slices of key space: ``__sub``. The keys
    are hashes, so slices hold about equal parts; a range of one hot key is cut
    along the second hash. Also the rows and bytes of all slices."""
    share = min(max(total / ranges, 1.0), float(RANGE_BYTES))
    stats = ranged.groupBy("__range").agg(
        F.sum("__size").alias("bytes"), F.min("__k1").alias("a"), F.max("__k1").alias("z"),
        F.min("__k2").alias("a2"), F.max("__k2").alias("z2"))
    stats = stats.select("__range", "a", "z", "a2", "z2", F.greatest(F.lit(1), F.ceil(F.col("bytes") / share / 1.5)).alias("parts"))
    stats = stage(stats, "shard-ranges")  # at most RANGES rows
    lo, hi, x = (F.when(F.col("a") < F.col("z"), F.col(p)).otherwise(F.col(q)).cast("double") for p, q in (("a", "a2"), ("z", "z2"), ("__k1", "__k2")))
    sub = F.least(F.floor((x - lo) / F.greatest(hi - lo, F.lit(1.0)) * F.col("parts")), F.col("parts") - 1).cast("int")
    out = ranged.join(F.broadcast(stats), "__range").withColumn("__sub", sub).drop("a", "z", "a2", "z2", "parts")
    return out, out.groupBy("__range", "__sub").agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def shard(docs: DataFrame, shards: int = SHARDS, size: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any others) with size (long), shard (int) and
    slot (long; gapless from 0 in each shard). ``size`` names a column to
    balance by; by default it is the text's UTF-8 bytes (null: none) plus 16.

    Null texts are one group of equal texts; rows that repeat fall next to each
    other, in no defined order among themselves; null ids sort first. Columns
    called size, shard or slot are replaced. An empty table gives an empty one.
    """
    docs = docs.drop(*[c for c in ("shard", "slot") if c in docs.columns])
    own = F.col(size) if size else F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(OVERHEAD)
    keyed = docs.withColumns({
        "__size": own.cast("long"), "__k1": F.xxhash64(F.coalesce(F.xxhash64("text"), F.lit(0))), "__k2": F.xxhash64(F.lit(1), "doc_id")})
    total, n = keyed.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = int(max(1, min(RANGES, n // 16)))
    keyed = _parted(keyed, total)
    cuts = _splitters(keyed, total, ranges)
    ranged, slices = _subdivided(_ranged(keyed, cuts), cuts, total, ranges)
    # rows and bytes before each slice: a running sum within a range, on top of one over the ranges
    slices = stage(slices, "shard-slices")
    per = slices.groupBy("__range").agg(F.sum("bytes").alias("b"), F.sum("n").alias("c"))
    run = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # at most RANGES rows
    per = per.select("__range", F.coalesce(F.sum("b").over(run), F.lit(0)).alias("b0"), F.coalesce(F.sum("c").over(run), F.lit(0)).alias("c0"))
    inner = W.partitionBy("__range").orderBy("__sub").rowsBetween(W.unboundedPreceding, -1)
    offsets = slices.join(per, "__range").select(
        "__range", "__sub", (F.col("b0") + F.coalesce(F.sum("bytes").over(inner), F.lit(0))).alias("__b0"),
        (F.col("c0") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("__c0"))
    offsets = stage(offsets, "shard-offsets")
    w = W.partitionBy("__range", "__sub").orderBy("__k1", "__k2", "__size")
    group = W.partitionBy("__range", "__sub", "__k1")
    placed = ranged.join(offsets, ["__range", "__sub"]).withColumns({
        "__at": F.col("__b0") + F.sum("__size").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__size"),
        "__row": F.col("__c0") + F.row_number().over(w) - 1,
    }).withColumns({"__g0": F.min("__at").over(group), "__gb": F.sum("__size").over(group)})
    whole = F.col("__gb") <= F.lit(WHOLE * max(total, 1) / shards)
    middle = F.when(whole, F.col("__g0") + F.col("__gb") / 2).otherwise(F.col("__at") + F.col("__size") / 2)
    no = F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", no)
    starts = stage(placed.groupBy("shard").agg(F.min("__row").alias("__first")), "shard-starts")  # one row a shard
    out = placed.join(F.broadcast(starts), "shard")
    keep = [c for c in docs.columns if c != "size"]
    return out.select(*keep, F.col("__size").alias("size"), "shard", (F.col("__row") - F.col("__first")).alias("slot"))


def write(sharded: DataFrame, path: str) -> None:
    """One folder per shard, records in slot order within each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op8_sampled_splitters(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
