"""Candidate pairs out of hash buckets that may be crowded.

An LSH bucket of n nodes stands for n*(n-1)/2 possible links. Small buckets
give all of them. A crowded bucket (a big family of near copies, or many texts
around one shared passage) gives only a star around its best connected node;
what the star does not settle goes to an exact comparison of the nodes of those
crowded buckets whose members are not all in one component by then (``unsettled``). So
no bucket is capped, and none emits all its pairs. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.sources.store import stage

#: Buckets of up to this many nodes give all their pairs.
SMALL = 8


#: Bits of the sieve that spares rows a shuffle: 16 a key, from 128 rows of
#: 4 KB up to 4096 (16 MB), the bound of what is broadcast. With more keys it
#: lets more through, until it spares nothing.
_SIEVE_BITS = (1 << 22, 1 << 27)


def sieved(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean __maybe that is true wherever the long ``key``
    is among those of ``wanted`` (and by chance elsewhere). The bitmap it is
    looked up in has a bounded size, so it can be broadcast."""
    n_bits = min(max(_SIEVE_BITS[0], 1 << (16 * wanted.count()).bit_length()), _SIEVE_BITS[1])
    at = F.pmod(F.xxhash64(key), F.lit(n_bits))
    bucket, bit = F.floor(at / 32768).cast("int"), F.pmod(at, F.lit(32768)).cast("int")
    bits = wanted.select(bucket.alias("__bucket"), bit.cast("long").alias("b")).groupBy("__bucket").agg(F.bitmap_construct_agg("b").alias("__bits"))
    bits = stage(bits, name)
    out = rows.withColumns({"__bucket": bucket, "__bit": bit})
    out = out.join(F.broadcast(bits), "__bucket", "left")
    hit = F.expr("(cast(conv(hex(substring(__bits, __bit div 8 + 1, 1)), 16, 10) as int) & shiftleft(1, __bit % 8)) != 0")
    return out.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__bucket", "__bit", "__bits")


def _pair(x, y):
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def bucket_pairs(entries: DataFrame, small: int = SMALL, name: str = "buckets") -> tuple[DataFrame, DataFrame]:
    """(pairs a < b, crowded members key/node/pivot) of entries (key, node bigint),
    which must hold each (key, node) once.

    Counting is one map-side combined aggregate; buckets of two and three are
    resolved from it alone (least, greatest, and the third by xor).
    """
    counts = entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"),
        F.bit_xor("node").alias("x"),
    ).where("n >= 2")
    counts = stage(counts, f"{name}-counts")
    middle = F.col("x").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi"))
    few = (
        counts.where("n <= 3")
        .select(F.explode(
            F.when(F.col("n") == 2, F.array(_pair(F.col("lo"), F.col("hi"))))
            .otherwise(F.array(_pair(F.col("lo"), F.col("hi")), _pair(F.col("lo"), middle), _pair(middle, F.col("hi"))))
        ).alias("p")).select("p.a", "p.b")
    )
    more = stage(counts.where("n >= 4").select("key", "n"), f"{name}-more")
    # most entries are alone in their bucket: the sieve spares them the shuffle
    likely = sieved(entries, "key", more, f"{name}-sieve").where("__maybe").select("key", "node")
    members = stage(likely.join(more, "key"), f"{name}-members")
    lists = members.where(F.col("n") <= small).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("g"))
    within = lists.select(F.explode(F.expr(
        "flatten(transform(g, (y, i) -> transform(slice(g, 1, i), x -> struct(x AS a, y AS b))))"
    )).alias("p")).select("p.a", "p.b")
    crowded = members.where(F.col("n") > small)
    degree = crowded.groupBy("node").agg(F.sum("n").alias("degree"))
    pivots = (
        crowded.join(degree, "node").groupBy("key")
        .agg(F.max(F.struct("degree", "node")).getField("node").alias("pivot"))
    )
    crowded = stage(crowded.join(pivots, "key").select("key", "node", "pivot"), f"{name}-crowded")
    star = (
        crowded.where("node != pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    )
    pairs = few.unionByName(within).unionByName(star).distinct()
    return pairs, crowded


def unsettled(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """(pivot, node, label) of the crowded buckets that still hold two
    components."""
    lab = crowded.join(labels, "node", "left").select(
        "key", "pivot", "node", F.coalesce("component", "node").alias("label")
    )
    open_keys = lab.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l != h").select("key")
    return lab.join(open_keys, "key", "left_semi").select("pivot", "node", "label").distinct()
