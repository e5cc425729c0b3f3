"""Exact medians that no hot group can stall.

``exact_median``          per key over all rows; a key with many distinct values
                          is selected distributedly
``sliding_medians``       of several measures over trailing windows of days

Spark's ``median`` keeps one entry per distinct value of a group in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from renewlens.functions.scalars import day_number
from renewlens.sources.store import stage

#: Distinct values of a key that one percentile buffer may hold.
BUFFERED = 10_000


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str, buffered: int = BUFFERED) -> DataFrame:
    """The exact median of the non-NULL ``value`` per ``keys`` (double), NULL
    for a key that has none.

    Where no key has more than ``buffered`` values at all, one plain percentile
    does. Else values are counted per (key, value) first, so repeats never leave
    a map task, and keys of up to ``buffered`` distinct values use a weighted
    percentile. The others are selected: their (key, value) counts are sorted into ranges,
    a key's ranges are summed (one row each), and the two middle rows are those
    whose running count passes the middle within their range. No task holds
    more of such a key than its range. ``df`` is read more than once: stage it
    where that is dear.
    """
    keys = list(keys)
    seen = df.select(*keys, F.col(value).cast("double").alias("__v"))
    if seen.groupBy(*keys).agg(F.count("__v").alias("__all")).where(F.col("__all") > buffered).isEmpty():
        return seen.groupBy(*keys).agg(F.percentile("__v", 0.5).alias(alias))
    counts = seen.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.groupBy(*keys).agg(F.count("__v").alias("__distinct")).where(F.col("__distinct") > buffered).select(*keys)
    if hot.isEmpty():
        return counts.groupBy(*keys).agg(F.percentile("__v", 0.5, F.col("__n")).alias(alias))
    counts = stage(counts, "median-counts")
    hot = stage(counts.groupBy(*keys).agg(F.count("__v").alias("__distinct")).where(F.col("__distinct") > buffered).select(*keys), "median-hot")
    few = _equal_join(counts, hot, keys, "left_anti").groupBy(*keys).agg(F.percentile("__v", 0.5, F.col("__n")).alias(alias))
    many = _equal_join(counts, hot, keys, "left_semi").where("__v is not null")
    return few.unionByName(_selected(many, keys, alias))


def _equal_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL."""
    cond = None
    for k in keys:
        c = F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}"))
        cond = c if cond is None else cond & c
    return left.alias("__l").join(right.alias("__r"), cond, how)


def _selected(counts: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """Medians of (keys, __v, __n) by ranges."""
    ranged = stage(counts.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id()), "median-ranges")
    parts = ranged.groupBy(*keys, "__part").agg(F.sum("__n").alias("__in"))
    key = Window.partitionBy(*keys)  # one row a range
    parts = parts.select(
        *keys, "__part", F.sum("__in").over(key).alias("__all"),
        F.coalesce(F.sum("__in").over(key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), "__in",
    )
    # the middle ranks, and the one or two ranges that hold them
    lo, hi = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    parts = parts.withColumns({"__lo": lo, "__hi": hi}).where(
        (F.col("__hi") > F.col("__before")) & (F.col("__lo") <= F.col("__before") + F.col("__in")))
    cond = F.col("__l.__part") == F.col("__r.__part")
    for k in keys:
        cond = cond & F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}"))
    rows = ranged.alias("__l").join(parts.alias("__r"), cond).select(*[F.col(f"__l.{k}").alias(k) for k in keys], "__l.__part", "__v", "__n", "__before", "__lo", "__hi")
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__upto", upto)

    def holds(rank: str) -> Column:
        return F.max(F.when((F.col(rank) <= F.col("__upto")) & (F.col(rank) > F.col("__upto") - F.col("__n")), F.col("__v")))

    return rows.groupBy(*keys).agg((holds("__lo") * 0.5 + holds("__hi") * 0.5).alias(alias))


def _middle(values: Column) -> Column:
    """Median of a sorted array, NULL of an empty one."""
    n = F.size(values)
    at = lambda i: F.try_element_at(values, F.greatest(i, F.lit(1)).cast("int"))
    return at(F.floor((n + 1) / 2)) * 0.5 + at(F.floor(n / 2) + 1) * 0.5


def sliding_medians(
    windows: DataFrame, daily: DataFrame, keys: Sequence[str], lo: str, hi: str, day: str,
    measures: Sequence[tuple[str, str]], span: int,
) -> DataFrame:
    """``windows`` with the exact medians of ``measures`` (column, alias) over
    the rows of ``daily`` of equal keys dated in [lo, hi], at most ``span`` days
    after ``lo``.

    The days of a key are laid out in overlapping runs of two spans, in day
    order, so that every window lies within a single one: a window joins one
    row in place of one per day, nothing is grouped after the join, and the
    medians are taken within the row. The runs hold each day twice, however
    many windows there are; a key with many windows spreads like any other
    join. NULL values and days count nowhere; a window without a day, or with a
    NULL bound, is left out.
    """
    keys = list(keys)
    wide = span + 1
    run = F.floor(day_number(F.col(day)) / F.lit(wide)).cast("long")
    one = F.struct(F.col(day).alias("__d"), *[F.col(c).cast("double").alias(a) for c, a in measures])
    runs = daily.where(F.col(day).isNotNull()).select(*keys, F.explode(F.array(run, run + 1)).alias("__run"), one.alias("__e"))
    runs = runs.groupBy(*keys, "__run").agg(F.collect_list("__e").alias("__days"))
    at = windows.where(F.col(lo).isNotNull()).withColumn("__run", F.floor(day_number(F.col(hi)) / F.lit(wide)).cast("long"))
    inside = F.filter("__days", lambda x: (x["__d"] >= F.col(lo)) & (x["__d"] <= F.col(hi)))
    kept = at.join(runs, [*keys, "__run"]).select(*windows.columns, inside.alias("__in")).where(F.size("__in") > 0)
    return kept.select(*windows.columns, *[_middle(F.sort_array(F.array_compact(F.col("__in")[a]))).alias(a) for _, a in measures])
