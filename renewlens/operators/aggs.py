"""Aggregation operators."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cond_sums(cat: str | Column, values: Iterable[str], names: Iterable[str], weight: Column | None = None) -> list[Column]:
    """``sum(CASE WHEN cat = v THEN weight ELSE 0 END) AS name`` per value.

    A fixed list instead of ``pivot()``: the values are known up front and a
    missing one must still give a 0 column (and no extra pass to find values).
    """
    c = F.col(cat) if isinstance(cat, str) else cat
    w = F.lit(1) if weight is None else weight
    return [F.sum(F.when(c == v, w).otherwise(F.lit(0))).alias(n) for v, n in zip(values, names)]


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """``count(DISTINCT col)`` per ``keys`` as two aggregations.

    The first groups on ``keys + col`` and so spreads a hot key over the
    distinct values; the second only counts pre-deduplicated rows with
    map-side partial counts. A single ``countDistinct`` would shuffle on
    ``keys`` alone and put a hot key's distinct values in one task.
    """
    return (
        df.select(*keys, col)
        .dropDuplicates([*keys, col])
        .groupBy(*keys)
        .agg(F.count(col).alias(alias))
    )


def deterministic_mode(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """Most frequent non-NULL ``col`` per ``keys``; ties go to the smallest.

    Counted per (key, value) first, so only one row per distinct value of a
    key reaches the ranking window.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(F.col("__n").desc(), F.col(col).asc())
    return (
        counts.withColumn("__r", F.row_number().over(w))
        .filter(F.col("__r") == 1)
        .select(*keys, F.col(col).alias(alias))
    )
