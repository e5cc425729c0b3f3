"""Join operators that Spark has no single built-in for.

``range_join``     equi key + "point inside a date interval" (J3, J4, J6 legs)
``or_range_join``  disjunctive key (phone OR email) + date interval (J6)
``count_upto``     per-key running totals looked up at a date (as-of lookup),
                   used where an interval join would emit all pairs of a key
``count_dominated``  the same for two dates at once (both on or before)

All of them are compositions of DataFrame joins, aggregates and windows whose
windows only ever hold one key's distinct days, never one key's rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from renewlens.functions.scalars import day_number


def _bucket(day: Column, bucket_days: int) -> Column:
    return F.floor(day / F.lit(bucket_days)).cast("long")


def range_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lo: str,
    hi: str,
    point: str,
    bucket_days: int = 32,
) -> DataFrame:
    """Inner join: rows of ``right`` whose ``point`` date lies in
    ``[left.lo, left.hi]`` of a ``left`` row with equal ``keys``.

    A plain equi-join on ``keys`` sends every row of one key to one task; a
    seller or city holding a third of the rows would stall the join. Both
    sides are therefore also keyed by a day bucket: the left row is replicated
    once per bucket its interval covers (intervals are short compared with the
    history, so this is a small constant), the right row lands in exactly one
    bucket, so every matching pair is produced exactly once and a hot key is
    spread over as many tasks as it has buckets (plus AQE skew splitting).
    Callers that need LEFT semantics join the aggregated result back onto
    their base, which is cheaper than carrying unmatched rows through.
    """
    bcol = "__bucket"
    lb = left.withColumn(
        bcol,
        F.explode(
            F.sequence(
                _bucket(day_number(F.col(lo)), bucket_days),
                _bucket(day_number(F.col(hi)), bucket_days),
            )
        ),
    )
    rb = right.withColumn(bcol, _bucket(day_number(F.col(point)), bucket_days))
    # qualified names, not df[col]: both sides may derive from one source
    L, R = (lambda c: F.col(f"`__l`.`{c}`")), (lambda c: F.col(f"`__r`.`{c}`"))
    cond = [L(k) == R(k) for k in keys] + [
        L(bcol) == R(bcol),
        R(point) >= L(lo),
        R(point) <= L(hi),
    ]
    rcols = [R(c) for c in right.columns if c not in keys]
    joined = lb.alias("__l").join(rb.alias("__r"), reduce(lambda a, b: a & b, cond), "inner")
    return joined.select(*[L(c) for c in left.columns], *rcols)


def count_upto(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    event_day: str,
    measures: dict[str, Column],
    bucket_days: int = 128,
    prefix: str = "",
    last: int | None = None,
) -> DataFrame:
    """For every row of ``points``: the sums of ``measures`` over the
    ``events`` of the same ``keys`` dated on or before ``points.at``.

    Same result as ``points LEFT JOIN events ON keys AND event_day <= at
    GROUP BY <point row>`` (0 where nothing matches), without materialising
    the pairs, which would be quadratic in the rows of a key:

    1. events are pre-aggregated to one row per (key, day) (map-side combine);
    2. a window per key turns them into running totals; the window holds one
       key's distinct days (bounded by the calendar), not its rows;
    3. the days of one (key, bucket of days) become a sorted array of at most
       ``bucket_days`` entries, repeated for the empty buckets behind it;
    4. one equi join on (key, bucket) finds a point's array, and the last
       entry on or before the point is picked within the row, so a hot key
       spreads over its buckets.

    Every point row comes out exactly once, with one extra column per measure
    (``prefix + name``), never NULL. Point rows may repeat; each copy is kept.
    A point dated NULL matches nothing (0); events dated NULL count nowhere.

    ``last`` is a day number that no point lies behind: a key's last array is
    then repeated up to it, and points need not meet their key's last bucket
    before they meet their array.
    """
    names = list(measures)
    daily = events.filter(F.col(event_day).isNotNull()).groupBy(*keys, F.col(event_day).alias("__d")).agg(
        *[F.sum(e).alias(n) for n, e in measures.items()]
    )
    days = Window.partitionBy(*keys).orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(
        *keys,
        F.struct("__d", *[F.sum(n).over(days).cast("long").alias(n) for n in names]).alias("__e"),
        _bucket(day_number(F.col("__d")), bucket_days).alias("__b"),
    )
    filled = running.groupBy(*keys, "__b").agg(F.sort_array(F.collect_list("__e")).alias("__a"))
    buckets = Window.partitionBy(*keys).orderBy("__b")
    # totals before the bucket's first day, and the next bucket that has days
    steps = filled.select(
        *keys,
        "__b",
        "__a",
        F.element_at(F.lag("__a").over(buckets), -1).alias("__open"),
        (F.lead("__b").over(buckets) - 1).alias("__until"),
    )
    end = F.col("__b") if last is None else F.greatest("__b", F.lit(last // bucket_days))
    filled_up = steps.withColumn("__b", F.explode(F.sequence("__b", F.coalesce("__until", end)))).drop("__until")
    here = _bucket(day_number(F.col(at)), bucket_days)
    if last is None:
        # points behind a key's last bucket look there
        final = steps.filter(F.col("__until").isNull()).select(*keys, F.col("__b").alias("__top"))
        top = points.join(final, list(keys), "left").withColumn("__b", F.least(here, F.col("__top")))
    else:
        top = points.withColumn("__b", here)
    steps = filled_up
    got = top.join(steps, [*keys, "__b"], "left")
    pick = F.coalesce(
        F.try_element_at(F.filter("__a", lambda e: e["__d"] <= F.col(at)), F.lit(-1)), F.when(F.col(at).isNotNull(), F.col("__open"))
    )
    return got.withColumn("__pick", pick).select(
        *points.columns, *[F.coalesce(F.col("__pick")[n], F.lit(0)).cast("long").alias(prefix + n) for n in names]
    )


#: Levels of the day tree: days of the years 1 to 9999 are under 2^22.
_DAY_LEVELS = 22
_DAY_ZERO = 719_162  # days from 0001-01-01 to 1970-01-01


def count_dominated(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at: tuple[str, str],
    event_days: tuple[str, str],
    measures: dict[str, Column],
    bucket_days: int = 128,
    prefix: str = "",
) -> DataFrame:
    """For every row of ``points``: the sums of ``measures`` over the ``events``
    of the same ``keys`` with both ``event_days`` on or before the two dates
    ``at``.

    Dominance counting without pairing rows: the first date is taken apart into
    whole subtrees of a binary tree of days (at most one per level), an event
    stands in its subtree of every level, and within (key, subtree) the second
    date is a running count (``count_upto``). A hot key spreads over its
    subtrees. Events are replicated once per level, so this is for event sets
    that a plain running count can't serve. Points come out once each, 0 where
    a date is NULL or nothing matches.
    """
    x, y = at
    ex, ey = event_days
    names = list(measures)
    rows = events.where(F.col(ex).isNotNull() & F.col(ey).isNotNull()).select(
        *keys, F.col(ey).alias("__ey"), *[e.alias(n) for n, e in measures.items()],
        (day_number(F.col(ex)) + _DAY_ZERO).cast("long").alias("__dx"))
    level = F.explode(F.sequence(F.lit(0), F.lit(_DAY_LEVELS))).alias("__level")
    nodes = rows.select(*keys, "__ey", *names, "__dx", level)
    nodes = nodes.withColumn("__node", F.expr("shiftright(__dx, __level)")).drop("__dx")
    # days before x + 1: for each set bit i of x + 1 the subtree left of it
    bound = (day_number(F.col(x)) + _DAY_ZERO + 1).cast("long")
    own = points.columns
    dated = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    parts = dated.join(events.select(*keys).dropDuplicates(), list(keys), "left_semi")
    parts = parts.select(*own, bound.alias("__bound"), level).where("shiftright(__bound, __level) % 2 = 1")
    parts = parts.withColumn("__node", F.expr("shiftright(__bound, __level) - 1")).drop("__bound")
    found = count_upto(parts, nodes, [*keys, "__level", "__node"], y, "__ey", {n: F.col(n) for n in names}, bucket_days, prefix="__")
    rows = found.select(*own, F.lit(0).alias("__copy"), *[f"__{n}" for n in names]).unionByName(
        points.select(*own, F.lit(1).alias("__copy"), *[F.lit(0).cast("long").alias(f"__{n}") for n in names]))
    # equal points got the same counts: their sum is that of one, times the copies
    total = rows.groupBy(*own).agg(F.sum("__copy").alias("__copies"), *[F.sum(f"__{n}").alias(f"__{n}") for n in names])
    total = total.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return total.select(*own, *[F.expr(f"__{n} div __copies").alias(prefix + n) for n in names])


def or_range_join(
    left: DataFrame,
    right: DataFrame,
    key_pairs: Sequence[tuple[str, str]],
    lo: str,
    hi: str,
    point: str,
    dedupe_on: Sequence[str],
    bucket_days: int = 32,
) -> DataFrame:
    """Pairs matching on ANY of ``key_pairs`` (left col, right col) with the
    right ``point`` inside ``[lo, hi]``, de-duplicated on ``dedupe_on``.

    ``a.k1 = b.k1 OR a.k2 = b.k2`` has no equi key, so Spark would plan a
    nested-loop join. One equi interval join per key, a union and a
    de-duplication give the same set of distinct result rows.
    """
    legs = []
    for lkey, rkey in key_pairs:
        k = "__k"
        l1 = left.withColumn(k, F.col(lkey)).filter(F.col(k).isNotNull())
        r1 = right.withColumn(k, F.col(rkey)).filter(F.col(k).isNotNull())
        legs.append(range_join(l1, r1, [k], lo, hi, point, bucket_days).drop(k))
    u = reduce(lambda a, b: a.unionByName(b), legs)
    return u.dropDuplicates(list(dedupe_on))
