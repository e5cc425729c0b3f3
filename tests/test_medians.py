"""Skew-safe medians, two-date counts and the one-shuffle merge against brute force."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from renewlens.operators.joins import count_dominated
from renewlens.operators.medians import _selected, exact_median, sliding_medians
from renewlens.plans.features import grain_report, merge_by_package

D0 = dt.date(2024, 1, 1)


def day(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


@pytest.mark.parametrize("buffered", [10_000, 3, 0])
def test_exact_median(spark, buffered):
    """Percentile buffer and distributed selection give the same medians; one
    seller holds a third of all rows, and a key may be NULL."""
    rng = random.Random(1)
    rows = [("hot", float(rng.randint(0, 500))) for _ in range(1000)]
    rows += [(rng.choice(["a", "b", "c", None, "d"]), rng.choice([None, 1.5, 2.0, float(rng.randint(0, 99))])) for _ in range(2000)]
    rows += [("none", None), ("one", 7.0), ("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0), ("same", 9.0)]
    df = spark.createDataFrame(rows, "s string, v double").repartition(4)
    got = {r.s: r.m for r in exact_median(df, ["s"], "v", "m", buffered).collect()}
    want = {s: (statistics.median(vs) if (vs := [v for k, v in rows if k == s and v is not None]) else None) for s in {k for k, _ in rows}}
    assert got == want


def test_no_task_holds_a_hot_sellers_prices(spark):
    """A third of the rows under one seller: its distinct prices lie in several ranges."""
    hot = spark.range(30_000).select(F.lit("hot").alias("s"), (F.col("id") * 3 % 29_989).cast("double").alias("__v"), F.lit(1).alias("__n"))
    rest = spark.range(60_000).select(F.concat(F.lit("s"), F.col("id") % 500).alias("s"), F.col("id").cast("double").alias("__v"), F.lit(1).alias("__n"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = hot.groupBy("s", "__v").agg(F.sum("__n").alias("__n")).unionByName(rest)
        ranged = counts.repartitionByRange("s", "__v").groupBy(F.spark_partition_id().alias("p")).agg(F.sum((F.col("s") == "hot").cast("int")).alias("n"))
        assert max(r.n for r in ranged.collect()) < 15_000
        got = {r.s: r.m for r in _selected(counts, ["s"], "m").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    values = [i * 3 % 29_989 for i in range(30_000)]
    assert got["hot"] == statistics.median(values) and len(got) == 501
    assert got["s7"] == statistics.median(range(7, 60_000, 500))


def test_sliding_medians(spark):
    rng = random.Random(2)
    daily = [(k, day(rng.randint(-200, 200)), rng.choice([None, float(rng.randint(0, 9))]), float(rng.randint(0, 99))) for k in "ab" for _ in range(150)]
    daily += [("a", None, 1.0, 1.0), (None, day(3), 1.0, 1.0)]
    cuts = [(k, day(c - 40), day(c)) for k in "abz" for c in range(-260, 260, 3)] + [("a", None, day(3))]
    d = spark.createDataFrame(daily, "k string, d date, x double, y double")
    w = spark.createDataFrame(cuts, "k string, lo date, hi date")
    got = {(r.k, r.hi): (r.mx, r.my) for r in sliding_medians(w, d, ["k"], "lo", "hi", "d", [("x", "mx"), ("y", "my")], 40).collect()}
    want = {}
    for k, lo, hi in cuts:
        rows = [r for r in daily if lo and r[0] == k and r[1] and lo <= r[1] <= hi]
        if rows:
            m = lambda i: statistics.median(v) if (v := [r[i] for r in rows if r[i] is not None]) else None  # noqa: B023, E731
            want[k, hi] = (m(2), m(3))
    assert got == want


def test_count_dominated(spark):
    """A hot key, NULL dates, repeated points and events before 1970."""
    rng = random.Random(3)
    anyday = lambda: rng.choice([None, day(rng.randint(-30_000, 100))]) if rng.random() < 0.1 else day(rng.randint(-60, 60))
    events = [(rng.choice(["hot", "hot", "b", "c"]), anyday(), anyday(), rng.randint(0, 1)) for _ in range(400)]
    points = [(i // 2, rng.choice(["hot", "b", "nobody"]), anyday(), anyday()) for i in range(200)]
    points += points[:5]
    e = spark.createDataFrame(events, "k string, ex date, ey date, f int")
    p = spark.createDataFrame(points, "i int, k string, x date, y date")
    got = count_dominated(p, e, ["k"], ("x", "y"), ("ex", "ey"), {"n": F.lit(1), "f": F.col("f")}, prefix="c_").collect()
    want = []
    for i, k, x, y in points:
        hit = [f for kk, ex, ey, f in events if kk == k and x and y and ex and ey and ex <= x and ey <= y]
        want.append((i, k, x, y, len(hit), sum(hit)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_merge_by_package_equals_the_joins(spark):
    """Repeated matches, missing frames, NULL keys; one shuffle on the package."""
    base = spark.createDataFrame(
        [(1, "s", "o", 5), (1, "s", "p", 6), (2, "s", None, 7), (3, "t", "o", 8), (None, "t", "o", 9)], "opportunity_id long, seller_uuid string, account_owner_id string, x int")
    one = spark.createDataFrame([("s", 1, 10), ("s", 1, 11), ("t", 3, 12), ("u", 2, 13), (None, 2, 1)], "seller_uuid string, opportunity_id long, y int")
    own = spark.createDataFrame([("o", 1, "q"), ("p", 1, "r"), (None, 2, "n"), ("o", 3, None)], "account_owner_id string, opportunity_id long, z string")
    got = merge_by_package(base, {"one": one, "own": own})
    want = base.join(one, ["seller_uuid", "opportunity_id"], "left").join(own, ["account_owner_id", "opportunity_id"], "left")
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_merge_reports_repeated_keys_by_builder(spark):
    base = spark.createDataFrame([(1, "s", 5), (2, "s", 6)], "opportunity_id long, seller_uuid string, x int")
    one = spark.createDataFrame([("s", 1, 10), ("s", 1, 11), ("t", 1, 12), (None, None, 1), (None, None, 2)], "seller_uuid string, opportunity_id long, y int")
    two = spark.createDataFrame([("s", 1, 10), ("s", 2, 10)], "seller_uuid string, opportunity_id long, z int")
    for frame, repeated in ((one, 2), (one.limit(0), 0)):
        grain = Observation("merge")
        assert merge_by_package(base, {"one": frame, "two": two}, grain).count() >= 2
        got = {r.builder: (r.n_rows, r.n_repeated) for r in grain_report(spark, grain).collect()}
        assert got == {"base": (2, 0), "one": (frame.count(), repeated), "two": (2, 0)}
