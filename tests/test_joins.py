"""Join operators against brute force on random data (including a hot key)."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from renewlens.operators.aggs import cond_sums, deterministic_mode, distinct_count
from renewlens.operators.joins import count_upto, or_range_join, range_join

BASE = dt.date(2020, 1, 1)


def _rand_intervals(rng, n, keys):
    out = []
    for i in range(n):
        s = BASE + dt.timedelta(days=rng.randint(0, 400))
        out.append((i, rng.choice(keys), s, s + dt.timedelta(days=rng.randint(0, 90))))
    return out


def _rand_points(rng, n, keys):
    return [(1000 + i, rng.choice(keys), BASE + dt.timedelta(days=rng.randint(-20, 500))) for i in range(n)]


def test_range_join_matches_brute_force(spark):
    rng = random.Random(7)
    keys = ["hot"] * 8 + ["a", "b", "c", None]
    left = _rand_intervals(rng, 120, keys)
    right = _rand_points(rng, 400, keys)
    L = spark.createDataFrame(left, "lid int, k string, lo date, hi date")
    R = spark.createDataFrame(right, "rid int, k string, p date")
    for bucket in (1, 7, 32, 1000):
        got = sorted((r.lid, r.rid) for r in range_join(L, R, ["k"], "lo", "hi", "p", bucket).collect())
        want = sorted(
            (a[0], b[0]) for a in left for b in right if a[1] is not None and a[1] == b[1] and a[2] <= b[2] <= a[3]
        )
        assert got == want


def test_count_upto_matches_brute_force(spark):
    rng = random.Random(11)
    keys = ["hot"] * 6 + ["a", "b", "z"]
    ev = [(rng.choice(keys[:-1]), BASE + dt.timedelta(days=rng.randint(0, 300)), rng.randint(0, 3)) for _ in range(300)]
    pts = [(i, rng.choice(keys), BASE + dt.timedelta(days=rng.randint(-30, 340))) for i in range(150)]
    pts.append((999, "hot", pts[0][2]))  # duplicate point row is kept
    E = spark.createDataFrame(ev, "k string, d date, w int")
    P = spark.createDataFrame(pts, "pid int, k string, at date")
    out = count_upto(P, E, ["k"], "at", "d", {"n": F.lit(1), "s": F.col("w")}, bucket_days=16, prefix="c_")
    got = sorted((r.pid, r.c_n, r.c_s) for r in out.collect())
    want = sorted(
        (p[0], sum(1 for e in ev if e[0] == p[1] and e[1] <= p[2]), sum(e[2] for e in ev if e[0] == p[1] and e[1] <= p[2]))
        for p in pts
    )
    assert got == want


def test_or_range_join_equals_or_predicate(spark):
    left = [
        (1, "p1", "e1", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        (2, "p2", None, dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        (3, None, "e3", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
    ]
    right = [
        ("p1", "e1", dt.date(2024, 1, 5), "L1"),  # phone and email: counted once
        (None, "e1", dt.date(2024, 1, 6), "L2"),  # email only
        ("p2", "zz", dt.date(2024, 2, 5), "L3"),  # outside window
        ("p2", "e3", dt.date(2024, 1, 9), "L4"),  # phone of 2, email of 3
        ("p2", "e3", dt.date(2024, 1, 9), "L4"),  # exact duplicate row
    ]
    L = spark.createDataFrame(left, "id int, ph string, em string, lo date, hi date")
    R = spark.createDataFrame(right, "rph string, rem string, p date, lst string")
    out = or_range_join(L, R, [("ph", "rph"), ("em", "rem")], "lo", "hi", "p", dedupe_on=["id", "p", "lst"])
    got = sorted((r.id, r.lst) for r in out.collect())
    assert got == [(1, "L1"), (1, "L2"), (2, "L4"), (3, "L4")]


def test_aggregation_helpers(spark):
    df = spark.createDataFrame(
        [("k", "a", "x"), ("k", "a", "x"), ("k", "b", "y"), ("k", "b", None), ("j", "b", "x")], "k string, c string, v string"
    )
    got = {r.k: r.n for r in distinct_count(df, ["k"], "v", "n").collect()}
    assert got == {"k": 2, "j": 1}
    sums = df.groupBy("k").agg(*cond_sums("c", ["a", "b", "zz"], ["na", "nb", "nz"])).orderBy("k").collect()
    assert [(r.na, r.nb, r.nz) for r in sums] == [(0, 1, 0), (2, 2, 0)]
    tie = spark.createDataFrame([("s", "b"), ("s", "a"), ("s", "a"), ("s", "b")], "k string, v string")
    assert deterministic_mode(tie, ["k"], "v", "m").collect()[0].m == "a"


def test_count_upto_nulls(spark):
    points = spark.createDataFrame([("a", dt.date(2024, 3, 1)), ("a", None), ("b", dt.date(2024, 3, 1))], "k string, at date")
    events = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", None), ("a", dt.date(2025, 1, 1))], "k string, day date")
    got = count_upto(points, events, ["k"], "at", "day", {"n": F.lit(1)})
    assert sorted(((r.k, r.at, r.n) for r in got.collect()), key=str) == sorted(
        [("a", dt.date(2024, 3, 1), 1), ("a", None, 0), ("b", dt.date(2024, 3, 1), 0)], key=str)
