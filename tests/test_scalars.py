"""Scalar expressions: buckets, keys, dates, slot tokens (FIXTURES U1, U2, U5, U6, U7, U12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from renewlens.functions import scalars as X
from tests.conftest import d


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_channel_bucket(spark):
    vals = ["Shadow_x", "ContactRequest", "contactrequest", "CRM", "Facebook", "FB_Marketplace", "ivr", None, "old_churn"]
    got = _one(spark, X.channel_bucket(F.col("g")), "g string", [(v,) for v in vals])
    assert got == [
        "churn/shadow", "CR/ImageCR/ReCallback", "others", "crm", "facebook/FB_Marketplace", "others", "others",
        "others", "churn/shadow",
    ]


def test_bhk_and_property_bucket(spark):
    got = _one(spark, X.bhk_bucket(F.col("a")), "a string", [("1 RK",), ("2 BHK",), ("4 BHK",), (None,), ("3+ BHK",)])
    assert got == ["1RK/1BHK", "2 BHK", "Others", "Others", "3+ BHK"]
    got = _one(spark, X.property_bucket(F.col("a")), "a string", [("Villa",), ("Apartment",), ("Plot",), (None,)])
    assert got == ["Independent House/Villa", "Apartment", "Others", "Others"]


def test_phone_key(spark):
    assert _one(spark, X.phone_key(F.col("m")), "m string", [(" +919876543210 ",), (None,)]) == ["9876543210", None]


def test_quarter_cutoff(spark):
    df = spark.createDataFrame([(d("2024-01-01"), d("2024-05-01")), (d("2024-01-01"), d("2024-03-31"))], "s date, e date")
    r = df.select(
        X.package_duration(F.col("s"), F.col("e")).alias("dur"),
        X.quarter_days(F.col("s"), F.col("e")).alias("q"),
        X.quarter_cutoff(F.col("s"), F.col("e")).alias("cut"),
    ).collect()
    assert (r[0].dur, r[0].q, r[0].cut) == (121, 30, d("2024-01-31"))
    assert (r[1].dur, r[1].q) == (90, 22)


def test_slot_tokens(spark):
    df = spark.createDataFrame([(["[1,2]", "[2]", "3"],), (None,), ([],)], "a array<string>")
    r = df.select(F.size(F.array_distinct(X.slot_tokens(F.col("a")))).alias("n"), X.slot_tokens(F.col("a")).alias("t")).collect()
    assert r[0].n == 3
    assert r[1].t is None
    assert r[2].t == [""]


def test_listing_price_dirty_text(spark):
    df = spark.createDataFrame(
        [(True, "1200", None), (False, None, '{"rent": 300}'), (False, None, '{"rent": "n/a"}'), (True, "abc", None)],
        "b boolean, p string, j string",
    )
    got = [r[0] for r in df.select(X.listing_price(F.col("b"), F.col("p"), F.col("j"))).collect()]
    assert got == [1200, 300, None, None]


def test_guarded_pct(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (2, 3)], "a long, b long")
    got = [r[0] for r in df.select(X.guarded_pct("a", "b")).collect()]
    assert got == [25.0, 0.0, 66.67]
