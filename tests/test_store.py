"""Dated repository sink (FIXTURES U24) and staging."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from renewlens.sources.store import StageScope, clear_date, stage, write_dated


def test_write_dated_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="renewlens-repo-") + "/repo"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    day1 = spark.createDataFrame([(d1, 1), (d1, 2), (d1, 3)], "feature_creation_date date, opportunity_id long")
    write_dated(day1, path, "feature_creation_date")
    write_dated(day1, path, "feature_creation_date")
    write_dated(spark.createDataFrame([(d2, 9)], "feature_creation_date date, opportunity_id long"), path, "feature_creation_date")
    counts = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("feature_creation_date").count().collect()}
    assert counts == {d1: 3, d2: 1}
    clear_date(spark, path, "feature_creation_date", d2)
    assert spark.read.parquet(path).count() == 3


def test_empty_rerun_clears_the_day(spark):
    path = tempfile.mkdtemp(prefix="renewlens-repo-") + "/repo"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "feature_creation_date date, opportunity_id long"
    write_dated(spark.createDataFrame([(d1, 1), (d1, 2), (d2, 3)], schema), path, "feature_creation_date")
    write_dated(spark.createDataFrame([], schema), path, "feature_creation_date", d1)
    assert [tuple(r) for r in spark.read.parquet(path).select("feature_creation_date", "opportunity_id").collect()] == [(d2, 3)]


def test_stage_round_trip(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    assert sorted(r.x for r in stage(df, "t").collect()) == list(range(10))


def _folders(spark):
    return {x for x in os.listdir(spark.conf.get("spark.checkpoint.dir")) if x.startswith("stage-scope")}


def test_scope_frees_all_but_its_result(spark):
    with StageScope(spark) as outer:
        with StageScope(spark) as inner:
            a = stage(spark.range(5), "scope-a")
            b = stage(a.join(a.withColumnRenamed("id", "x"), a["id"] == F.col("x")), "scope-b")
            inner.free(a)
            assert {x.rsplit("-", 1)[0] for x in _folders(spark)} == {"stage-scope-b"}
            out = inner.keep(b.select("id"), "scope-out")
        assert {x.rsplit("-", 1)[0] for x in _folders(spark)} == {"stage-scope-out"}
        assert out.count() == 5
        outer.free(spark.range(3))  # not staged: left alone
    assert not _folders(spark)


def test_scope_frees_on_error_and_leaves_results_outside(spark):
    with pytest.raises(RuntimeError), StageScope(spark):
        stage(spark.range(2), "scope-c")
        raise RuntimeError
    assert not _folders(spark)
    with StageScope(spark) as scope:
        out = scope.keep(spark.range(4), "scope-d")
    assert out.count() == 4
    assert len(_folders(spark)) == 1


def test_stage_leaves_no_shuffle_files(spark):
    """They go with the write, not when the driver collects its garbage; the session's setting stays."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = files.getAllFiles().iterator()
        out = set()
        while blocks.hasNext():
            name = blocks.next().getName()
            if name.startswith("shuffle_"):
                out.add(name)
        return out

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(key)
    out = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    assert not shuffles() - before and spark.conf.get(key) == was
    assert sorted(r["count"] for r in out.collect()) == [142, 143, 143, 143, 143, 143, 143]
